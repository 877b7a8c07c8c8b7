"""Transactions derived from the sample star schema (see FIXTURES.md, section 2).

``events`` is the transaction stream; ``customer``, ``nation``, ``supplier`` and
``part`` supply the attributes. Selectors are integer rules on the event number,
so the same table can be written in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.functions import columns as C
from txnrisk.operators.envelope import build_envelope
from txnrisk.operators.history import feature_columns, with_history
from txnrisk.operators.sketches import join_dimension_by_weight
from txnrisk.storage import stored

# Event type -> transaction type.
TYPES = {
    "purchase": "PAYMENT", "click": "CASH_OUT", "view": "DEBIT", "signup": "CASH_IN",
    "error": "TRANSFER",
}
FIXTURE_EPOCH = "2024-01-01"
BAD_TIME = "CORRUPTED_TIMESTAMP_9999-99-99"
PRODUCER = "producer-1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who, when and how much: the columns of a transaction no dimension is needed for."""
    n = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("EVT-"), F.lpad(n.cast("string"), 16, "0")).alias("event_id"),
        C.whole_second(F.col("ts")).alias("event_time"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("customer_id"),
        F.col("value").alias("amount"),
    )


def joined_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events beside their rows of the dimensions: all that a transaction is made of, and nothing derived."""
    n, k = F.col("n"), F.col("k")
    kind = F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])
    ev = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("n"),
        F.col("user_id"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
        F.col("value"),
        kind[F.col("event_type")].alias("transaction_type"),
        C.whole_second(F.col("ts")).alias("event_time"),
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    home = nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_country")
    )
    away = nation.select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("merchant_country")
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_nationkey", "c_acctbal",
        F.col("c_mktsegment").alias("customer_segment"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("suppkey"), "s_nationkey", "s_acctbal"
    )
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("partkey"), F.col("p_type").alias("merchant_category")
    )
    ev = keys = ev.withColumns({"suppkey": (k % 10).cast("bigint"), "partkey": k.cast("bigint")})
    for dim, key in (
        (customer, "user_id"), (home, "c_nationkey"), (supplier, "suppkey"),
        (away, "s_nationkey"), (part, "partkey"),
    ):
        ev = join_dimension_by_weight(ev, dim, key, n, weigh=keys if key in keys.columns else None)
    return ev.withColumns({
        "event_id": F.concat(F.lit("EVT-"), F.lpad(n.cast("string"), 16, "0")),
        "customer_id": F.concat(F.lit("C"), F.col("user_id").cast("string")),
    })


def base_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event with its customer and merchant attributes, before
    features and before any fault."""
    rows = joined_events(spark, sf_dir)
    return rows.select(*transaction_columns())


def transaction_columns() -> list[Column]:
    """The columns of a transaction over rows of :func:`joined_events`."""
    n, k = F.col("n"), F.col("k")
    delay = F.when(n % 50 == 0, 300 + 60 * (n % 355)).otherwise(n % 30)
    transfer = F.col("transaction_type") == "TRANSFER"
    fraud = transfer & (k >= 75)
    filed = (fraud & (n % 20 < 17)) | (~fraud & (n % 50 == 3))
    customer_id = F.col("customer_id")
    slot = (F.col("user_id") % 3).cast("int")
    moved = F.round(F.col("c_acctbal") - F.col("value"), 2)
    days = F.date_diff(F.to_date("event_time"), F.lit(FIXTURE_EPOCH).cast("date"))
    step = days * 24 + F.hour("event_time") + 1
    ip = F.concat_ws(
        ".", F.lit("10"), (F.col("user_id") / 65536 % 256).cast("int"),
        (F.col("user_id") / 256 % 256).cast("int"), (F.col("user_id") % 256).cast("int"),
    )
    risk = F.when(n % 33 == 0, None).otherwise(k / 100)
    return [
        n, k,
        F.col("event_id"),
        F.col("event_time"),
        C.plus_seconds(F.col("event_time"), delay).alias("arrival_time"),
        step.alias("step"),
        C.schema_version(step).alias("schema_version"),
        F.col("transaction_type"),
        F.col("value").alias("amount"),
        customer_id,
        F.concat(F.lit("M"), k.cast("string")).alias("merchant_id"),
        F.col("c_acctbal").alias("balance_before"),
        F.when(transfer & (n % 3 == 0), F.col("c_acctbal")).otherwise(moved).alias("balance_after"),
        F.col("s_acctbal").alias("dest_balance_before"),
        F.round(F.col("s_acctbal") + F.col("value"), 2).alias("dest_balance_after"),
        fraud.cast("int").alias("is_fraud"),
        (fraud & (F.col("value") > 100)).cast("int").alias("is_flagged_fraud"),
        *(F.col(c) for c in ("customer_segment", "customer_country", "merchant_country", "merchant_category")),
        slot.alias("device_slot"),
        C.device_id(customer_id, slot).alias("device_id"),
        C.assign_stable(customer_id, C.DEVICE_TYPES, "device").alias("device_type"),
        (n % 50).cast("int").alias("device_age_days"),
        C.new_device((n % 50).cast("int")).alias("new_device_flag"),
        risk.alias("merchant_risk_score"),
        F.when(n % 40 == 5, "nan").otherwise(ip).alias("ip_address"),
        F.when(step >= C.FIRST_V2_STEP, (n % 101) / 100).alias("ip_risk_score"),
        F.when(filed, "Filed").otherwise("None").alias("chargeback_status"),
        F.lit(0).alias("duplicate_event_flag"),
        (n % 50 == 0).cast("int").alias("late_arrival_flag"),
        (n % 25 == 24).cast("int").alias("out_of_order_flag"),
        C.traffic_period(step).alias("traffic_period"),
    ]


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enhanced transactions: base rows plus per-customer features and drift.

    The history runs several jobs over its rows and shuffles them. So the joined rows are
    written once, with which the dimensions are sent out once, and what is derived from a
    row is derived after the shuffle.
    """
    narrow = stored(joined_events(spark, sf_dir), "joined")
    past = with_history(narrow.withColumn("amount", F.col("value")), key="customer_id", ts="event_time", seq="event_id", amount="amount", widths=(300, 3600))
    derived = past.select(*transaction_columns(), *(c for c in past.columns if c.startswith("h_")))
    rows = derived.select(*(c for c in derived.columns if not c.startswith("h_")), *feature_columns())
    drifted = (F.col("is_fraud") == 1) & (F.col("step") > 360)
    risk = F.col("merchant_risk_score")
    return rows.withColumn(
        "merchant_risk_score", F.when(drifted, F.least(risk * 1.4, F.lit(1.0))).otherwise(risk)
    )


def with_faults(tx: DataFrame) -> DataFrame:
    """Delivery rows: bad values, re-deliveries and content copies, times as text."""
    n = F.col("n")
    amount = F.when(n % 200 == 7, -F.col("amount")).when(n % 200 == 37, 1e17).when(n % 200 != 11, F.col("amount"))
    event_text = F.when(n % 200 == 13, BAD_TIME).otherwise(C.iso_text(F.col("event_time")))
    risk = F.when(n % 200 == 17, 99.9).when(n % 200 == 41, 1e13).otherwise(F.col("merchant_risk_score"))
    flag = F.when(n % 200 == 43, 2147483647).otherwise(F.col("geo_anomaly_flag"))
    named = F.when(n % 200 == 29, "").when(n % 200 != 23, F.col("d.event_id"))

    def delivery(extra: int, event_id, duplicate: int):
        return F.struct(
            event_id.alias("event_id"), F.lit(extra).alias("delay"), F.lit(duplicate).alias("dup")
        )

    copy_id = F.concat(F.lit("EVT-D"), F.lpad(n.cast("string"), 15, "0"))
    deliveries = F.array_compact(
        F.array(
            delivery(0, F.col("event_id"), 0),
            F.when(n % 67 == 0, delivery(60, F.col("event_id"), 0)),
            F.when(n % 71 == 0, delivery(120, copy_id, 1)),
        )
    )
    rows = tx.select("*", F.explode(deliveries).alias("d"))
    return rows.withColumns(
        {
            "event_id": named,
            "geo_anomaly_flag": flag,
            "transaction_type": F.when(n % 200 != 31, F.col("transaction_type")),
            "duplicate_event_flag": F.col("d.dup"),
            "amount": amount,
            "merchant_risk_score": risk,
            "arrival_time": C.iso_text(C.plus_seconds(F.col("arrival_time"), F.col("d.delay"))),
            "event_time": event_text,
        }
    ).drop("d")


def messages(tx: DataFrame) -> DataFrame:
    """Message bodies as a consumer gets them; some are cut short."""
    built = build_envelope(with_faults(tx), PRODUCER, F.col("arrival_time"))
    cut = F.expr("substring(body, 1, length(body) - 1)")
    return built.select(
        "n", "arrival_time", F.when(F.col("n") % 500 == 499, cut).otherwise(F.col("body")).alias("body")
    )
