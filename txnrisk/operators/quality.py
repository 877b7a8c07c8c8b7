"""Data-quality detectors and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.functions.columns import MICROS, micros
from txnrisk.operators.envelope import message_status
from txnrisk.operators.gold import mean_of
from txnrisk.operators.silver import VALID, keep_one

#: What makes two events the same transaction, whatever their ids.
CONTENT_COLUMNS = [
    "step", "event_time", "transaction_type", "amount", "customer_id", "merchant_id",
    "balance_before", "balance_after",
]
RISK_BINS = 10
EMPTY_BIN = 0.0001


def delay_seconds(event: str = "event_time", arrival: str = "arrival_time") -> Column:
    return (micros(F.col(arrival)) - micros(F.col(event))) / F.lit(MICROS)


def flag_late(df: DataFrame, minutes: float = 5) -> DataFrame:
    """1 when an event arrived more than ``minutes`` after it happened."""
    late = F.coalesce(delay_seconds() > minutes * 60, F.lit(False))
    return df.select(
        "*", F.when(late, 1).otherwise(0).alias("is_late"),
        F.round(delay_seconds() / 60, 2).alias("delay_minutes"),
    )


def flag_content_duplicates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """1 for every copy of a transaction after its first arrival under another id.

    Event ids must be unique (run ``dedup_events`` first). The first of each
    content is found with a map-side limit of one row per content; it is then
    marked by content *and* id, so the copies of one content stay spread out.
    """
    content = F.md5(F.to_json(F.struct(*(columns or CONTENT_COLUMNS))))
    rows = df.withColumn("content_key", content)
    narrow = rows.select("content_key", "event_id", "arrival_time")
    order = [F.col("arrival_time").asc_nulls_last(), F.col("event_id")]
    first = keep_one(narrow, ["content_key"], order).select(
        "content_key", "event_id", F.lit(0).alias("_first")
    )
    marked = rows.join(first, ["content_key", "event_id"], "left")
    return marked.select(*df.columns, F.coalesce("_first", F.lit(1)).alias("content_duplicate"))


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values per column, in one pass over the table."""
    counts = df.agg(
        F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in columns]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"m_{c}").alias("null_count")) for c in columns
    ]
    long = counts.select(F.col("n").alias("row_count"), F.inline(F.array(*rows)))
    pct = F.round(F.col("null_count") * 100 / F.greatest("row_count", F.lit(1)), 2)
    return long.select("column_name", "null_count", "row_count", pct.alias("null_pct"))


# Flag section of the validation report.
REPORT_FLAGS = {
    "fraud": "is_fraud = 1",
    "duplicate": "duplicate_event_flag = 1",
    "late": "late_arrival_flag = 1",
    "out_of_order": "out_of_order_flag = 1",
    "v2_with_ip_risk": "schema_version = 'v2' AND ip_risk_score IS NOT NULL",
}


def validation_report(df: DataFrame) -> DataFrame:
    """Counts by schema version and type, flag shares and v2 field presence.

    The table is reduced once to its (version, type) cells; the report is
    unfolded from those.
    """
    cells = df.groupBy("schema_version", "transaction_type").agg(
        F.count("*").alias("n"),
        *[F.count_if(F.expr(test)).alias(name) for name, test in REPORT_FLAGS.items()],
    )

    def line(section: str, item: Column, count: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), item.alias("item"), count.alias("n"))

    lines = [
        line("schema_version", F.col("schema_version"), F.col("n")),
        line("transaction_type", F.col("transaction_type"), F.col("n")),
        line("records", F.lit("all"), F.col("n")),
        *[line("flag", F.lit(name), F.col(name)) for name in REPORT_FLAGS],
    ]
    report = cells.select(F.inline(F.array(*lines))).groupBy("section", "item").agg(
        F.sum("n").alias("records")
    )
    # The report has a few rows; its own "records" line is the total.
    total = F.max(F.when(F.col("section") == "records", F.col("records"))).over(Window.partitionBy(F.lit(0)))
    return report.withColumn("pct", F.round(F.col("records") * 100 / total, 2))


def key_skew(df: DataFrame, key: str) -> DataFrame:
    """How uneven a partitioning key is: keys, hottest key, keys seen once."""
    per_key = df.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.count("*").alias("unique_keys"),
        F.min_by("k", F.struct(-F.col("n"), F.col("k"))).alias("top_key"),
        F.max("n").alias("top_count"),
        F.count_if(F.col("n") == 1).alias("singleton_keys"),
        F.sum("n").alias("records"),
    )


def risk_bin(risk: Column) -> Column:
    return F.least(F.floor(risk * RISK_BINS), F.lit(RISK_BINS - 1)).cast("int")


def drift_report(df: DataFrame, cut: float | None = None) -> DataFrame:
    """Merchant risk of fraud rows before and after a step: means, ratio and PSI.

    Without ``cut`` the halves meet at half of the largest step. Scores outside
    0..1 have no part in these, but are counted.
    """
    limit = F.lit(cut) if cut is not None else df.agg(F.max("step") * 0.5).scalar()
    risk = F.col("merchant_risk_score")
    cells = (
        df.where((F.col("is_fraud") == 1) & risk.isNotNull())
        .groupBy((F.col("step") > limit).alias("later"), F.when(risk.between(0, 1), risk_bin(risk)).alias("bin"))
        .agg(F.count("*").alias("n"), F.sum(F.when(risk.between(0, 1), risk).cast("decimal(18,6)")).alias("total"))
    )

    def summed(value: Column, later: bool, bin_: int | None = None) -> Column:
        here = (F.col("later") == F.lit(later)) & F.col("bin").isNotNull()
        if bin_ is not None:
            here = here & (F.col("bin") == bin_)
        return F.coalesce(F.sum(F.when(here, value)), F.lit(0))

    wide = cells.agg(
        summed(F.col("n"), False).alias("n_first"), summed(F.col("n"), True).alias("n_second"),
        summed(F.col("total"), False).alias("t_first"),
        summed(F.col("total"), True).alias("t_second"),
        F.coalesce(F.sum(F.when(F.col("bin").isNull(), F.col("n"))), F.lit(0)).alias("n_out_of_range"),
        *[summed(F.col("n"), False, b).alias(f"a{b}") for b in range(RISK_BINS)],
        *[summed(F.col("n"), True, b).alias(f"b{b}") for b in range(RISK_BINS)],
    )

    def share(column: str, n: str) -> Column:
        return F.greatest(F.col(column) / F.greatest(F.col(n), F.lit(1)), F.lit(EMPTY_BIN))

    psi = F.lit(0.0)
    for b in range(RISK_BINS):
        before, after = share(f"a{b}", "n_first"), share(f"b{b}", "n_second")
        psi = psi + (after - before) * F.ln(after / before)
    mean_first = mean_of(F.col("t_first"), F.nullif("n_first", F.lit(0)), 4)
    mean_second = mean_of(F.col("t_second"), F.nullif("n_second", F.lit(0)), 4)
    totals = [F.col(t).cast("double") / F.nullif(n, F.lit(0)) for t, n in (("t_second", "n_second"), ("t_first", "n_first"))]
    return wide.select(
        "n_first", "n_second", "n_out_of_range",
        mean_first.alias("mean_first"), mean_second.alias("mean_second"),
        F.round(totals[0] / F.nullif(totals[1], F.lit(0.0)), 4).alias("mean_ratio"),
        F.round(psi, 4).alias("psi"),
    )


def latency_profile(df: DataFrame, minutes: float = 5, accuracy: int | None = None) -> DataFrame:
    """Arrival delay P50/P95/P99 in seconds and the share of late events.

    Exact by default: rows are first counted per delay value, and the quantiles
    are taken over those counts. With ``accuracy`` the delays go through
    ``percentile_approx`` instead, for sources with unbounded distinct delays.
    """
    delays = df.select(delay_seconds().alias("d")).where("d IS NOT NULL")
    late = F.col("d") > minutes * 60
    marks = {"p50_seconds": 0.5, "p95_seconds": 0.95, "p99_seconds": 0.99}
    if accuracy:
        quantiles = [F.percentile_approx("d", p, accuracy).alias(n) for n, p in marks.items()]
        return delays.agg(
            F.count("*").alias("events"), *quantiles,
            F.round(F.count_if(late) * 100 / F.count("*"), 2).alias("late_pct"),
        )
    # Counts per delay, summed up inside minutes and over one row per minute: no task holds all delays.
    counted = delays.groupBy("d").agg(F.count("*").alias("n")).withColumn("minute", F.floor(F.col("d") / 60))
    first = Window.unboundedPreceding
    minutes_before = Window.orderBy("minute").rowsBetween(first, -1)
    carried = counted.groupBy("minute").agg(F.sum("n").alias("m"), F.sum(F.when(late, F.col("n")).otherwise(0)).alias("late"))
    total, late_total = (carried.agg(F.sum(c)).scalar() for c in ("m", "late"))
    carried = carried.select("minute", F.coalesce(F.sum("m").over(minutes_before), F.lit(0)).alias("carried"))
    inside = Window.partitionBy("minute").orderBy("d").rowsBetween(first, -1)
    low = F.col("carried") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    ranked = counted.join(carried, "minute").select("d", low.alias("low"), (low + F.col("n")).alias("high"), total.alias("total"))

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("low") <= place) & (place < F.col("high")), F.col("d")))

    quantiles = []
    for name, p in marks.items():
        place = F.lit(p) * (F.col("total") - 1)
        below, above = at(F.floor(place)), at(F.ceil(place))
        quantiles.append(F.round(below + (above - below) * F.max(place - F.floor(place)), 4).alias(name))
    return ranked.agg(
        F.coalesce(F.max("total"), F.lit(0)).alias("events"), *quantiles,
        F.round(late_total * 100 / F.max("total"), 2).alias("late_pct"),
    )


def label_check(source: DataFrame, silver: DataFrame) -> DataFrame:
    """Do the fraud labels in Silver equal the source's? Compared by event id.

    Both sides are stacked and grouped by id, so repeated deliveries of one
    event collapse before the shuffle.
    """
    labels = ["is_fraud", "is_flagged_fraud"]

    def side(df: DataFrame, mine: str) -> DataFrame:
        columns = [
            (F.col(c) if name == mine else F.lit(None)).cast("int").alias(f"{name}_{c}")
            for name in ("src", "slv") for c in labels
        ]
        return df.select("event_id", F.lit(int(mine == "src")).alias("in_src"), *columns)

    stacked = side(source, "src").unionAll(side(silver, "slv"))
    bounds = [
        agg(f"{name}_{c}").alias(f"{kind}_{name}_{c}")
        for name in ("src", "slv") for c in labels for kind, agg in (("lo", F.min), ("hi", F.max))
    ]
    per_id = stacked.groupBy("event_id").agg(
        F.max("in_src").alias("in_src"), F.max(1 - F.col("in_src")).alias("in_slv"), *bounds
    )
    both = (F.col("in_src") == 1) & (F.col("in_slv") == 1)

    def differs(c: str) -> Column:
        same = [F.col(f"{k}_src_{c}").eqNullSafe(F.col(f"{k}_slv_{c}")) for k in ("lo", "hi")]
        return F.count_if(both & ~(same[0] & same[1])).alias(f"{c}_mismatches")

    return per_id.agg(
        F.count_if(both).alias("compared"),
        F.count_if(F.col("in_slv") == 0).alias("only_in_source"),
        F.count_if(F.col("in_src") == 0).alias("only_in_silver"),
        *[differs(c) for c in labels],
    )


def etl_counters(messages: DataFrame, rows_of, body: str = "body") -> DataFrame:
    """Run counters of raw -> clean in one grouped pass.

    ``rows_of`` turns parsed messages into typed rows and keeps ``status``.
    """
    rows = rows_of(message_status(messages, body))
    valid = (F.col("status") == "parsed") & F.coalesce(F.expr(VALID), F.lit(False))
    outcome = F.when(valid, "valid").when(F.col("status") == "parsed", "corrupted").otherwise(
        F.col("status")
    )
    per_id = rows.groupBy(
        outcome.alias("outcome"), F.when(valid, F.col("event_id")).alias("id")
    ).agg(F.count("*").alias("n"))

    def of(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("outcome") == name, F.col("n"))), F.lit(0))

    output = F.count_if(F.col("outcome") == "valid")
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("input_records"),
        of("dead_letter").alias("dead_letters"), of("skipped").alias("skipped"),
        of("valid").alias("valid_records"), of("corrupted").alias("corrupted_records"),
        (of("valid") - output).alias("duplicates_removed"), output.alias("silver_records"),
    )


def processing_stats(messages: DataFrame, status: str = "status") -> DataFrame:
    """Consumer counters from rows with a status and ``is_flagged``."""
    s = F.col(status)
    flagged = F.count_if((s == "processed") & F.col("is_flagged"))
    processed = F.count_if(s == "processed")
    return messages.agg(
        processed.alias("processed"), F.count_if(s == "skipped").alias("skipped"),
        flagged.alias("flagged"), F.count_if(s == "dead_letter").alias("errors"),
        F.round(flagged * 100 / F.greatest(processed, F.lit(1)), 1).alias("flag_rate_pct"),
    )
