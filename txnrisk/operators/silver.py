"""Clean rows: validity split, de-duplication, derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.operators.envelope import flatten, message_status, parse_times
from txnrisk.storage import held_within, stored

#: Size in memory up to which the ids that come more than once are sent to every task.
REPEATED_BYTES = 16 << 20
#: Of more ids, bitmaps are sent: a bitmap's bits, bits for an id, and the most bitmaps.
BITMAP_BITS, ID_BITS, MOST_BITMAPS = 32_768, 32, 4096

# Thresholds and weights of the derived columns.
RISK_TIERS = {"HIGH": 0.75, "MEDIUM": 0.40}
SIGNAL_WEIGHTS = {"geo_anomaly_flag": 3, "new_device_flag": 2, "duplicate_event_flag": 1}
BURST_EVENTS, BURST_WEIGHT = 5, 4
HIGH_RISK_WEIGHT = 3

#: Beyond these, exact sums or the signal score would not fit their types, and one row would stop a run.
LARGEST_MONEY, LARGEST_RISK = "1e15D", "1e9D"
MONEY = ("amount", "balance_before", "balance_after", "lifetime_spend")
UNREPRESENTABLE = " OR ".join(
    [f"coalesce(abs({c}) >= {LARGEST_MONEY}, FALSE)" for c in MONEY]
    + [f"coalesce(abs(merchant_risk_score) >= {LARGEST_RISK}, FALSE)"]
)
BAD_FLAG = " OR ".join(f"coalesce({c} NOT IN (0, 1), FALSE)" for c in SIGNAL_WEIGHTS)

# An empty id is as good as none: such a row could not be told from another.
VALID = (
    "coalesce(event_id, '') <> '' AND event_time IS NOT NULL AND transaction_type IS NOT NULL AND amount > 0 "
    f"AND NOT ({UNREPRESENTABLE}) AND NOT ({BAD_FLAG})"
)

#: reason -> predicate that puts a row into quarantine
QUARANTINE_REASONS = {
    "missing_event_id": "coalesce(event_id, '') = ''",
    "malformed_event_time": "event_time IS NULL",
    "missing_type": "transaction_type IS NULL",
    "null_amount": "amount IS NULL",
    "non_positive_amount": "amount <= 0",
    "unrepresentable_value": UNREPRESENTABLE,
    "flag_out_of_range": BAD_FLAG,
}
#: reported, but no reason for quarantine
REPORT_ONLY_REASONS = {
    "risk_out_of_range": "merchant_risk_score < 0 OR merchant_risk_score > 1",
}


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key. Each map task already keeps one row per key
    (``WindowGroupLimit`` before the exchange), so copies do not pile up."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def few_ids(ids: DataFrame, otherwise: str = "shuffle_hash") -> DataFrame:
    """Stored ids for a semi or anti join of wide rows: sent to every task, which leaves the rows where they
    are; where they are too many, the rows are shuffled, but not sorted.

    Without a hint, Spark would send out what its files pack into 10 MB: over a million ids.
    """
    return F.broadcast(ids) if held_within(ids, REPEATED_BYTES) else ids.hint(otherwise)


def bit_at(bits: str, place: Column) -> Column:
    """The bit of a bitmap at a place, numbered as ``bitmap_construct_agg`` does."""
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(place % BITMAP_BITS / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int"))


def sifted(rows: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``event_id`` may be among the stored ``ids``, rows whose id surely isn't).

    Every task gets some bits for an id instead of the id, and finds a row by the hash of its id. So all
    rows of one id, or without an id, are in the same part; of other rows, about one in ``ID_BITS`` comes along.
    """
    bitmaps = min(max(1, -(-ids.count() * ID_BITS // BITMAP_BITS)), MOST_BITMAPS)
    place = F.pmod(F.xxhash64("event_id"), F.lit(bitmaps * BITMAP_BITS))
    bitmap = F.floor(place / BITMAP_BITS).alias("_bitmap")
    bits = ids.select(bitmap, (place % BITMAP_BITS).alias("at")).groupBy("_bitmap").agg(F.bitmap_construct_agg("at").alias("_bits"))
    found = rows.select("*", bitmap).join(F.broadcast(stored(bits, "bitmaps")), "_bitmap", "left")
    may = F.coalesce(bit_at("_bits", place) != 0, F.lit(False))
    return found.where(may).select(*rows.columns), found.where(~may).select(*rows.columns)


def split_by_ids(rows: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``event_id`` is among the stored ``ids``, all others); both are cheap to read again."""
    if held_within(ids, REPEATED_BYTES):
        few = F.broadcast(ids)
        return tuple(rows.join(few, "event_id", how).select(*rows.columns) for how in ("left_semi", "left_anti"))
    may, others = sifted(rows, ids)
    hit, miss = (may.join(ids.hint("shuffle_hash"), "event_id", how).select(*rows.columns) for how in ("left_semi", "left_anti"))
    return hit, others.unionByName(miss)


def split_valid(df: DataFrame, strict_reference: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows). Every row is in exactly one of the two.

    ``strict_reference`` reproduces three-valued logic on a NULL amount: such a
    row is then in neither.
    """
    valid = F.coalesce(F.expr(VALID), F.lit(False))
    bad = F.expr(f"NOT ({VALID})") if strict_reference else ~valid
    return df.where(valid), df.where(bad)


def quarantine_reasons(df: DataFrame, report_only: bool = True) -> DataFrame:
    """Add ``reasons``, the list of everything wrong with a row."""
    checks = QUARANTINE_REASONS | (REPORT_ONLY_REASONS if report_only else {})
    found = [F.when(F.expr(test), F.lit(reason)) for reason, test in checks.items()]
    return df.withColumn("reasons", F.array_compact(F.array(*found)))


def dedup_events(df: DataFrame) -> DataFrame:
    """One row per event id: the earliest arrival, then the earliest produced,
    then the smallest content hash."""
    order = [F.col("arrival_time").asc_nulls_last(), F.col("produced_at"), F.xxhash64(*df.columns)]
    return keep_one(df, ["event_id"], order)


def dedup_stored(df: DataFrame) -> DataFrame:
    """:func:`dedup_events` for stored rows with ids: only ids that come again are sorted and shuffled.

    The ids are counted first. Where those that repeat are too many to send to
    every task, the few rows that :func:`sifted` takes for such go along.
    """
    again = stored(df.groupBy("event_id").count().where("count > 1").select("event_id"), "repeated-ids")
    copies, once = split_by_ids(df, again) if held_within(again, REPEATED_BYTES) else sifted(df, again)
    return once.unionByName(dedup_events(copies))


def add_date_parts(df: DataFrame) -> DataFrame:
    t = F.col("event_time")
    return df.select(
        "*", F.year(t).alias("year"), F.month(t).alias("month"), F.dayofmonth(t).alias("day")
    )


def _signal_score() -> Column:
    burst = F.when(F.col("velocity_5min") >= BURST_EVENTS, BURST_WEIGHT).otherwise(0)
    risky = F.when(F.col("merchant_risk_score") >= RISK_TIERS["HIGH"], HIGH_RISK_WEIGHT).otherwise(0)
    score = burst + risky
    for flag, weight in SIGNAL_WEIGHTS.items():
        score = score + F.col(flag) * weight  # a NULL flag makes the score NULL
    return score


def _risk_tier() -> Column:
    tier = F.lit("LOW")
    for name, least in sorted(RISK_TIERS.items(), key=lambda kv: kv[1]):
        tier = F.when(F.col("merchant_risk_score") >= least, name).otherwise(tier)
    return tier


def add_silver_columns(df: DataFrame, processed_at: str) -> DataFrame:
    """Balance checks, risk tier, signal score and the run's time stamp."""
    unmoved = "transaction_type = 'TRANSFER' AND balance_after = balance_before AND amount > 0"
    return df.select(
        "*",
        (F.col("balance_after") - F.col("balance_before")).alias("balance_delta"),
        F.when(F.expr(unmoved), 1).otherwise(0).alias("balance_mismatch_flag"),
        _risk_tier().alias("merchant_risk_tier"),
        _signal_score().alias("rule_signal_score"),
        F.lit(processed_at).alias("processed_at"),
    )


#: Where a message of a load ends up; each has an output of its own.
OUTCOMES = ["valid", "corrupted", "dead_letter"]


def classified_rows(messages: DataFrame) -> DataFrame:
    """Typed rows with their ``outcome``; only a dead letter keeps its body.

    A message without an event id is corrupted: it is quarantined with that reason.
    """
    status = message_status(messages)
    dead = F.when(F.col("status") == "dead_letter", F.col("body")).alias("body")
    rows = parse_times(flatten(status.withColumns({"body": dead}), keep=["status", "body"]))
    valid = F.coalesce(F.expr(VALID), F.lit(False))
    outcome = F.when(F.col("status") == "dead_letter", "dead_letter").when(valid, "valid")
    return rows.withColumn("outcome", outcome.otherwise("corrupted")).drop("status")


def to_silver(valid: DataFrame, processed_at: str) -> DataFrame:
    """Valid parsed rows, stored -> the 47 Silver columns."""
    return add_silver_columns(add_date_parts(dedup_stored(valid)), processed_at)
