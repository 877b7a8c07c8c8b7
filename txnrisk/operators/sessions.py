"""Sessions of a customer's events, and fraud patterns that show only over several of them.

A session goes on while gaps stay within a limit. Starts are found, and numbered,
by the history scan, so neither step puts a customer into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.functions.columns import MICROS, cents, micros
from txnrisk.operators.history import with_history

#: Small amounts in one session from which it looks like card testing.
BURST = 3
# Patterns over the events of a session.
SESSION_PATTERNS = {
    "card_testing": "small_events >= {burst}",
    "account_takeover": "new_device_events > 0 AND geo_anomaly_events > 0",
}


def with_sessions(df: DataFrame, gap_seconds: int, key="customer_id", ts="event_time", seq="event_id") -> DataFrame:
    """Rows with ``session``, numbered from 1 per key in the order (ts, seq); NULL without a time."""
    before = with_history(df, key=key, ts=ts, seq=seq)
    gap = micros(F.col(ts)) - F.col("h_prev_us")
    starts = F.when(F.col("h_prev_us").isNull() | (gap > gap_seconds * MICROS), 1).otherwise(0)
    marked = before.select(*df.columns, starts.alias("_start"))
    numbered = with_history(marked, key=key, ts=ts, seq=seq, amount="_start")
    session = (F.col("h_sum") + F.col("_start")).cast("bigint")
    return numbered.select(*df.columns, F.when(F.col(ts).isNotNull(), session).alias("session"))


def session_patterns(rows: DataFrame, gap_seconds: int, small_amount: float, burst: int = BURST) -> DataFrame:
    """One row per customer and session: its time, events, amount, and the patterns it shows."""
    small = F.col("amount") <= small_amount
    found = with_sessions(rows, gap_seconds).where("session is not null").groupBy("customer_id", "session").agg(
        F.min("event_time").alias("first_time"), F.max("event_time").alias("last_time"), F.count("*").alias("events"),
        F.count_if(small).alias("small_events"), F.count_if(F.col("new_device_flag") == 1).alias("new_device_events"),
        F.count_if(F.col("geo_anomaly_flag") == 1).alias("geo_anomaly_events"),
        F.round(F.sum(cents(F.col("amount"))), 2).cast("double").alias("amount"),
    )
    hits = [F.when(F.expr(test.format(burst=burst)), F.lit(name)) for name, test in SESSION_PATTERNS.items()]
    return found.withColumn("patterns", F.array_compact(F.array(*hits)))
