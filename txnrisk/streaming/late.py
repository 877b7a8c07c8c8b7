"""Streams that keep their late rows: de-duplication and sliding counts.

The engine's own watermark drops what comes after it. Here every micro-batch is
split by a recorded one: the newest time that smaller batches have seen, less
the delay. Rows behind it are a side output of the same batch, looked up in the
ledger of their own days, and counted. A batch writes its folders anew when it
runs again and reads only what smaller ids wrote, so it gives the same result.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnrisk.functions.columns import ntz_literal
from txnrisk.operators import ledger
from txnrisk.operators.silver import few_ids
from txnrisk.sources.files import read_or_empty
from txnrisk.storage import observed
from txnrisk.streaming.online import days_of, write_batch

HOUR = 3600
#: Length of the sliding windows, and time between their starts.
SIZE, SLIDE = "1 hour", "5 minutes"


@dataclass
class LateAware:
    """What both jobs share: ``time`` is the column that the watermark follows, ``delay`` its seconds."""

    base: str
    time: str
    delay: int

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def start(self, rows: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        return (
            rows.writeStream.foreachBatch(self.process).option("checkpointLocation", self.path("checkpoint"))
            .trigger(**(trigger or {"availableNow": True})).start()
        )

    def process(self, rows: DataFrame, batch_id: int) -> None:
        spark, seen, kept = rows.sparkSession, Observation(), Observation()
        behind = self._behind(spark, batch_id)
        marked = rows.observe(seen, F.count("*").alias("input"), F.max(self.time).alias("newest"))
        marked = marked.withColumn("late", behind)
        out = self._reduced(rows, marked, batch_id).observe(kept, F.count("*").alias("output"), F.count_if("late").alias("late"))
        self._write(out, batch_id)
        found = {"newest": None, "input": 0, "output": 0, "late": 0} | observed(seen) | observed(kept)
        # last: a batch is seen by later ones only when its rows are there
        record = spark.range(1).select(
            ntz_literal(found["newest"]).alias("newest"),
            *(F.lit(found[c]).cast("bigint").alias(c) for c in ("input", "output", "late")),
        )
        record.coalesce(1).write.mode("overwrite").parquet(f"{self.path('batches')}/batch_id={batch_id}")

    def _behind(self, spark: SparkSession, batch_id: int) -> Column:
        """Is a row behind what smaller batches have seen? A row without a time is not."""
        batches = read_or_empty(spark, self.path("batches"), "newest timestamp_ntz, batch_id bigint")
        newest = batches.where(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
        if newest is None:
            return F.lit(False)
        return F.coalesce(F.col(self.time) < ntz_literal(newest - timedelta(seconds=self.delay)), F.lit(False))

    def _reduced(self, rows: DataFrame, marked: DataFrame, batch_id: int) -> DataFrame:
        """What is written of a batch. Only one action may run over ``marked``, as it is observed; others take ``rows``."""
        raise NotImplementedError

    def _write(self, out: DataFrame, batch_id: int) -> None:
        raise NotImplementedError


@dataclass
class LateAwareDedup(LateAware):
    """First delivery of each event id; deliveries further apart than the delay are different events.

    The written rows are the ledger: they are read on the days of the batch and
    those within the delay of them, whether these are recent or long past.
    """

    time: str = "arrival_time"
    delay: int = 24 * HOUR

    def _reduced(self, rows: DataFrame, marked: DataFrame, batch_id: int) -> DataFrame:
        spark = marked.sparkSession
        first = ledger.first_delivery(marked.select("event_id", F.col(self.time).alias("arrival_time"), "late"))
        first = first.withColumn("day", F.to_date("arrival_time"))
        known = read_or_empty(spark, self.path("events"), "event_id string, arrival_time timestamp_ntz, late boolean, day date, batch_id bigint")
        known = known.where(F.col("batch_id") < batch_id)
        days = days_of(rows.select(F.to_date(self.time).alias("d")), "d")
        if days is not None:
            reach = range(-(self.delay // 86400 + 1), self.delay // 86400 + 2)
            wanted = sorted({d + timedelta(days=k) for d in days for k in reach})
            known = known.where(F.col("day").isin(wanted) | F.col("day").isNull())
        known = known.select("event_id", F.col("arrival_time").alias("before"))
        gap = F.abs(F.unix_micros(F.col("arrival_time").cast("timestamp")) - F.unix_micros(F.col("before").cast("timestamp")))
        near = F.coalesce(gap <= self.delay * 1_000_000, F.lit(True))
        return first.join(few_ids(known.withColumnRenamed("event_id", "id"), "merge"), (F.col("event_id") == F.col("id")) & near, "left_anti")

    def _write(self, out: DataFrame, batch_id: int) -> None:
        write_batch(out, self.path("events"), batch_id, ["late", "day"])


@dataclass
class LateAwareCounts(LateAware):
    """Events per customer in sliding windows, as partial counts of each batch.

    Counts add up, so no window has to stay open for a late row, and none is
    closed to one. All events between two starts of windows are in the same
    windows, so a batch keeps one count for these; :func:`total_counts` deals it
    to the windows, once for all batches.
    """

    time: str = "event_time"
    delay: int = 6 * HOUR

    def _reduced(self, rows: DataFrame, marked: DataFrame, batch_id: int) -> DataFrame:
        counts = marked.groupBy("customer_id", "late", F.window(self.time, SLIDE).alias("w")).agg(F.count("*").alias("events"))
        return counts.select("customer_id", F.col("w.start").alias("slot"), "events", "late")

    def _write(self, out: DataFrame, batch_id: int) -> None:
        write_batch(out, self.path("counts"), batch_id, ["late"])


def first_deliveries(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(f"{base}/events").select("event_id", "arrival_time", F.col("late").cast("boolean").alias("late"))


def total_counts(spark: SparkSession, base: str) -> DataFrame:
    """(customer_id, window_start, events, late_events): partial counts added up."""
    parts = spark.read.parquet(f"{base}/counts")
    late = F.sum(F.when(F.col("late").cast("boolean"), F.col("events")).otherwise(0))
    total = parts.groupBy("customer_id", F.window("slot", SIZE, SLIDE).alias("w")).agg(F.sum("events").alias("events"), late.alias("late_events"))
    return total.select("customer_id", F.col("w.start").alias("window_start"), "events", "late_events")


def batch_record(spark: SparkSession, base: str) -> DataFrame:
    """Per batch: rows in, rows or partial counts out, those of them behind the watermark, newest time."""
    return spark.read.parquet(f"{base}/batches")
