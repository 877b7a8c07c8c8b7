"""Structured Streaming: the online scorer, stream de-duplication, sliding counts,
incremental Silver.

State that must outlive a micro-batch and may be large for one customer (event
times, processed ids) is kept in tables partitioned by time, not in a per-key
state function: a hot customer then spreads over tasks like in the batch job.
Every output of a batch goes to a folder of that batch id, replaced as a whole,
and a batch reads only what smaller ids wrote. The clock of a batch is kept in a
record that is written before anything else, so a repeated batch, also one after
midnight, gives the same result in the same places.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnrisk.operators import envelope, history, ledger, rules, silver
from txnrisk.operators.quality import processing_stats
from txnrisk.sources.files import DATE_PARTS, TEXT_CODEC, by_partition, drop_partitions_before, read_or_empty, remove
from txnrisk.storage import join_dimension, open_folders, stored

# Lifetime of velocity state, lateness covered, window sizes.
VELOCITY_WINDOWS = {"velocity_5min_live": 300, "velocity_1hour_live": 3600}
LATENESS = "6 hours"
DEDUP_HORIZON = "24 hours"

LEDGER_SCHEMA = "event_id string, processed_at timestamp_ntz, processed_date date, batch_id bigint"
TIMES_SCHEMA = "customer_id string, event_time timestamp_ntz, event_date date, batch_id bigint"


def read_stream(
    spark: SparkSession, path: str, max_files: int | None = None, fmt: str = "text", **options: str
) -> DataFrame:
    """Messages as they arrive, one ``body`` per row.

    ``fmt='kafka'`` reads a topic where the connector is installed; the rate is
    then set by ``maxOffsetsPerTrigger`` instead of ``max_files``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        return reader.load().select(F.col("value").cast("string").alias("body"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.option("recursiveFileLookup", "true").load(path).withColumnRenamed("value", "body")


def parse_stream(messages: DataFrame) -> DataFrame:
    """Readable messages as typed rows, times by the online rules."""
    return envelope.parse_envelope(messages, fallback=F.lit(None).cast("timestamp_ntz"))


def with_lateness(rows: DataFrame, ts: str = "event_time", delay: str = LATENESS) -> DataFrame:
    """Watermark that covers the longest documented delay."""
    return rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def dedup_stream(rows: DataFrame, horizon: str = DEDUP_HORIZON) -> DataFrame:
    """First delivery of each event id within the horizon. Rows behind the
    watermark are dropped here; use the ledger where they must be kept."""
    timed = rows.withColumn("arrival_time", F.col("arrival_time").cast("timestamp"))
    return timed.withWatermark("arrival_time", horizon).dropDuplicatesWithinWatermark(["event_id"])


def sliding_counts(
    rows: DataFrame, key: str = "customer_id", ts: str = "event_time",
    size: str = "1 hour", slide: str = "5 minutes",
) -> DataFrame:
    """Events per key in sliding windows; the same expression on batch and stream."""
    counts = rows.groupBy(key, F.window(ts, size, slide).alias("w")).agg(F.count("*").alias("events"))
    return counts.select(key, F.col("w.start").alias("window_start"), "events")


def enrich_with_dims(rows: DataFrame, customers: DataFrame, merchants: DataFrame) -> DataFrame:
    """Stream or batch rows with customer and merchant attributes."""
    merchants = merchants.select(
        "merchant_id", F.col("merchant_category").alias("dim_merchant_category")
    )
    customers = customers.select("customer_id", "home_country", "risk_profile")
    out = join_dimension(rows, customers, "customer_id", F.col("event_id"))
    return join_dimension(out, merchants, "merchant_id", F.col("event_id"))


def run_to_table(stream: DataFrame, path: str, mode: str = "append") -> StreamingQuery:
    """Write everything available to Parquet, then stop. The checkpoint beside
    the table makes the next call continue where this one ended."""
    writer = stream.writeStream.outputMode(mode).format("parquet")
    return (
        writer.option("path", path).option("checkpointLocation", f"{path}.checkpoint")
        .trigger(availableNow=True).start()
    )


def updates_to_table(stream: DataFrame, path: str) -> StreamingQuery:
    """Write each batch's changed rows below its id, for everything available, then stop.

    With :func:`newest_rows` these give every row in its last state, also those
    that a watermark would still keep open.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", f"{path}.checkpoint").trigger(availableNow=True).start()
    )


def newest_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Of what :func:`updates_to_table` wrote, the last version of each key."""
    log = spark.read.parquet(path)
    return silver.keep_one(log, keys, [F.desc("batch_id")]).drop("batch_id")


def write_batch(df: DataFrame, path: str, batch_id: int, by: list[str], name: str = "batch_id") -> None:
    """The rows of one batch by folder, in place of all that the batch wrote before."""
    with open_folders(df.sparkSession):
        by_partition(df, by).write.mode("overwrite").partitionBy(*by).parquet(f"{path}/{name}={batch_id}")


def days_of(df: DataFrame, column: str, most: int = 1000) -> list | None:
    """The different days of a batch; None if there are more than ``most``."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()
    return None if len(rows) > most else [r[0] for r in rows]


# ---------------------------------------------------------------- live velocity over stored times


def live_velocity(
    batch: DataFrame, stored: DataFrame, windows: dict[str, int] | None = None
) -> DataFrame:
    """Distinct event times per customer within each window, over the batch and
    the times stored by earlier batches, up to each event's own time."""
    windows = windows or VELOCITY_WINDOWS
    new = batch.withColumn("_new", F.lit(True))
    old = stored.select("customer_id", "event_time").distinct()
    both = new.unionByName(
        old.withColumns({"_new": F.lit(False), "event_id": F.lit("")}), allowMissingColumns=True
    )
    counted = history.velocity_live(both, windows)
    return counted.where("_new").drop("_new")


@dataclass
class OnlineJob:
    """Parse, skip processed, count velocity, apply rules, store, alert, mark.

    The ``consumer`` profile takes the velocity that came with the event, so it
    keeps no event times.
    """

    base: str
    profile: str = "online"
    now: str | None = None

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def start(self, messages: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        return (
            messages.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", self.path("checkpoint"))
            .trigger(**(trigger or {"availableNow": True})).start()
        )

    def clock(self, spark: SparkSession, batch_id: int) -> str:
        """The batch's clock: what an earlier try of it recorded, or now."""
        path = f"{self.path('clock')}/batch_id={batch_id}"
        kept = read_or_empty(spark, path, "value string").first()
        if kept:
            return kept.value
        text = self.now or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
        spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").parquet(path)
        return text

    def process(self, messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        began, now_text = time.monotonic(), self.clock(spark, batch_id)
        now = F.expr(f"timestamp_ntz'{now_text}'")
        # shared by several outputs; lost blocks are recomputed from the source
        missing = "skipped" if self.profile == "online" else "dead_letter"
        status = envelope.message_status(messages, missing_id=missing)
        status = status.persist(StorageLevel.MEMORY_AND_DISK)
        parsed = status.where("status = 'parsed'")
        rows = envelope.parse_times(envelope.flatten(parsed, keep=["body"]), fallback=now)
        rows = rows.withColumn("customer_id", F.coalesce("customer_id", F.lit("")))
        known = read_or_empty(spark, self.path("ledger"), LEDGER_SCHEMA)
        known = known.where(F.col("batch_id") < batch_id)
        fresh = ledger.filter_kept(rows, known, now).persist(StorageLevel.MEMORY_AND_DISK)
        # the bodies are stored from here: they would be shuffled with each row's history
        scored = self._score(fresh.drop("body"), batch_id).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._write(status, fresh.select("body"), scored, now, now_text, batch_id, began)
        finally:
            for shared in (scored, fresh, status):
                shared.unpersist()

    def _score(self, fresh: DataFrame, batch_id: int) -> DataFrame:
        if self.profile != "online":
            return rules.apply_rules(fresh, self.profile)
        spark = fresh.sparkSession
        times = read_or_empty(spark, self.path("times"), TIMES_SCHEMA)
        stored = times.where(F.col("batch_id") < batch_id)
        # Days of the batch and the days before them, not all between the first and the last: one
        # event with a far-off time doesn't open the whole store. Only customers of the batch count.
        days = days_of(fresh.select(F.to_date("event_time").alias("d")), "d")
        if days is not None:
            reach = range(-(-max(VELOCITY_WINDOWS.values()) // 86400) + 1)
            stored = stored.where(F.col("event_date").isin([d - timedelta(days=k) for d in days for k in reach]))
        stored = stored.join(fresh.select("customer_id").distinct(), "customer_id", "left_semi")
        return rules.apply_rules(live_velocity(fresh, stored))

    def _write(self, status: DataFrame, bodies: DataFrame, scored: DataFrame, now: Column, now_text: str, batch_id: int, began: float) -> None:
        part = f"batch_id={batch_id}"
        dead = status.where("status = 'dead_letter'").select("body")
        dead.write.mode("overwrite").text(f"{self.path('dead_letters')}/{part}")
        bodies.withColumnRenamed("body", "value").write.mode("overwrite").text(
            f"{self.path('bronze')}/{part}/" + "/".join(f"{n}={v}" for n, v in zip(DATE_PARTS, now_text[:10].split("-"))),
            TEXT_CODEC,
        )
        events = scored.withColumns({"processed_at": now, "event_date": F.to_date("event_time")})
        self._write_batch(events, "events", batch_id, ["event_date"])
        records = rules.alert_records(scored, self.profile, now_text)
        records.write.mode("overwrite").json(f"{self.path('alerts')}/{part}")

        if self.profile == "online":
            times = scored.select("customer_id", "event_time").distinct()
            self._write_batch(times.withColumn("event_date", F.to_date("event_time")), "times", batch_id, ["event_date"])

        done = scored.select("event_id", "is_flagged", F.lit("processed").alias("status"))
        unread = status.where("status <> 'parsed'").select(
            F.lit(None).cast("string").alias("event_id"), F.lit(False).alias("is_flagged"), "status"
        )
        stats = processing_stats(done.unionByName(unread))
        read = status.agg(F.count("*").alias("messages"))
        stats = stats.select("*", read.scalar().alias("messages")).withColumn(
            "skipped", F.col("messages") - F.col("processed") - F.col("errors")
        ).withColumns({"started_at": F.lit(now_text), "seconds": F.lit(time.monotonic() - began)})
        stats.write.mode("overwrite").json(f"{self.path('stats')}/{part}")
        # last: only a batch whose outputs are complete is marked as processed
        self._write_batch(ledger.mark_processed(scored, now), "ledger", batch_id, ["processed_date"])

    def _write_batch(self, df: DataFrame, name: str, batch_id: int, by: list[str]) -> None:
        write_batch(df, self.path(name), batch_id, by)

    def expire(self, spark: SparkSession, times_from: str, events_from: str, ledger_from: str) -> None:
        """Drop entries dated before the given days, in every batch's folder: no rewrite."""
        drop_partitions_before(spark, self.path("times"), "event_date", times_from)
        drop_partitions_before(spark, self.path("events"), "event_date", events_from)
        drop_partitions_before(spark, self.path("ledger"), "processed_date", ledger_from)


def run_statistics(spark: SparkSession, base: str) -> DataFrame:
    """One row for all batches of a job: how many, their counters, and messages per second of work."""
    stats = spark.read.json(f"{base}/stats")
    sums = [F.sum(c).alias(c) for c in ("messages", "processed", "skipped", "errors", "flagged")]
    total = stats.agg(F.count("*").alias("batches"), *sums, F.round(F.sum("seconds"), 3).alias("seconds"))
    flag_rate = F.round(F.col("flagged") * 100 / F.greatest("processed", F.lit(1)), 1)
    return total.select("*", flag_rate.alias("flag_rate_pct"), F.round(F.col("messages") / F.col("seconds"), 1).alias("messages_per_second"))


def scored_events(spark: SparkSession, base: str) -> DataFrame:
    """Enriched events, newest version of each id."""
    return ledger.latest_events(spark.read.parquet(f"{base}/events"))


# ---------------------------------------------------------------- incremental Silver


@dataclass
class IncrementalSilver:
    """Bronze -> Silver for files not seen before; every output has a folder per ``load_id``.

    Ids of earlier loads are looked up only on the event dates of this load: a
    message delivered again carries the same event time. Each message of a load is
    in Silver, a repeat, in quarantine or a dead letter; ``counts`` says how many.
    """

    base: str
    run_ts: str

    IDS = "event_id string, event_date date, load_id bigint"

    def start(self, messages: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        return (
            messages.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", f"{self.base}/checkpoint")
            .trigger(**(trigger or {"availableNow": True})).start()
        )

    def process(self, messages: DataFrame, batch_id: int) -> None:
        spark, part = messages.sparkSession, f"load_id={batch_id}"
        # The text is parsed once; each output reads its own folder of the staged rows.
        staging = f"{self.base}/staging/{part}"
        staged = silver.classified_rows(messages)
        with open_folders(spark):
            staged.write.mode("overwrite").partitionBy("outcome").parquet(staging)
        rows = spark.read.schema(staged.schema).parquet(staging)
        good, bad, dead = [rows.where(F.col("outcome") == n).drop("outcome") for n in silver.OUTCOMES]
        clean = silver.to_silver(good.drop("body"), self.run_ts).withColumn("event_date", F.to_date("event_time"))
        before = read_or_empty(spark, f"{self.base}/ids", self.IDS).where(F.col("load_id") < batch_id)
        days = days_of(good.select(F.to_date("event_time").alias("d")), "d")
        if days is not None:
            before = before.where(F.col("event_date").isin(days))
        # Whole rows aren't shuffled to be compared: which ids of the load came before is found by the ids alone.
        asked = good.select(F.to_date("event_time").alias("event_date"), "event_id")
        before = silver.few_ids(before.select("event_date", "event_id"), "merge")
        known = stored(asked.join(before, ["event_date", "event_id"], "left_semi").distinct(), "known-ids")
        fresh = clean.join(silver.few_ids(known), ["event_date", "event_id"], "left_anti")
        write_batch(fresh.drop("event_date"), f"{self.base}/silver", batch_id, DATE_PARTS, "load_id")
        silver.quarantine_reasons(bad.drop("body")).write.mode("overwrite").json(f"{self.base}/quarantine/{part}")
        dead.select("body").write.mode("overwrite").text(f"{self.base}/dead_letters/{part}")
        written = read_or_empty(spark, f"{self.base}/silver/{part}", "event_id string, event_time timestamp_ntz")
        counts = rows.agg(F.count("*").alias("input"), *(F.count_if(F.col("outcome") == n).alias(n) for n in silver.OUTCOMES))
        counts = counts.select("*", written.agg(F.count("*")).scalar().alias("output"))
        counts.withColumn("repeated", F.col("valid") - F.col("output")).write.mode("overwrite").json(f"{self.base}/counts/{part}")
        # last: only a load whose outputs are complete hides its events from later ones
        ids = written.select("event_id", F.to_date("event_time").alias("event_date"))
        write_batch(ids, f"{self.base}/ids", batch_id, ["event_date"], "load_id")
        remove(spark, staging)
