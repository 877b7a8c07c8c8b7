"""An event store with one row per event id, kept up to date by batches.

A batch rewrites only the days it touches: those of its own rows and those that
hold an older version of one of them. Which days these are is first asked of
hashed bitmaps, one set per day, and then of the ids of the days that may hold
one; other days are neither read nor written. Every batch writes the whole new
content of its days beside the old one and then a manifest that points to it, so
a batch that fails or runs again harms nothing, and readers see whole batches.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnrisk.operators.silver import BITMAP_BITS, REPEATED_BYTES, bit_at, few_ids, keep_one, sifted, split_by_ids
from txnrisk.sources.files import by_partition, read_or_empty, remove
from txnrisk.storage import BROADCAST_BYTES, held_within, open_folders, stored

#: Bitmaps of a day; each has 32,768 bits, so that a day of a million ids fills them by less than a half.
BUCKETS = 64
BITS = BITMAP_BITS
MANIFEST = "day date, bucket bigint, bits binary, rows bigint, batch_id bigint"


def _place(event_id: str) -> Column:
    return F.pmod(F.xxhash64(event_id), F.lit(BUCKETS * BITS))


@dataclass
class EventStore:
    """Current events below ``base``, one row per ``event_id``, in folders by ``day``."""

    base: str

    @property
    def data(self) -> str:
        return f"{self.base}/data"

    def manifest(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The newest rows of each day: its batch, and a bitmap per bucket; a day without rows is gone."""
        found = read_or_empty(spark, f"{self.base}/manifest", MANIFEST)
        if before is not None:
            found = found.where(F.col("batch_id") < before)
        newest = F.max("batch_id").over(Window.partitionBy("day"))
        return found.withColumn("newest", newest).where("batch_id = newest and rows > 0").drop("newest")

    def days(self, spark: SparkSession, before: int | None = None) -> dict[date, int]:
        """The batch whose folder holds each day."""
        rows = self.manifest(spark, before).select("day", "batch_id").distinct().collect()
        return {r.day: r.batch_id for r in rows}

    def read(self, spark: SparkSession, schema, days: dict[date, int]) -> DataFrame:
        if not days:
            return spark.createDataFrame([], schema)
        paths = [f"{self.data}/batch_id={b}/day={d.isoformat()}" for d, b in sorted(days.items())]
        names = [f.name for f in schema.fields]
        return spark.read.option("basePath", self.data).schema(schema).parquet(*paths).select(*names)

    def current(self, spark: SparkSession, schema) -> DataFrame:
        """All events as of the last batch."""
        return self.read(spark, schema, self.days(spark))

    def may_hold(self, ids: DataFrame, manifest: DataFrame) -> DataFrame:
        """(event_id, day) of the days whose bitmap has the id's bit: every day that holds it, and few others."""
        asked = ids.select("event_id", _place("event_id").alias("place")).withColumn("bucket", F.floor(F.col("place") / BITS))
        manifest = F.broadcast(manifest) if held_within(manifest, BROADCAST_BYTES) else manifest
        return asked.join(manifest.select("day", "bucket", "bits"), "bucket").where(bit_at("bits", F.col("place")) != 0).select("event_id", "day")

    def upsert(self, rows: DataFrame, batch_id: int, first_day: str | None = None, version: str = "processed_at") -> DataFrame:
        """Take in a batch with columns ``event_id``, ``day`` and others; returns the rows it replaced, as they were.

        Of several rows of one id the newest by ``version`` counts. Days before ``first_day`` expire with
        the batch, and rows of such days aren't taken in. A row without an id or a day is refused.
        """
        spark, schema = rows.sparkSession, rows.schema
        if rows.where("event_id is null or day is null").head(1):
            raise ValueError("a row of the event store needs an id and a day")
        if first_day:
            rows = rows.where(F.col("day") >= F.lit(first_day).cast("date"))
        order = [F.col(version).desc_nulls_last(), F.xxhash64(*rows.columns)]
        incoming = f"{self.base}/incoming/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(f"{incoming}/all")
        rows = spark.read.schema(schema).parquet(f"{incoming}/all")
        # Ids are looked at first, and only by themselves: whole rows aren't shuffled to be compared.
        again = stored(rows.groupBy("event_id").count().where("count > 1").select("event_id"), "repeated-ids")
        if again.head(1):
            copies, once = split_by_ids(rows, again) if held_within(again, REPEATED_BYTES) else sifted(rows, again)
            once.unionByName(keep_one(copies, ["event_id"], order)).write.mode("overwrite").parquet(f"{incoming}/once")
            rows = spark.read.schema(schema).parquet(f"{incoming}/once")

        held = self.days(spark, batch_id)
        maybe = [r.day for r in self.may_hold(rows, self.manifest(spark, batch_id)).select("day").distinct().collect()] if held else []
        ids = self.read(spark, schema, {d: held[d] for d in maybe}).select("event_id", "day")
        hits = stored(ids.join(few_ids(rows.select("event_id"), "merge"), "event_id", "left_semi").select("event_id", "day"), "replaced-ids")
        touched = {r.day for r in hits.select("day").union(rows.select("day")).distinct().collect()}
        old = self.read(spark, schema, {d: held[d] for d in touched if d in held})
        replaced, kept = split_by_ids(old, hits.select("event_id"))
        gone = f"{self.base}/replaced/batch_id={batch_id}"
        replaced.write.mode("overwrite").parquet(gone)

        if first_day:
            kept = kept.where(F.col("day") >= F.lit(first_day).cast("date"))
        target = f"{self.data}/batch_id={batch_id}"
        with open_folders(spark):
            by_partition(kept.unionByName(rows), ["day"]).write.mode("overwrite").partitionBy("day").parquet(target)
        self._write_manifest(spark, schema, batch_id, touched, {d for d in held if first_day and d.isoformat() < first_day})
        remove(spark, incoming)
        return spark.read.schema(schema).parquet(gone)

    def _write_manifest(self, spark: SparkSession, schema, batch_id: int, touched: set[date], expired: set[date]) -> None:
        """Bitmaps of what the batch wrote; a row without bits for a touched or expired day that has no rows now."""
        written = spark.read.schema(schema).parquet(f"{self.data}/batch_id={batch_id}")
        place = _place("event_id")
        bits = written.select("day", F.floor(place / BITS).alias("bucket"), (place % BITS).alias("at"))
        bits = bits.groupBy("day", "bucket").agg(F.bitmap_construct_agg("at").alias("bits"), F.count("*").alias("rows"))
        names = spark.createDataFrame([(d,) for d in sorted(touched | expired)], "day date")
        empty = names.join(written.select("day").distinct(), "day", "left_anti")
        empty = empty.select("day", F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("bits"), F.lit(0).cast("bigint").alias("rows"))
        path = f"{self.base}/manifest/batch_id={batch_id}"
        bits.unionByName(empty).repartition(1).write.mode("overwrite").parquet(path)

    def vacuum(self, spark: SparkSession) -> int:
        """Delete folders that the manifest no longer points to; returns how many."""
        kept = {(b, d.isoformat()) for d, b in self.days(spark).items()}
        path = spark._jvm.org.apache.hadoop.fs.Path(self.data)
        fs, dropped = path.getFileSystem(spark._jsc.hadoopConfiguration()), 0
        for entry in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "batch_id=*/day=*")) or []:
            place = entry.getPath()
            if (int(place.getParent().getName().partition("=")[2]), place.getName().partition("=")[2]) not in kept:
                remove(spark, place.toString())
                dropped += 1
        return dropped
