"""A sort buffer for streams: rows are held until the watermark has passed them, then released in order.

Held rows are a table, not the state of a key, so a hot customer spreads over
tasks. Each micro-batch releases what lies at or before the newest time seen less
the delay; everything that is older has then arrived or is late. Features of a
release hang only on what was released before, and so equal those of a batch job
over all rows, in whatever order they came.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnrisk.functions.columns import ntz_literal
from txnrisk.operators import history
from txnrisk.sources.files import read_or_empty
from txnrisk.storage import observed
from txnrisk.streaming.online import write_batch

#: Later than any event: the mark of a source that has ended.
END = datetime(9999, 12, 31)
BATCHES = "newest timestamp_ntz, mark timestamp_ntz, batch_id bigint"


@dataclass
class OrderedRelease:
    """Velocity in the order of ``time``; ``delay`` seconds are waited for what is out of order."""

    base: str
    windows: dict[str, int] = field(default_factory=lambda: {"velocity_5min": 300, "velocity_1hour": 3600})
    delay: int = 6 * 3600
    time: str = "event_time"

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def start(self, rows: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        return (
            rows.writeStream.foreachBatch(self.process).option("checkpointLocation", self.path("checkpoint"))
            .trigger(**(trigger or {"availableNow": True})).start()
        )

    def process(self, rows: DataFrame, batch_id: int, flush: bool = False) -> None:
        """Hold and release one micro-batch; ``flush`` releases all that is held, at the end of a source."""
        spark, seen = rows.sparkSession, Observation()
        batches = read_or_empty(spark, self.path("batches"), BATCHES).where(F.col("batch_id") < batch_id)
        newest, mark = batches.agg(F.max("newest"), F.max("mark")).first()
        rows = rows.select("event_id", "customer_id", self.time)
        schema = rows.schema
        late = F.coalesce(F.col(self.time) <= ntz_literal(mark), F.col(self.time).isNull())
        marked = rows.observe(seen, F.max(self.time).alias("newest")).withColumn("late", late)
        # Written first: the batch's own newest time is known only when it has been read.
        write_batch(marked, self.path("arrived"), batch_id, ["late"])
        newest = max((t for t in (newest, observed(seen).get("newest")) if t is not None), default=None)
        upto = END if flush else newest - timedelta(seconds=self.delay) if newest else None
        if mark and (upto is None or upto < mark):
            upto = mark
        arrived = read_or_empty(spark, f"{self.path('arrived')}/batch_id={batch_id}/late=false", schema)
        held = read_or_empty(spark, f"{self.path('held')}/batch_id={batch_id - 1}", schema).unionByName(arrived)
        ready = held.where(F.col(self.time) <= ntz_literal(upto)) if upto else held.limit(0)
        waiting = held.where(F.col(self.time) > ntz_literal(upto)) if upto else held
        waiting.write.mode("overwrite").parquet(f"{self.path('held')}/batch_id={batch_id}")
        self._release(ready, mark, batch_id)
        record = spark.range(1).select(ntz_literal(newest).alias("newest"), ntz_literal(upto).alias("mark"))
        record.coalesce(1).write.mode("overwrite").parquet(f"{self.path('batches')}/batch_id={batch_id}")

    def _release(self, ready: DataFrame, mark: datetime | None, batch_id: int) -> None:
        """Features of the released rows, over them and those released within the widest window before."""
        spark = ready.sparkSession
        names = ["event_id", "customer_id", self.time]
        before = read_or_empty(spark, self.path("released"), f"event_id string, customer_id string, {self.time} timestamp_ntz, batch_id bigint, day date")
        before = before.where(F.col("batch_id") < batch_id)
        if mark:
            since = mark - timedelta(seconds=max(self.windows.values())) if mark != END else mark
            before = before.where((F.col("day") >= F.lit(since.date())) & (F.col(self.time) >= ntz_literal(since)))
        before = before.join(ready.select("customer_id").distinct(), "customer_id", "left_semi").select(*names)
        both = before.withColumn("new", F.lit(False)).unionByName(ready.withColumn("new", F.lit(True)))
        counted = history.velocity_live(both, self.windows, ts=self.time).where("new").drop("new")
        write_batch(counted.withColumn("day", F.to_date(self.time)), self.path("released"), batch_id, ["day"])


def released(spark: SparkSession, base: str) -> DataFrame:
    """All released rows with their features."""
    return spark.read.parquet(f"{base}/released")


def late_rows(spark: SparkSession, base: str) -> DataFrame:
    """Rows that came after their time had been released, or without a time; they have no features."""
    return spark.read.parquet(f"{base}/arrived").where(F.col("late").cast("boolean"))
