"""Live velocity with state that expires by itself.

The state of a key is the distinct event times of one bucket of customers in one
slice of time and the slices that a window can reach back to. Buckets keep the
keys few, as each costs calls to Python and to the state store: there are as many
as slices times buckets, however many customers there are. Every event goes to
its own slice and to the later ones within reach, so a hot customer is as many
keys as it has slices, and a key's times are bounded by what happens in one reach.
When the watermark passes the end of a slice, a timer takes its state away.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.functions.columns import MICROS, micros

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SLICE_SECONDS = 3600
#: Buckets of customers in a slice; a busier stream takes more, so that what a bucket holds stays small.
BUCKETS = 64


def processor(windows: dict[str, int], slice_seconds: int):
    """The keyed processor; made here, so that it is sent to the executors with its code."""
    from pyspark.sql.streaming import StatefulProcessor

    names, widths = list(windows), [w * 1_000_000 for w in windows.values()]
    length = slice_seconds * 1_000_000

    class Velocity(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.names = handle.getValueState("names", "customers array<string>")
            self.times = handle.getValueState("times", "customer array<int>, us array<bigint>")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            batch = pd.concat(list(rows), ignore_index=True)
            names_of, stored = self.names.get(), self.times.get()
            if names_of is None:
                # a slice is over when the watermark has passed its end
                self.handle.registerTimer((int(key[1]) + 1) * length // 1000)
            names_of = list(names_of[0]) if names_of else []
            known, known_us = [np.array(c, dtype=np.int64) for c in (stored or ([], []))]
            codes, customers = pd.factorize(np.array([*names_of, *batch["customer_id"]], dtype=object))
            batch_us = batch["us"].to_numpy(np.int64)
            # Customers stand one after the other on one axis, further apart than a window reaches.
            both = np.concatenate((known_us, batch_us))
            low = int(both.min())
            apart = int(both.max()) - low + max(widths) + 1
            new = codes[len(names_of):].astype(np.int64) * apart + (batch_us - low)
            axis = np.union1d(known * apart + (known_us - low), new)
            if len(customers) > len(names_of):
                self.names.update((customers.tolist(),))
            if len(axis) > len(known):
                self.times.update(((axis // apart).tolist(), (axis % apart + low).tolist()))
            own = batch[batch["own"]]
            at = new[batch["own"].to_numpy(bool)]
            upto = np.searchsorted(axis, at, "right")
            text = lambda values: pd.Series(list(values), dtype=object)
            out = {"event_id": text(own["event_id"]), "customer_id": text(own["customer_id"]), "us": own["us"].to_numpy(np.int64)}
            out |= {n: (upto - np.searchsorted(axis, at - w, "left")).astype(np.int32) for n, w in zip(names, widths)}
            yield pd.DataFrame(out)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            self.names.clear()
            self.times.clear()
            yield pd.DataFrame()

        def close(self) -> None:
            pass

    return Velocity()


def stateful_velocity(
    rows: DataFrame, windows: dict[str, int], lateness: str = "1 hour", slice_seconds: int = SLICE_SECONDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Distinct event times of the same customer within each window, the current one included, on a stream.

    An event sees what has arrived by its micro-batch; for input in order that is
    the batch result. Rows behind the watermark have no state left to be counted
    in: take them out before, with ``late.LateAware``.
    """
    reach = -(-max(windows.values()) // slice_seconds)
    length = slice_seconds * MICROS
    us = micros(F.col("event_time"))
    rows = rows.select("event_id", F.coalesce("customer_id", F.lit("")).alias("customer_id"), us.alias("us")).where("us is not null")
    # The watermark's clock starts where the slices start, whatever the session's zone.
    rows = rows.withColumn("at", F.timestamp_micros("us")).withWatermark("at", lateness)
    home = F.floor(F.col("us") / length)
    sent = rows.select("*", F.explode(F.sequence(home, home + reach)).alias("slice"), home.alias("home"))
    bucket = F.pmod(F.xxhash64("customer_id"), F.lit(buckets))
    keyed = sent.select("event_id", "customer_id", bucket.alias("bucket"), "slice", "us", (F.col("slice") == F.col("home")).alias("own"), "at")
    schema = "event_id string, customer_id string, us bigint, " + ", ".join(f"{n} int" for n in windows)
    return keyed.groupBy("bucket", "slice").transformWithStateInPandas(
        processor(windows, slice_seconds), outputStructType=schema, outputMode="append", timeMode="eventTime"
    )


def run(spark: SparkSession, velocity: DataFrame, path: str):
    """Write the stream's output to Parquet until all input is read; returns the query for its progress."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    try:
        query = (
            velocity.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", f"{path}.checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return query
