"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in column expressions alone.

Each shard has some points on a ring of slices; a key's slice is cut from its hash, and its shard is that of
the next point clockwise. A shard takes no more rows than its bound: slices offer their rows in rounds, to
the nearest shard first, and what a full shard leaves continues to the next other shard clockwise. A shard
fills up in ring order, so one slice at most is cut in two by it in a round.

Rounds work on counts of slices, whose number is a parameter; a row then finds its shard and its slot by its
rank in its slice. Ranks are taken in cells, so that a key with very many rows doesn't fill one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnrisk.llm.common import saved

#: Points of a shard; slices of the ring are two to this power.
VNODES, SLICE_BITS = 64, 13
#: Rows that are ranked in one group.
CELL = 1 << 16
_BEFORE = (Window.unboundedPreceding, -1)


def slice_of(key: Column) -> Column:
    """The slice a hash falls into: its highest bits."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - SLICE_BITS).cast("int")


def choices(spark: SparkSession, shards: int, vnodes: int = VNODES) -> DataFrame:
    """(slice, choice, shard): all shards in the order in which their points come clockwise from a slice.

    A shard's points are the same whatever the number of shards, so a further shard only cuts in.
    """
    point = F.xxhash64(F.lit("point"), F.col("id") % shards, F.floor(F.col("id") / shards))
    points = spark.range(0, shards * vnodes, 1, 1).select((F.col("id") % shards).cast("int").alias("shard"), point.alias("h"))
    points = points.select("shard", "h", F.shiftrightunsigned("h", 64 - SLICE_BITS).cast("int").alias("at"))
    laps = F.explode(F.array("at", F.col("at") + (1 << SLICE_BITS)))
    points = points.select("shard", "h", laps.alias("at")).select("shard", "at", F.struct("at", "h").alias("point"))
    slices = spark.range(0, shards << SLICE_BITS, 1, 1).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).cast("int").alias("at"), F.lit(None).cast("struct<at:int,h:bigint>").alias("point")
    )
    # In falling order the frame only grows; one that ends with the last row would be taken anew for each row.
    ahead = Window.partitionBy("shard").orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    both = slices.withColumn("own", F.lit(True)).unionByName(points.withColumn("own", F.lit(False))).coalesce(1)
    nearest = both.withColumn("next", F.min("point").over(ahead)).where("own")
    order = F.row_number().over(Window.partitionBy("at").orderBy("next", "shard"))
    return nearest.select(F.col("at").alias("slice"), order.alias("choice"), "shard")


def _all(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables).coalesce(1)


def intervals(counts: DataFrame, shards: int, slack: float = 0.0, vnodes: int = VNODES) -> DataFrame:
    """(slice, parts): which ranks of a slice's rows go to which shard, and the slot of the first of them.

    ``counts`` has (slice, n). Without slack, bounds are the counts of an even deal: they differ by one at most
    and add up to all rows. With it, each bound is that share of the even load larger, and fewer rows move on.
    All tables here have at most shards times slices rows and stay in one partition.
    """
    spark, total = counts.sparkSession, counts.agg(F.sum("n")).first()[0] or 0
    bound = F.lit(total // shards) + F.when(F.col("shard") < total % shards, 1).otherwise(0)
    bound = F.greatest(bound, F.ceil(F.lit((1 + slack) * total / shards))) if slack else bound
    order = saved(choices(spark, shards, vnodes), "ring").coalesce(1)
    left, rounds = counts.select("slice", "n"), []
    for choice in range(1, shards + 1):
        offers = left.coalesce(1).join(order.where(F.col("choice") == choice), "slice")
        before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("slice").rowsBetween(*_BEFORE)), F.lit(0))
        if rounds:
            taken = _all(rounds).groupBy("shard").agg(F.sum("take").alias("took"))
            offers = offers.join(taken, "shard", "left").withColumn("took", F.coalesce("took", F.lit(0)))
        else:
            offers = offers.withColumn("took", F.lit(0))
        offers = offers.withColumn("take", F.greatest(F.lit(0), F.least("n", bound - F.col("took") - before)).cast("bigint"))
        found = saved(offers.select("slice", "choice", "shard", "n", "take"), "round").coalesce(1)
        rounds.append(found)
        left = found.where("take < n").select("slice", (F.col("n") - F.col("take")).alias("n"))
        if not left.head(1):
            break
    every = _all(rounds).where("take > 0")
    of_slice = Window.partitionBy("slice").orderBy("choice").rowsBetween(*_BEFORE)
    of_shard = Window.partitionBy("shard").orderBy("choice", "slice").rowsBetween(*_BEFORE)
    low, base = (F.coalesce(F.sum("take").over(w), F.lit(0)) for w in (of_slice, of_shard))
    every = every.select("slice", low.alias("low"), "take", "shard", base.alias("base"))
    part = F.struct("low", (F.col("low") + F.col("take")).alias("high"), "shard", "base")
    return every.groupBy("slice").agg(F.collect_list(part).alias("parts"))


def shard(docs: DataFrame, shards: int = 8, slack: float = 0.0, vnodes: int = VNODES) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row of ``docs``; size is bytes of the text plus one.

    Slots of a shard are gapless from 0. Without ``slack``, counts of shards differ by one at most. A null text has
    no bytes and CRC-32 zero, like an empty one. A null doc_id is a key like any other; rows that repeat a key are
    ranked in the order in which they are read and may go to several shards. An empty table gives no rows; other
    columns aren't read.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
    ).select("*", slice_of(F.col("doc_id")).alias("slice"), F.monotonically_increasing_id().alias("row"))
    rows = saved(rows, "rows")  # a row number that stays
    counts = saved(rows.groupBy("slice").agg(F.count("*").alias("n")), "slices").coalesce(1)
    parts = saved(intervals(counts, shards, slack, vnodes).join(counts, "slice"), "intervals")
    # At most 2 ** SLICE_BITS rows of at most `shards` parts, whatever the input.
    placed = rows.join(F.broadcast(parts), "slice").withColumn("cell", F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / CELL)))
    cells = placed.groupBy("slice", "cell").agg(F.count("*").alias("m"))
    cells = cells.withColumn("first", F.coalesce(F.sum("m").over(Window.partitionBy("slice").orderBy("cell").rowsBetween(*_BEFORE)), F.lit(0)))
    in_cell = F.row_number().over(Window.partitionBy("slice", "cell").orderBy("doc_id", "row")) - 1
    ranked = placed.withColumn("nth", in_cell).join(cells.select("slice", "cell", "first"), ["slice", "cell"])
    ranked = ranked.withColumn("rank", F.col("first") + F.col("nth"))
    part = F.filter("parts", lambda p: (p.low <= F.col("rank")) & (F.col("rank") < p.high))[0]
    ranked = ranked.select("doc_id", "size", "text_crc32", "rank", part.alias("part"))
    return ranked.select("doc_id", "size", "text_crc32", F.col("part.shard").alias("shard"), (F.col("part.base") + F.col("rank") - F.col("part.low")).alias("slot"))
