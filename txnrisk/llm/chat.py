r"""Chat formatting by prefix tree: turns that conversations share from their start are written once.

A turn is written as ``<|turn|>role<|text|>text<|end|>``. Control strings inside a role or a text are
broken up by a backslash after their first character, and backslashes are doubled; ``unescaped`` undoes
both. A node of the tree is a sequence of first turns; it belongs to the least conv_id that passes
through it, its owner. Along a conversation owners only grow, so the nodes of one owner are a chain,
and the tree in depth-first order is the chains, ordered by where they branch off (deepest branch first).

The packed sequence is a table of nodes with places in one long text: ``start`` and ``finish``,
``position`` (the place in each conversation that has the node, so what position ids count from), the
part under the loss mask, and ``attention``: the intervals of the ancestors' text, one for each chain on
the way. All of it is made with joins and windows: no tree is ever held in one place.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnrisk.llm.common import saved

#: Marks of this template, and those of other common ones, which texts may not contain either (fixed values).
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    marks = "|".join(re.escape(c) for c in CONTROL)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"(?=(?:{marks}))(.)", "$1\\\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turns(conversations: DataFrame) -> DataFrame:
    """Turns in order, with the node each one ends and the characters before it.

    A node is named by 128 bits: sums of hashes of (place, role, text) over the turns so far.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    shown = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT), escaped(F.col("text")), F.lit(END))
    rows = rows.withColumn("k", F.row_number().over(order)).withColumn("shown", shown).withColumn("n", F.length("shown").cast("long"))
    parts = {}
    for salt in range(2):
        bits = F.xxhash64(F.lit(salt), "k", "role", "text")
        parts[f"low{salt}"] = bits.bitwiseAND(F.lit(0xFFFFFFFF))
        parts[f"high{salt}"] = F.shiftrightunsigned(bits, 32)
    rows = rows.withColumns(parts)
    sums = [F.sum(p).over(so_far) for p in parts]
    node = F.concat_ws("-", *(F.hex(s) for s in sums), "k")
    return rows.withColumn("node", node).withColumn("position", F.sum("n").over(so_far) - F.col("n")).drop(*parts)


def pack(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, paths): the packed sequence, a row per node in depth-first order, and the way of each conversation.

    nodes: start, finish, chain (start of its chain), nth (in the chain), position, loss_start, loss_finish
    (null outside the loss mask), attention, shown. paths: conv_id, intervals (start, finish, nodes).
    Turns are ordered by (turn, role, text), so ties have an order; rows without a conv_id are left out.
    A null role or text is empty. Repeated rows are turns like any other.
    """
    every = saved(turns(conversations), "turns")
    owners = every.groupBy("node").agg(
        F.min("conv_id").alias("owner"), F.first("k").alias("k"), F.first("n").alias("n"), F.first("position").alias("position"),
        F.first("role").alias("role"), F.first("shown").alias("shown"),
    )
    owners = saved(owners, "nodes")
    way = every.select("conv_id", "node").join(owners.select("node", "owner", "k", "n", "position"), "node")
    chains = way.groupBy("conv_id", "owner").agg(
        F.min("k").alias("first"), F.count("*").alias("nodes"), F.min("position").alias("low"), F.max(F.col("position") + F.col("n")).alias("high"),
    )
    chains = saved(chains, "chains")
    step = F.struct("first", "owner", "nodes", "low", "high")
    by_conversation = chains.groupBy("conv_id").agg(F.sort_array(F.collect_list(step)).alias("steps"))
    own = by_conversation.where("element_at(steps, -1).owner = conv_id").select(
        F.col("conv_id").alias("owner"), F.expr("transform(steps, s -> struct(-s.first as depth, s.owner as owner))").alias("place"),
        F.expr("element_at(steps, -1).high - element_at(steps, -1).low").alias("size"), F.expr("element_at(steps, -1).low").alias("low"),
        F.expr("element_at(steps, -1).first").alias("first"),
    )
    # Depth-first order, and the text before each chain: sums inside ranges, and over one row per range.
    ranged = saved(own.repartitionByRange("place").withColumn("part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("part").agg(F.sum("size").alias("_n")).select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(parts, "part")
    placed = saved(placed.select("owner", "low", "first", (F.col("_before") + F.col("_inside")).alias("chain")), "placed")
    # A conversation takes a first part of each chain on its way.
    found = chains.join(placed.select("owner", "chain"), "owner")
    interval = F.struct("first", F.col("chain").alias("start"), (F.col("chain") + F.col("high") - F.col("low")).alias("finish"), "nodes")
    paths = found.groupBy("conv_id").agg(F.sort_array(F.collect_list(interval)).alias("_all"))
    paths = saved(paths.select("conv_id", F.expr("transform(_all, x -> struct(x.start as start, x.finish as finish, x.nodes as nodes))").alias("intervals")), "paths")
    above = paths.select(F.col("conv_id").alias("owner"), F.expr("transform(slice(intervals, 1, size(intervals) - 1), x -> struct(x.start as start, x.finish as finish))").alias("_above"))
    start = F.col("chain") + F.col("position") - F.col("low")
    head = F.lit(len(TURN) + len(TEXT)) + F.length(escaped(F.col("role")))
    learned = F.col("role") == LEARNED
    nodes = owners.join(placed.withColumnRenamed("first", "_first"), "owner").join(above, "owner").select(
        start.alias("start"), (start + F.col("n")).alias("finish"), "chain", (F.col("k") - F.col("_first")).alias("nth"), "position",
        F.when(learned, start + head).alias("loss_start"), F.when(learned, start + F.col("n") - len(END)).alias("loss_finish"),
        F.when(F.col("k") > F.col("_first"), F.concat("_above", F.array(F.struct(F.col("chain").alias("start"), start.alias("finish"))))).otherwise(F.col("_above")).alias("attention"),
        "shown",
    )
    return nodes.repartitionByRange("start").sortWithinPartitions("start"), paths


def write(conversations: DataFrame, path: str) -> None:
    """The packed sequence and the ways of the conversations, as two tables below ``path``."""
    nodes, paths = pack(conversations)
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    paths.write.mode("overwrite").parquet(f"{path}/paths")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Turns of each conversation from the written tables: conv_id, position, role, text, learned text, characters."""
    nodes = spark.read.parquet(f"{path}/nodes")
    paths = spark.read.parquet(f"{path}/paths")
    steps = paths.select("conv_id", F.explode("intervals").alias("i"))
    steps = steps.select("conv_id", F.col("i.start").alias("chain"), F.explode(F.expr("sequence(0, cast(i.nodes as int) - 1)")).alias("nth"))
    rows = steps.join(nodes, ["chain", "nth"])
    pattern = "(?s)^" + re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*)" + re.escape(END) + "$"
    learned = F.expr("substring(shown, cast(loss_start - start + 1 as int), cast(loss_finish - loss_start as int))")
    return rows.select(
        "conv_id", "position", unescaped(F.regexp_extract("shown", pattern, 1)).alias("role"), unescaped(F.regexp_extract("shown", pattern, 2)).alias("text"),
        F.when(F.col("loss_start").isNotNull(), unescaped(learned)).alias("learned"), (F.col("finish") - F.col("start")).alias("n"),
    )


def report(spark: SparkSession, path: str) -> DataFrame:
    """Per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all from what is written."""
    turn = F.struct("position", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("shown"), F.coalesce("learned", F.lit("")).alias("learned"))
    found = read(spark, path).groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"), F.sum("n").alias("formatted_chars"), F.count("*").alias("n_turns"))
    loss = F.array_join(F.col("t.learned"), "")
    return found.select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.col("t.shown"), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )
