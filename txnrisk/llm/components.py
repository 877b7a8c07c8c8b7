"""Connected components of a graph whose edges are table rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import saved

#: Times that parents are replaced by their parents in a round: chains shrink by 2 to this power.
JUMPS = 2


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of ``edges`` (a, b); component is the least node reachable.

    Each round points a node at its least neighbour, follows these pointers a few times, and keeps
    the edges between different parents, until none is left. A node with very many edges is safe: the
    least neighbour is pre-aggregated before the shuffle, and every join reads two saved tables, so
    that adaptive execution can split a hot key. Loops, repeated edges and null ends add nothing;
    an empty table gives an empty result.
    """
    ends = edges.select("a", "b").where("a <> b")
    left = saved(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    rounds: list[DataFrame] = []
    while left.head(1):
        both = left.select(F.col("a").alias("x"), F.col("b").alias("y"))
        both = both.unionByName(left.select(F.col("b").alias("x"), F.col("a").alias("y")))
        parents = saved(both.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("p")), "parents")
        for _ in range(JUMPS):
            above = parents.select(F.col("x").alias("p"), F.col("p").alias("q"))
            parents = saved(parents.join(above, "p").select("x", F.col("q").alias("p")), "parents")
        rounds.append(parents)
        of_a = parents.select(F.col("x").alias("a"), F.col("p").alias("pa"))
        of_b = parents.select(F.col("x").alias("b"), F.col("p").alias("pb"))
        moved = left.join(of_a, "a").join(of_b, "b").where("pa <> pb")
        left = saved(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = rounds[0]
    for parents in rounds[1:]:
        above = parents.select(F.col("x").alias("p"), F.col("p").alias("q"))
        labels = labels.join(above, "p", "left").select("x", F.coalesce("q", "p").alias("p"))
    return labels.select(F.col("x").alias("node"), F.col("p").alias("component"))
