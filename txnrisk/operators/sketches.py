"""Sketches per day that merge over any range of days: delay quantiles, distinct and returning customers, heavy keys.

A day is sketched once, when it is loaded; a report over a month or a year reads
one small row per day instead of the events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.operators.quality import delay_seconds
from txnrisk.storage import BROADCAST_BYTES, MOST_SALTS, SALTS, SLICE_BYTES, held_within, read_bytes, stored

#: Size of the quantile sketch; with it, ranks are within ``RANK_ERROR`` of the truth in 99 of 100 cases.
KLL_K, RANK_ERROR = 800, 0.01
#: Binary logarithm of the entries of a distinct-count sketch; three standard errors are ``COUNT_ERROR``.
THETA_LG, COUNT_ERROR = 14, 0.03
#: Entries of the frequent-items summary; a key of one part in ``ITEMS / 4`` or more can't fall out of it.
ITEMS = 10_000
QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def day_sketches(silver: DataFrame) -> DataFrame:
    """(day, events, delays, customers, merchants): one row of sketches for each event date."""
    delay = delay_seconds().cast("double")
    return silver.groupBy(F.to_date("event_time").alias("day")).agg(
        F.count("*").alias("events"), F.count(delay).alias("delayed"),
        F.kll_sketch_agg_double(delay, F.lit(KLL_K)).alias("delays"),
        F.theta_sketch_agg("customer_id", F.lit(THETA_LG)).alias("customers"),
        F.theta_sketch_agg("merchant_id", F.lit(THETA_LG)).alias("merchants"),
    )


def _ranges(days: DataFrame, ranges: dict[str, tuple[str, str]]) -> DataFrame:
    """A row per day and named range (first and last day) that it is in."""
    inside = [F.when(F.col("day").between(*(F.lit(d).cast("date") for d in ends)), F.lit(name)) for name, ends in ranges.items()]
    return days.withColumn("range", F.explode(F.array_compact(F.array(*inside))))


def latency_by_range(days: DataFrame, ranges: dict[str, tuple[str, str]]) -> DataFrame:
    """(range, events, p50, p95, p99): delay quantiles in seconds of each range, from the days' sketches."""
    merged = _ranges(days, ranges).groupBy("range").agg(F.sum("delayed").alias("events"), F.kll_merge_agg_double("delays").alias("s"))
    return merged.select("range", "events", *(F.kll_sketch_get_quantile_double("s", F.lit(p)).alias(n) for n, p in QUANTILES.items()))


def rank_checks(estimates: DataFrame, silver: DataFrame, ranges: dict[str, tuple[str, str]]) -> DataFrame:
    """Which of the estimates stand where they should: is the wished rank among the exact ranks of the value,
    give or take ``RANK_ERROR``? Reads the events; for tests and audits."""
    rows = silver.select(F.to_date("event_time").alias("day"), delay_seconds().cast("double").alias("d")).where("d is not null")
    joined = _ranges(rows, ranges).join(F.broadcast(estimates), "range")  # a row per named range
    checks = []
    for name, p in QUANTILES.items():
        below, upto = (F.count_if(test) / F.count("*") for test in (F.col("d") < F.col(name), F.col("d") <= F.col(name)))
        checks.append(((below - RANK_ERROR <= p) & (F.lit(p) <= upto + RANK_ERROR)).alias(f"{name}_right"))
    return joined.groupBy("range", "events").agg(*checks, F.count("*").alias("counted"))


def customers_by_range(days: DataFrame, ranges: dict[str, tuple[str, str]]) -> DataFrame:
    """(range, customers, merchants, sketch): distinct keys of each range, estimated."""
    merged = _ranges(days, ranges).groupBy("range").agg(
        F.theta_union_agg("customers").alias("sketch"), F.theta_union_agg("merchants").alias("m"),
    )
    return merged.select("range", F.theta_sketch_estimate("sketch").alias("customers"), F.theta_sketch_estimate("m").alias("merchants"), "sketch")


def returning_customers(days: DataFrame, earlier: tuple[str, str], later: tuple[str, str]) -> DataFrame:
    """One row: customers seen in both ranges, only in the later, only in the earlier, and in any of them."""
    found = customers_by_range(days, {"earlier": earlier, "later": later})
    at = {n: F.max(F.when(F.col("range") == n, F.col("sketch"))) for n in ("earlier", "later")}
    both = found.agg(*(c.alias(n) for n, c in at.items()))
    parts = {
        "returning": F.theta_intersection("earlier", "later"), "new": F.theta_difference("later", "earlier"),
        "lost": F.theta_difference("earlier", "later"), "any": F.theta_union("earlier", "later"),
    }
    return both.select(*(F.theta_sketch_estimate(s).alias(n) for n, s in parts.items()))


# ---------------------------------------------------------------- heavy keys


def heavy_keys(df: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """(key, n): every key with at least ``share`` of the rows, and its exact count.

    A frequent-items summary, made in one map-side pass and merged, names the
    candidates; a second pass counts only their rows. NULL is a key like any other.
    """
    if share < 4 / ITEMS:
        raise ValueError(f"the summary finds keys of {4 / ITEMS} of the rows or more")
    text = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    most = int(1 / share) + 1
    keyed = df.select(text.alias("k"))
    found = keyed.agg(F.expr(f"approx_top_k(k, {most}, {ITEMS})").alias("top"), F.count("*").alias("total"))
    found = found.select(F.explode("top.item").alias("k"), "total")
    counted = keyed.join(F.broadcast(found), "k").groupBy("k", "total").agg(F.count("*").alias("n"))  # at most 1 / share + 1 rows
    heavy = counted.where(F.col("n") >= F.col("total") * share)
    return heavy.select(F.when(F.col("k") != "", F.substring("k", 2, 1 << 30)).alias(key), "n")


def join_dimension_by_weight(
    fact: DataFrame, dim: DataFrame, key: str, spread: Column, share: float = 0.01, salts: int = SALTS, weigh: DataFrame | None = None
) -> DataFrame:
    """Left join to a one-row-per-key dimension in which only heavy keys are salted.

    A dimension of checked size is broadcast. Of a larger one, the rows of heavy
    keys are copied into slices, and all others stay as they are. ``weigh`` has the
    keys of the fact rows where these are cheaper to read than ``fact`` is.
    """
    if held_within(dim, BROADCAST_BYTES):
        return fact.join(F.broadcast(dim), key, "left")
    weigh = fact if weigh is None else weigh
    salts = min(max(salts, -(-read_bytes(weigh) // SLICE_BYTES)), MOST_SALTS)
    heavy = stored(heavy_keys(weigh, key, share).where(F.col(key).isNotNull()).select(F.col(key).cast(dim.schema[key].dataType).alias("_heavy")), "heavy")
    heavy = F.broadcast(heavy.withColumn("_hot", F.lit(True)))  # at most 1 / share rows
    spread_over = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    sliced = fact.join(heavy, F.col(key) == F.col("_heavy"), "left")
    sliced = sliced.withColumn("_slice", F.when(F.col("_hot") | F.col(key).isNull(), spread_over).otherwise(0))  # NULL meets no row
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    slices = dim.join(heavy, F.col(key) == F.col("_heavy"), "left").withColumn("_slice", F.explode(copies)).drop("_heavy", "_hot")
    return sliced.drop("_heavy", "_hot").join(slices.hint("merge"), [key, "_slice"], "left").drop("_slice")
