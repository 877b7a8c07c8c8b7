"""Per-customer features over time: velocity, lifetime totals, recency, running maxima.

A plain ``Window.partitionBy(customer)`` puts all rows of one customer into one
task. A hot customer may own a large share of the table, so the order
(time, seq) within a customer is cut in two places instead:

* *cells*: rows of one customer at one instant in one range of ``seq``. Rows are
  ranked inside a cell only; the bounds of the ranges are a sample of ``seq``, so
  even one instant holding a third of the table falls into many cells.
* *stretches* of time: a customer with few rows is one stretch. One with more is
  cut by time, and each part that still has too many is cut again, down to the
  microsecond. Cells are prefix-summed inside a stretch, and one total per
  stretch is carried to the later ones of the customer.

Range counts are differences of two prefix sums, at t and at t - width. A cell
sends a probe to t - width; probes are sorted in among the cells, take the sum
they find there, wherever it is, and go back to their cell. So every frame is
one-sided, no cell is copied, and the cost is linear in the number of cells
however many events or stretches a window spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.functions.columns import MICROS, cents, from_micros, micros
from txnrisk.storage import BROADCAST_BYTES, planned_bytes, stored

_FIRST = Window.unboundedPreceding
#: Ranges of ``seq`` that an instant is cut into; rows whose values are looked at for their bounds.
RANGES, SAMPLED = 64, 1024
#: A stretch with more rows is cut at the next level.
LIMIT = 1 << 17
#: Lengths of stretches by level, as powers of two in microseconds: six days, 36 minutes, 8 s, 33 ms, 128, 1.
SHIFTS = (39, 31, 23, 15, 7, 0)
#: Start of the one stretch of a customer that isn't cut.
WHOLE = -(1 << 62)


def _ranges(df: DataFrame, seq: str) -> Column:
    """Number of the range of ``seq`` that a row is in: how many sampled values lie below it.

    The sample is values of least hash, so it is spread like the values and the
    same on every run. It cuts the order; it doesn't decide it. The first rows
    by hash need no shuffle; repeated values among them make it smaller.
    """
    sample = df.select(F.col(seq).alias("v")).where("v is not null")
    rows = sample.select("v", F.xxhash64("v").alias("h")).orderBy("h", "v").limit(SAMPLED).collect()
    values = list(dict.fromkeys(r.v for r in rows))[: RANGES - 1]
    if not values:
        return F.lit(0)
    bounds = F.array(*(F.lit(v) for v in sorted(values)))
    return F.coalesce(F.size(F.filter(bounds, lambda b: b < F.col(seq))), F.lit(0))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if planned_bytes(df) <= BROADCAST_BYTES else df


def _node(level: int, us: str) -> Column:
    return F.shiftright(us, SHIFTS[level - 1]) if level else F.lit(0).cast("bigint")


def full_stretches(rows: DataFrame, key: str = "h_key", us: str = "h_us") -> list[DataFrame]:
    """(f_key, f_node) of the stretches with over ``LIMIT`` rows, a table per level; mostly there is none.

    The first level is customers. Each table is counted among the rows of the
    one before, and written, so that all uses see the same stretches.
    """
    found, left = [], rows.select(F.col(key).alias("f_key"), F.col(us).alias("us")).where("us is not null")
    for level in range(len(SHIFTS) + 1):
        counted = left.groupBy("f_key", _node(level, "us").alias("f_node")).count()
        full = stored(counted.where(F.col("count") > LIMIT).select("f_key", "f_node"), "stretches")
        if not full.head(1):
            break
        found.append(full)
        left = left.withColumn("f_node", _node(level, "us")).join(_small(full), ["f_key", "f_node"], "left_semi").drop("f_node")
    return found


def with_stretch(points: DataFrame, full: list[DataFrame], key: str, us: str) -> DataFrame:
    """Points with ``stretch``, the start of the stretch that ``us`` is in; starts order a customer's stretches."""
    start, columns = F.lit(WHOLE).cast("bigint"), points.columns
    for level, table in enumerate(full):
        shift = SHIFTS[min(level, len(SHIFTS) - 1)]
        hit = table.select(F.col("f_key").alias(f"k{level}"), F.col("f_node").alias(f"n{level}"))
        same = (F.col(key) == F.col(f"k{level}")) & (_node(level, us) == F.col(f"n{level}"))
        points = points.join(_small(hit), same, "left")
        start = F.when(F.col(f"n{level}").isNotNull(), F.shiftleft(F.shiftright(us, shift), shift)).otherwise(start)
    return points.select(*columns, start.alias("stretch"))


def with_history(
    df: DataFrame,
    *,
    key: str,
    ts: str,
    seq: str,
    amount: str | None = None,
    latest: str | None = None,
    widths: tuple[int, ...] = (),
    totals: bool = True,
) -> DataFrame:
    """Add what each row's key did before it, in the order (ts, seq).

    ``h_n`` events before · ``h_prev_us`` time of the one before ·
    ``h_sum`` amount before (``amount`` given) · ``h_max_us`` largest ``latest``
    before (given) · per width w in seconds: ``h_w{w}`` events before in
    [t - w, t], ``h_t{w}`` distinct times in [t - w, t], t included.
    Rows without a time get NULLs and count for nobody. ``totals=False`` gives the
    range counts only.
    """
    # NULL keys form one group of their own, under a text no id has
    group = F.coalesce(F.col(key).cast("string"), F.lit("\u2205"))
    rows = df.select(
        "*",
        group.alias("h_key"),
        micros(F.col(ts)).alias("h_us"),
        _ranges(df, seq).alias("h_slot"),
        (F.coalesce(cents(F.col(amount)), cents(F.lit(0))) if amount else F.lit(0)).alias("h_amt"),
        (micros(F.col(latest)) if latest else F.lit(None).cast("bigint")).alias("h_lat"),
    )
    cells = (
        rows.where(F.col(ts).isNotNull())
        .groupBy(
            F.col("h_key").alias("c_key"), F.col("h_us").alias("c_us"), F.col("h_slot").alias("c_slot")
        )
        .agg(F.count("*").alias("c_n"), F.sum("h_amt").alias("c_amt"), F.max("h_lat").alias("c_lat"))
    )
    found = _prefixes(cells, widths, full_stretches(rows))
    columns = {"h_key": F.col("c_key"), "h_us": F.col("c_us"), "h_slot": F.col("c_slot")}
    columns |= {f"s_w{w}": F.col("s_n") - F.col(f"low_n{w}") for w in widths}
    columns |= {f"s_t{w}": F.col("s_times") - F.col(f"low_t{w}") for w in widths}
    if totals:
        columns |= {name: F.col(name) for name in ("s_n", "s_amt", "s_us", "s_lat")}
    state = found.select(*[value.alias(name) for name, value in columns.items()])
    # Rows and cells meet on the cell, the grouping the row-level rank needs anyway: sending
    # the cells to every task by way of the driver would save no shuffle.
    in_cell = Window.partitionBy("h_key", "h_us", "h_slot").orderBy(seq)
    before = in_cell.rowsBetween(_FIRST, -1)
    ranked = rows.join(state.hint("merge"), ["h_key", "h_us", "h_slot"], "left").select(
        "*",
        F.when(F.col("h_us").isNotNull(), F.row_number().over(in_cell) - 1).alias("h_rank"),
        F.coalesce(F.sum("h_amt").over(before), F.lit(0)).alias("h_cell_amt"),
        F.max("h_lat").over(before).alias("h_cell_lat"),
    )
    out = [(F.col(f"s_w{w}") + F.col("h_rank")).alias(f"h_w{w}") for w in widths]
    out += [F.col(f"s_t{w}").alias(f"h_t{w}") for w in widths]
    if totals:
        previous = F.when(F.col("h_rank") > 0, F.col("h_us")).otherwise(F.col("s_us"))
        out += [
            (F.col("s_n") + F.col("h_rank")).alias("h_n"),
            previous.alias("h_prev_us"),
            (F.col("s_amt") + F.col("h_cell_amt")).alias("h_sum"),
            F.greatest("s_lat", "h_cell_lat").alias("h_max_us"),
        ]
    return ranked.select(*df.columns, *out)


def _prefixes(cells: DataFrame, widths: tuple[int, ...], full: list[DataFrame]) -> DataFrame:
    """Per cell: sums over the earlier cells of its key, and those at the low end of each width.

    A probe of width w stands before all cells at t - w. Every frame starts at the
    stretch's first row, so Spark only ever adds rows to it.
    """
    point = lambda w: F.struct(F.lit(w).alias("w"), (F.col("c_us") - w * MICROS).alias("us"))
    points = cells.select("*", F.explode(F.array(*(point(w) for w in (0, *sorted(set(widths) - {0}))))).alias("p")) if widths else cells.select("*", point(0).alias("p"))
    own = F.col("w") == 0
    points = points.select("c_key", "c_us", "c_slot", F.col("p.w").alias("w"), F.col("p.us").alias("us"), "c_n", "c_amt", "c_lat")
    points = with_stretch(points, full, "c_key", "us").select(
        "c_key", "c_us", "c_slot", "w", "us", "stretch", own.alias("own"),
        F.when(own, F.col("c_n")).otherwise(0).alias("n"), F.when(own, F.col("c_amt")).otherwise(0).alias("amt"),
        F.when(own, F.col("us")).alias("cell_us"), F.when(own, F.col("c_lat")).alias("lat"),
    )
    ordered = Window.partitionBy("c_key", "stretch").orderBy("us", "own", "c_slot")
    before = ordered.rowsBetween(_FIRST, -1)
    counted = points.select(
        "*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("p_n"), F.coalesce(F.sum("amt").over(before), F.lit(0)).alias("p_amt"),
        F.max("cell_us").over(before).alias("p_us"), F.max("lat").over(before).alias("p_lat"),
    )
    first = F.when(F.col("own") & ~F.col("p_us").eqNullSafe(F.col("us")), 1).otherwise(0)
    counted = counted.withColumn("new", first).withColumn("p_times", F.sum("new").over(ordered.rowsBetween(_FIRST, Window.currentRow)))
    values = {"s_n": F.col("p_n"), "s_amt": F.col("p_amt"), "s_us": F.col("p_us"), "s_lat": F.col("p_lat"), "s_times": F.col("p_times")}
    if full:
        counted = counted.join(_carry(counted.where(F.col("stretch") > WHOLE)), ["c_key", "stretch"], "left")
        values |= {f"s_{c}": F.coalesce(f"b_{c}", F.lit(0)) + F.col(f"p_{c}") for c in ("n", "amt", "times")}
        values |= {f"s_{c}": F.greatest(f"b_{c}", f"p_{c}") for c in ("us", "lat")}
    found = counted.select("c_key", "c_us", "c_slot", "w", *(v.alias(name) for name, v in values.items()))
    if not widths:
        return found
    # A cell and its probes come together again, where its rows are expected.
    at = lambda w, c: F.max(F.when(F.col("w") == w, F.col(c)))
    sums = [at(0, c).alias(c) for c in values]
    sums += [at(w, c).alias(f"low_{name}{w}") for w in widths for name, c in (("n", "s_n"), ("t", "s_times"))]
    return found.groupBy("c_key", "c_us", "c_slot").agg(*sums)


def _carry(counted: DataFrame) -> DataFrame:
    """Totals of all earlier stretches: one narrow row per stretch of the keys that were cut."""
    totals = counted.groupBy("c_key", "stretch").agg(
        F.sum("n").alias("n"), F.sum("amt").alias("amt"), F.sum("new").alias("times"),
        F.max("cell_us").alias("us"), F.max("lat").alias("lat"),
    )
    earlier = Window.partitionBy("c_key").orderBy("stretch").rowsBetween(_FIRST, -1)
    sums = [F.sum(c).over(earlier).alias(f"b_{c}") for c in ("n", "amt", "times")]
    return totals.select("c_key", "stretch", *sums, *(F.max(c).over(earlier).alias(f"b_{c}") for c in ("us", "lat")))


def velocity_prior(
    df: DataFrame, windows: dict[str, int], key="customer_id", ts="event_time", seq="event_id"
) -> DataFrame:
    """Events of the same key before this one within each window (seconds).

    The lower bound is inclusive, the current event is not counted, and among
    events of one instant only those ordered before it are.
    """
    out = with_history(df, key=key, ts=ts, seq=seq, widths=tuple(windows.values()), totals=False)
    counts = [F.col(f"h_w{w}").cast("int").alias(name) for name, w in windows.items()]
    return out.select(*df.columns, *counts)


def velocity_live(
    df: DataFrame, windows: dict[str, int], key="customer_id", ts="event_time", seq="event_id"
) -> DataFrame:
    """Distinct event times of the same key within each window, the current one included."""
    out = with_history(df, key=key, ts=ts, seq=seq, widths=tuple(windows.values()), totals=False)
    counts = [F.col(f"h_t{w}").cast("int").alias(name) for name, w in windows.items()]
    return out.select(*df.columns, *counts)


def lifetime(
    df: DataFrame, key="customer_id", ts="event_time", seq="event_id", amount="amount"
) -> DataFrame:
    """Running transaction count and spend, the current event included."""
    out = with_history(df, key=key, ts=ts, seq=seq, amount=amount)
    return out.select(*df.columns, *_lifetime_columns(amount))


def _lifetime_columns(amount: str) -> list[Column]:
    spend = F.col("h_sum") + F.coalesce(cents(F.col(amount)), cents(F.lit(0)))
    return [
        (F.col("h_n") + 1).alias("lifetime_tx_count"),
        F.round(spend, 2).cast("double").alias("lifetime_spend"),
    ]


def _days_since(ts: str) -> Column:
    gap = (micros(F.col(ts)) - F.col("h_prev_us")) / F.lit(86400 * MICROS)
    return F.round(gap, 2).alias("days_since_last_tx")


def _geo_flag(ts: str, minutes: int) -> Column:
    gap = micros(F.col(ts)) - F.col("h_prev_us")
    abroad = F.col("merchant_country") != F.col("customer_country")
    hit = abroad & (gap < minutes * 60 * MICROS)
    return F.when(F.coalesce(hit, F.lit(False)), 1).otherwise(0).alias("geo_anomaly_flag")


def days_since_last(df: DataFrame, key="customer_id", ts="event_time", seq="event_id") -> DataFrame:
    """Days since the key's previous event, two decimals; NULL on its first."""
    return with_history(df, key=key, ts=ts, seq=seq).select(*df.columns, _days_since(ts))


def flag_geo_anomaly(
    df: DataFrame, minutes: int = 30, key="customer_id", ts="event_time", seq="event_id"
) -> DataFrame:
    """1 when the merchant is abroad and the key's previous event is less than ``minutes`` old."""
    return with_history(df, key=key, ts=ts, seq=seq).select(*df.columns, _geo_flag(ts, minutes))


def customer_features(
    df: DataFrame, key="customer_id", ts="event_time", seq="event_id", amount="amount",
    geo_minutes: int = 30,
) -> DataFrame:
    """All per-customer features of the transaction table in one pass over the history."""
    out = with_history(df, key=key, ts=ts, seq=seq, amount=amount, widths=(300, 3600))
    return out.select(*df.columns, *feature_columns(ts, amount, geo_minutes))


def feature_columns(ts="event_time", amount="amount", geo_minutes: int = 30) -> list[Column]:
    """The features as columns over rows that :func:`with_history` (widths 300 and 3600) has been over."""
    return [
        _days_since(ts),
        F.col("h_w300").cast("int").alias("velocity_5min"),
        F.col("h_w3600").cast("int").alias("velocity_1hour"),
        *_lifetime_columns(amount),
        _geo_flag(ts, geo_minutes),
    ]


def flag_out_of_order(
    df: DataFrame, key="customer_id", ts="event_time", arrival="arrival_time", seq="event_id"
) -> DataFrame:
    """1 when an event is older than one of the same key that arrived before it."""
    out = with_history(df, key=key, ts=arrival, seq=seq, latest=ts)
    late = micros(F.col(ts)) < F.col("h_max_us")
    return out.select(
        *df.columns,
        F.when(F.coalesce(late, F.lit(False)), 1).otherwise(0).alias("out_of_order"),
        from_micros(F.col("h_max_us")).alias("newest_seen"),
    )
