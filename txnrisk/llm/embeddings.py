"""Embedding near-duplicates: Euclidean p-stable hashing, then exact cosines.

Normalised vectors are projected on random Gaussian directions, shifted and cut into cells; a few such
cells make a key, and vectors that share the key of some table are compared by exact cosine. Cells per
key grow with the logarithm of the number of vectors, so that a bucket of unlike vectors stays small,
and tables are as many as a pair at the threshold needs to meet in one with the wished probability.

Equal vectors are one class and are compared once. A large bucket is cut into blocks, and each pair of
blocks is a group of its own, so a hot bucket spreads over tasks. A pair that meets in several tables
counts in the first of them alone, so links are summed up without collecting pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import map_arrow, saved
from txnrisk.llm.components import components

COSINE = 0.9
#: Width of a cell; that of vectors has no unit, as they are normalised.
WIDTH = 2.0
#: Wished probability that a pair right at the threshold meets in some table; closer pairs meet more often.
RECALL = 0.9
#: Vectors of a bucket that are compared in one matrix product.
BLOCK = 512
SEED = 11
#: Lists of up to so many members are compared together; pairs that are compared at a time.
SMALL, PAIRS = 24, 1 << 17


def meeting(distance: float) -> float:
    """Probability that two points at this distance fall into the same cell."""
    t = WIDTH / distance
    phi = 0.5 * math.erfc(t / math.sqrt(2))
    return 1 - 2 * phi - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def plan(n: int) -> tuple[int, int]:
    """Cells per key and tables for ``n`` vectors."""
    near, far = meeting(math.sqrt(2 - 2 * COSINE)), meeting(math.sqrt(2.0))
    cells = max(2, math.ceil(math.log(max(n, 2)) / -math.log(far)))
    tables = math.ceil(math.log(1 - RECALL) / math.log1p(-(near**cells)))
    return cells, tables


@lru_cache(4)
def _directions(dimensions: int, cells: int, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dimensions, cells, tables])
    mix = rng.integers(1, 1 << 62, cells * tables, dtype=np.int64) | 1
    return rng.standard_normal((dimensions, cells * tables)), rng.uniform(0, WIDTH, cells * tables), mix


def keys(vectors: np.ndarray, cells: int, tables: int) -> np.ndarray:
    """One 64-bit key per vector (rows, of length 1) and table."""
    directions, shift, mix = _directions(vectors.shape[1], cells, tables)
    cell = np.floor((vectors @ directions + shift) / WIDTH).astype(np.int64)
    with np.errstate(over="ignore"):
        return (cell * mix).reshape(len(vectors), tables, cells).sum(axis=2)


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, unit vector as bytes of doubles); null where a vector links with nothing."""
    for batch in batches:
        out = []
        for values in batch.column(1).to_pylist():
            v = None if not values or None in values else np.array(values, dtype=np.float64)
            scale = 0.0 if v is None else np.abs(v).max()
            if v is None or not np.isfinite(scale) or not scale:
                out.append(None)
                continue
            v = v / scale  # neither overflow nor underflow in the length
            out.append((v / math.sqrt(float(v @ v))).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "unit"])


def _keyed(cells: int, tables: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, classes = (batch.column(k).to_pylist() for k in range(2))
            by_size: dict[int, list[int]] = {}
            for i, u in enumerate(units):
                by_size.setdefault(len(u), []).append(i)
            for of in by_size.values():
                for at in range(0, len(of), 1024):
                    part = of[at : at + 1024]
                    found = keys(np.stack([np.frombuffer(units[i]) for i in part]), cells, tables)
                    n = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat([classes[i] for i in part], tables), pa.int64()),
                            pa.array(np.tile(np.arange(tables, dtype=np.int32), n)), pa.array(found.reshape(-1)),
                            pa.array(np.repeat([len(units[i]) // 8 for i in part], tables), pa.int32()),
                        ],
                        ["class_id", "tab", "key", "size"],
                    )

    return work


def _roots(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """For each of ``n`` members the least one that the pairs reach."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[p], root[q])
        new = root.copy()
        np.minimum.at(new, root[p], low)
        np.minimum.at(new, root[q], low)
        while not np.array_equal(up := new[new], new):
            new = up
        if np.array_equal(new, root):
            return root
        root = new


def _members(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Class ids, copies and units of all lists, and where each list begins."""
    flat = lists.flatten()
    sizes = np.array([len(x) if x is not None else 0 for x in lists], dtype=np.int64)
    ids, copies = flat.field("class_id").to_numpy(zero_copy_only=False), flat.field("copies").to_numpy(zero_copy_only=False)
    return ids, copies, flat.field("unit").to_pylist(), np.concatenate(([0], np.cumsum(sizes)))


def _pairs(left: np.ndarray, right: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Members to compare: all pairs of each small list, gathered; each pair of blocks on its own."""
    sizes = np.diff(left)
    if right is None:
        for size in np.unique(sizes[(sizes > 1) & (sizes <= SMALL)]).tolist():
            i, j = np.triu_indices(size, 1)
            starts = left[:-1][sizes == size]
            step = max(1, PAIRS // len(i))
            for at in range(0, len(starts), step):
                own = starts[at : at + step, None]
                yield (own + i).ravel(), (own + j).ravel()
        for k in np.flatnonzero(sizes > SMALL).tolist():
            i, j = np.triu_indices(int(sizes[k]), 1)
            yield left[k] + i, left[k] + j
    else:
        for k in range(len(sizes)):
            i, j = np.indices((int(sizes[k]), int(right[k + 1] - right[k])))
            yield left[k] + i.ravel(), right[k] + j.ravel()


def _links(cells: int, tables: int, threshold: float):
    """Links of each class, and edges that span what the links connect, from lists of members of a bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = batch.column(0).to_numpy()
            ids, copies, units, left = _members(batch.column(1))
            own_table = np.repeat(table, np.diff(left))
            right = None
            if batch.num_columns == 3:
                more = _members(batch.column(2))
                right = more[3] + len(ids)
                own_table = np.concatenate((own_table, np.repeat(table, np.diff(more[3]))))
                ids, copies, units = np.concatenate((ids, more[0])), np.concatenate((copies, more[1])), units + more[2]
            if not len(ids):
                continue
            widths = np.array([len(u) for u in units])
            at = np.zeros(len(units), dtype=np.int64)
            matrix = {}
            for width in np.unique(widths).tolist():  # a bucket has vectors of one length
                of = np.flatnonzero(widths == width)
                matrix[width] = np.frombuffer(b"".join([units[i] for i in of.tolist()])).reshape(len(of), -1)
                at[of] = np.arange(len(of))
            links, found_p, found_q = np.zeros(len(ids), np.int64), [], []
            for p, q in _pairs(left, right):
                for low in range(0, len(p), PAIRS):
                    a, b = p[low : low + PAIRS], q[low : low + PAIRS]
                    near = np.zeros(len(a), dtype=bool)
                    for width, rows in matrix.items():
                        of = np.flatnonzero(widths[a] == width)
                        near[of] = np.einsum("ij,ij->i", rows[at[a[of]]], rows[at[b[of]]]) >= threshold
                    a, b = a[near], b[near]
                    if not len(a):
                        continue
                    # A pair counts in the first table where it meets.
                    for width, rows in matrix.items():
                        of = np.flatnonzero(widths[a] == width)
                        used, place = np.unique(np.concatenate((a[of], b[of])), return_inverse=True)
                        if not len(used):
                            continue
                        key = keys(rows[at[used]], cells, tables)
                        first = (key[place[: len(of)]] == key[place[len(of) :]]).argmax(axis=1) == own_table[a[of]]
                        i, j = a[of][first], b[of][first]
                        np.add.at(links, i, copies[j])
                        np.add.at(links, j, copies[i])
                        found_p.append(i)
                        found_q.append(j)
            if not found_p:
                continue
            root = _roots(len(ids), np.concatenate(found_p), np.concatenate(found_q))
            of = np.flatnonzero(links)
            columns = [pa.array(ids[of]), pa.array(links[of]), pa.array(ids[root[of]])]
            yield pa.RecordBatch.from_arrays(columns, ["class_id", "links", "other"])

    return work


def near_duplicates(vectors: DataFrame, threshold: float = COSINE) -> DataFrame:
    """Per row of (vec_id, embedding): vec_id, n_links, component_id, kept.

    A vector that is null, empty, zero or holds null or non-finite components links with nothing, nor does
    a row without vec_id or a vector of another length. Rows that repeat a vector, with whatever id, are
    links of each other. Other columns aren't read.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    units = saved(map_arrow(rows, _unit, "vec_id long, unit binary"), "units")
    whole = units.where("unit is not null and vec_id is not null")
    classes = saved(whole.groupBy("unit").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies")), "classes")
    cells, tables = plan(classes.count())
    index = map_arrow(classes.select("unit", "class_id"), _keyed(cells, tables), "class_id long, tab int, key long, size int")
    bucket = ["tab", "key", "size"]
    index = saved(index, "index")
    counts = saved(index.groupBy(*bucket).count().where("count > 1"), "bucket-sizes")
    met = index.join(counts, bucket)
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    met = met.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
    own = met.join(classes, "class_id").groupBy(*bucket, "blocks", "block")
    lists = saved(own.agg(F.collect_list(F.struct("class_id", "copies", "unit")).alias("members")), "blocks")
    schema = "class_id long, links long, other long"
    inside = map_arrow(lists.select("tab", "members"), _links(cells, tables, threshold), schema)
    hot = lists.where("blocks > 1")
    x, y = hot.alias("x"), hot.alias("y")
    same = F.expr(" and ".join(f"x.{c} = y.{c}" for c in bucket) + " and x.block < y.block")
    across = x.join(y, same).select("x.tab", F.col("x.members").alias("m"), F.col("y.members").alias("n"))
    found = saved(inside.unionByName(map_arrow(across, _links(cells, tables, threshold), schema)), "links")
    labels = components(found.select(F.col("class_id").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    joined = classes.join(links, "class_id", "left").join(labels, F.col("class_id") == F.col("node"), "left")
    known = saved(joined.select("unit", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "class_id").alias("c")), "vector-classes")
    out = units.join(known, "unit", "left")
    linked = F.col("vec_id").isNotNull() & F.col("c").isNotNull()
    component = F.when(linked, F.col("c")).otherwise(F.col("vec_id"))
    n_links = F.when(linked, F.col("n")).otherwise(F.lit(0).cast("long"))
    return out.select("vec_id", n_links.alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
