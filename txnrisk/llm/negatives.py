"""Hard-negative mining with exact scores by the Four-Russians method.

Components become integers. A row's integers are stored as bit planes: of each bit, eight dimensions in a
byte. For an anchor and eight dimensions there is a table of the sums of all 256 subsets of its components,
so a plane's share of the inner product is one lookup per byte, and planes are added with a shift each. The
scores are those of the integers, without rounding.

Anchors are scored against all rows in blocks: rows and anchors are dealt into a grid of cells of bounded
size, a task scores a cell, and of each cell only the best few per anchor leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.common import map_arrow, saved, ship

SCALE = 256
#: Rows and anchors of a cell; anchors and rows that are scored at a time.
ROWS, ANCHORS = 8192, 2048
WIDE, TALL = 128, 1024
POSITIVES = NEGATIVES = 5
#: A negative's score is at least so many hundredths of its positive's, and not above it.
LEAST = 80


def planes(q: np.ndarray) -> np.ndarray:
    """Bit planes of rows of integers in two's complement: (rows, planes, bytes); the last plane is the sign."""
    bits = int(np.maximum(q, ~q).max(initial=0)).bit_length() + 1
    ones = (q[:, None, :] >> np.arange(bits)[None, :, None]) & 1
    return np.packbits(ones.astype(np.uint8), axis=2, bitorder="little")


def integers(coded: np.ndarray, dimensions: int) -> np.ndarray:
    """Inverse of :func:`planes`."""
    ones = np.unpackbits(coded, axis=2, count=dimensions, bitorder="little").astype(np.int64)
    weights = 1 << np.arange(coded.shape[1], dtype=np.int64)
    weights[-1] = -weights[-1]
    return np.einsum("rpd,p->rd", ones, weights)


def scores(coded: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products of rows of bit planes (R, P, G) with anchors (A, 8 G): (A, R), exact."""
    rows, bits, groups = coded.shape
    subsets = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
    # Anything that is added up is an inner product of the anchor with numbers of at most 2 ** bits.
    small = int(np.abs(anchors).sum(axis=1).max(initial=0)) << bits < 1 << 31
    kind = np.int32 if small else np.int64
    tables = np.stack([subsets @ anchors[:, 8 * g : 8 * g + 8].T for g in range(groups)]).astype(kind) if groups else None
    out = np.zeros((len(anchors), rows), dtype=np.int64)
    for at in range(0, rows if groups else 0, TALL):
        block = coded[at : at + TALL]
        total = np.zeros((len(block), len(anchors)), dtype=kind)
        for p in range(bits - 1, -1, -1):
            total += total
            for g in range(groups):
                if p == bits - 1:
                    total -= tables[g][block[:, p, g]]
                else:
                    total += tables[g][block[:, p, g]]
        out[:, at : at + TALL] = total.T
    return out


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, size, planes) of (vec_id, label, vector)."""
    for batch in batches:
        lists = batch.column(2)
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        starts = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        for size in np.unique(sizes).tolist():
            of = np.flatnonzero(sizes == size)
            q = np.floor(SCALE * flat[starts[of][:, None] + np.arange(size)])
            if size and float((q * q).sum(axis=1).max()) >= 2.0**62:
                raise ValueError("a vector is too long for exact 64-bit scores")
            found = [p.tobytes() for p in planes(q.astype(np.int64))]
            columns = [batch.column(0).take(pa.array(of)), batch.column(1).take(pa.array(of)), pa.array(np.full(len(of), size, np.int32)), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "size", "planes"])


def coded(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, label, size, planes) of all rows that take part, written once so that row numbers stay."""
    e = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), e.alias("e")).where("vec_id is not null and label is not null and e is not null")
    rows = rows.where(F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    found = map_arrow(rows, _coded, "vec_id long, label string, size int, planes binary")
    return saved(found.withColumn("row", F.monotonically_increasing_id()), "planes")


def _best(values: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` by falling value, then rising id."""
    places = np.arange(len(values))
    if len(values) > most:
        places = np.flatnonzero(values >= np.partition(values, len(values) - most)[len(values) - most])
    return places[np.lexsort((ids[places], -values[places]))][:most]


def _stack(table: pa.Table, dimensions: int) -> np.ndarray:
    """Bit planes of the rows of a cell, the sign repeated where a row has fewer of them."""
    groups = -(-dimensions // 8)
    lists = [np.frombuffer(p, np.uint8) for p in table["planes"].to_pylist()]
    depth = np.array([len(p) // groups if groups else 1 for p in lists])
    out = np.zeros((len(lists), int(depth.max()), groups), np.uint8)
    for bits in np.unique(depth).tolist():
        of = np.flatnonzero(depth == bits)
        own = np.stack([lists[i] for i in of.tolist()]).reshape(len(of), bits if groups else 1, groups)
        out[of, :bits] = own
        out[of, bits:] = own[:, -1:]
    return out


def _cell(positives: bool, most: int, least: int):
    """Of a cell's rows the best of each anchor: of its label, or of others within reach of each of its positives."""

    def work(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if rows.num_rows and anchors.num_rows:
            rows = rows.sort_by("vec_id")
            dimensions = rows["size"][0].as_py()
            blocks, own = _stack(rows, dimensions), _stack(anchors, dimensions)
            q = integers(own, dimensions)
            q = np.pad(q, ((0, 0), (0, -dimensions % 8)))
            names = np.concatenate((rows["label"].to_numpy(), anchors["label"].to_numpy()))
            labels = np.unique(names, return_inverse=True)[1]
            labels, theirs = labels[: len(blocks)], labels[len(blocks) :]
            ids, numbers = rows["vec_id"].to_numpy(), rows["row"].to_numpy()
            anchor_rows, anchor_ids = anchors["row"].to_numpy(), anchors["vec_id"].to_numpy()
            wanted = None if positives else anchors["found"].to_pylist()
            by_label = np.argsort(theirs, kind="stable")
            for at in range(0, len(by_label), WIDE):
                chunk = by_label[at : at + WIDE]
                for groups in (np.split(chunk, np.flatnonzero(np.diff(theirs[chunk])) + 1) if positives else [chunk]):
                    of = np.flatnonzero(labels == theirs[groups[0]]) if positives else np.arange(len(blocks))
                    scored = scores(blocks[of], q[groups])
                    for a, values in zip(groups.tolist(), scored):
                        if positives:
                            open_ = np.flatnonzero(numbers[of] != anchor_rows[a])
                            best = open_[_best(values[open_], ids[of][open_], most)]
                            found += [(anchor_rows[a], anchor_ids[a], 0, ids[of[b]], values[b]) for b in best.tolist()]
                            continue
                        limits = [(f["k"], -(-least * f["score"] // 100), f["score"]) for f in wanted[a]]
                        low, high = min(x[1] for x in limits), max(x[2] for x in limits)
                        open_ = np.flatnonzero((labels != theirs[a]) & (values >= low) & (values <= high))
                        for k, low, high in limits:
                            near = open_[(values[open_] >= low) & (values[open_] <= high)]
                            best = near[_best(values[near], ids[near], most)]
                            found += [(anchor_rows[a], anchor_ids[a], k, ids[b], values[b]) for b in best.tolist()]
        columns = list(zip(*found)) or [()] * 5
        return pa.table({name: pa.array(np.array(c, dtype=np.int64)) for name, c in zip(("anchor", "anchor_id", "k", "vec_id", "score"), columns)})

    return work


def _grid(rows: DataFrame, anchors: DataFrame, work) -> DataFrame:
    """``work`` on each cell of rows and anchors of one length. The numbers of cells follow from those of rows."""
    across, down = (max(1, -(-n // most)) for n, most in ((rows.count(), ROWS), (anchors.count(), ANCHORS)))
    place = F.xxhash64("row")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("x", F.pmod(place, F.lit(across)).cast("int")).withColumn("y", every(down))
    right = anchors.withColumn("y", F.pmod(place, F.lit(down)).cast("int")).withColumn("x", every(across))
    ship(rows.sparkSession)
    cells = left.groupBy("size", "x", "y").cogroup(right.groupBy("size", "x", "y"))
    return cells.applyInArrow(work, "anchor long, anchor_id long, k long, vec_id long, score long")


def _first(found: DataFrame, most: int, name: str, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= most)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of (vec_id, embedding, label).

    ``is_anchor`` tells from vec_id which rows are anchors. Positives are an anchor's first rows of its label; the
    negatives of a positive are the first rows of other labels with at least ``least`` hundredths of its score and at
    most its score. First is by falling score, then rising vec_id. Rows without vec_id, label or vector, or with null
    or non-finite components, take no part. Vectors of different lengths have no score together. Rows that repeat a
    vec_id count each on their own, also as anchors. A vector whose squared length, in steps, reaches 2 ** 62 stops the
    run, as its scores fit no long. An empty table, or one without anchors, gives no rows; other columns aren't read.
    """
    rows = coded(vectors)
    anchors = rows.where(is_anchor)
    found = saved(_grid(rows, anchors, _cell(True, positives, least)), "positives-of-cells")
    own = saved(_first(found, positives, "k", "anchor").select("anchor", F.col("k").cast("long").alias("k"), "vec_id", "score"), "positives")
    lists = own.groupBy("anchor").agg(F.collect_list(F.struct("k", "score")).alias("found"))  # at most `positives` each
    anchors = anchors.join(lists, F.col("row") == F.col("anchor")).drop("anchor")
    found = saved(_grid(rows, saved(anchors, "anchors"), _cell(False, negatives, least)), "negatives-of-cells")
    best = _first(found, negatives, "rank", "anchor", "k")
    best = best.select("anchor", "k", "anchor_id", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = own.select("anchor", "k", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return best.join(pairs, ["anchor", "k"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
