"""Documents alike in their five-word shingles: SimHash deletion variants retrieve families, exact Jaccard links them.

Operator 1's setting for stages without a contract of their own. A document is the set of its shingles, and
equal sets are one class. Half of the set's 256-bit SimHash is cut into segments, and a class is indexed under
each segment with one bit wiped in turn, so two classes that differ in at most one bit of some segment meet by
an equality join. Those that meet and are near in the other half are one family. Segments grow with the
logarithm of the number of classes beyond 2 ** 24, so that a bucket of unlike classes stays small, and there are
as many as a pair right at the threshold needs to meet with the wished probability.

What leaves a bucket are edges that span its near members, never its pairs. A key that very many classes share
isn't gathered: its classes are compared with a few leaders, those near a leader are one family, and the rest are
compared with all classes of the key, in lists of bounded length.

In a family all pairs are compared by their sets: a small family in one group, a large one in cells of two blocks
of bounded size, and sizes too far apart for the threshold never meet. Only edges that span what is alike leave a
cell, and cells of families that are connected already aren't compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.common import chosen_rows, map_arrow, saved, ship
from txnrisk.llm.components import components
from txnrisk.storage import planned_bytes

WORDS, SIMILARITY, SEED = 5, 0.8, 42
BITS = 256
#: Share of bits that a pair at the threshold has in common; that of a few shingles is about 0.82.
AGREE = 0.85
#: Wished probability that such a pair meets under some key; closer pairs meet more often.
RECALL = 0.98
#: Least bits of a segment; classes that may share a key by chance are at most two to the second number.
LEAST_BITS, CROWD_BITS = 14, 10
#: Of the 128 bits that aren't in keys, near classes differ in at most so many: 2.3 standard deviations
#: beyond what a share of 0.82 expects; unlike classes differ in so few once in 5e7.
NEAR = 33
#: A key is hot if so many of the sampled classes, one in ``SAMPLE``, have it; leaders that its classes are compared with.
SAMPLE, HOT, LEADERS = 64, 64, 64
#: Classes that are compared with all of a hot key in one list.
REST = 1024
#: Buckets of up to so many classes are compared together; pairs that are compared at a time.
SMALL, PAIRS = 64, 1 << 17
#: Hashes and classes of a block of a large family.
HASHES, CLASSES = 1 << 20, 2048
#: Hashes that more classes of a cell have are counted by matrix products, others one by one.
DENSE, COLUMNS = 32, 2048
_MIX = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]
_MEMBERS = "class_id long, c0 long, c1 long"


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the different shingles; words as in ``simhash.fingerprint``, fewer than five are one shingle."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()
    whole = b" ".join(words)
    if len(words) <= WORDS:
        found = [whole] if words else []
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: 1 - WORDS].tolist()
        found = [whole[s:e] for s, e in zip(starts, ends[WORDS - 1 :].tolist())]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, SEED) for s in found], dtype="<u8"))


def fingerprint(hashes: np.ndarray) -> bytes:
    """256-bit SimHash of a set: each hash is mixed in four ways."""
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        x = hashes[at : at + 4096, None] * np.array(_MIX, dtype="<u8")
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        ones += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").tobytes()


def class_id(hashes: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(hashes.tobytes(), SEED) - (1 << 63)


def meeting(bits: int, agree: float = AGREE) -> float:
    """Probability that a segment differs in at most one bit."""
    return agree ** (bits - 1) * (agree + bits * (1 - agree))


def plan(n: int) -> tuple[int, int]:
    """Bits of a segment and segments for ``n`` classes."""
    bits = max(LEAST_BITS, math.ceil(math.log2(max(n, 2))) - CROWD_BITS)
    return bits, math.ceil(math.log(1 - RECALL) / math.log1p(-meeting(bits)))


def segments(bits: int, count: int) -> np.ndarray:
    """Places of each segment's bits: the first half of the fingerprint, cut up in one order after another."""
    rng, found = np.random.default_rng([SEED, bits]), []
    while len(found) < count:
        order = rng.permutation(BITS // 2)
        found += [order[at : at + bits] for at in range(0, BITS // 2 - bits + 1, bits)]
    return np.stack(found[:count])


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(class_id(s), len(s), fingerprint(s)) for s in (shingles(t.as_py()) for t in batch.column(1))]
        columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.binary()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "class_id", "n", "fp"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
        sets = [shingles(t) for t in batch.column(1).to_pylist()]
        columns = [pa.array([class_id(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["class_id", "hashes"])


def _keyed(bits: int, count: int):
    """(class_id, c0, c1, keys): a key for each segment and wiped bit, and the bits that keys don't have."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, powers = segments(bits, count), 1 << np.arange(bits, dtype=np.int64)
        wiped = ~powers
        tag = (np.arange(count, dtype=np.int64)[:, None] << 40) | (np.arange(bits, dtype=np.int64) << 32)
        for batch in (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512)):
            fps = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, BITS // 8)
            ones = np.unpackbits(fps, axis=1, bitorder="little")
            values = np.stack([ones[:, of] @ powers for of in chosen], axis=1)
            keys = ((values[:, :, None] & wiped) | tag).reshape(len(fps), -1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel()))
            rest = fps.view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rest[:, 2]), pa.array(rest[:, 3]), lists], ["class_id", "c0", "c1", "keys"])

    return work


def _flat(members: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and open bits of all lists of members, and where each list begins."""
    flat = members.flatten()
    ids, c0, c1 = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("class_id", "c0", "c1"))
    sizes = np.array([len(x) for x in members], dtype=np.int64)
    return ids, np.stack((c0, c1), axis=1), np.concatenate(([0], np.cumsum(sizes)))


def _differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count((x ^ y).view(np.uint64)).sum(axis=-1)  # of signed numbers, numpy counts the magnitude's bits


def roots(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """For each of ``n`` members the least one that the pairs reach."""
    root = np.arange(n)
    while True:
        low, new = np.minimum(root[p], root[q]), root.copy()
        np.minimum.at(new, root[p], low)
        np.minimum.at(new, root[q], low)
        while not np.array_equal(up := new[new], new):
            new = up
        if np.array_equal(new, root):
            return root
        root = new


def _spanning(ids: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Edges from each member to the least id that the pairs connect it with."""
    edges = np.empty((0, 2), dtype=np.int64)
    if pairs:
        root = roots(len(ids), *(np.concatenate(x) for x in zip(*pairs)))
        least = ids.copy()
        np.minimum.at(least, root, ids)
        edges = np.stack((ids, least[root]), axis=1)
        edges = np.unique(edges[edges[:, 0] != edges[:, 1]], axis=0)
    return pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], ["a", "b"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that span the near members of each bucket."""
    for batch in (b.slice(at, 4096) for b in batches for at in range(0, b.num_rows, 4096)):
        ids, bits, left = _flat(batch.column(0))
        sizes, pairs = np.diff(left), []

        def meet(p: np.ndarray, q: np.ndarray) -> None:
            of = _differing(bits[p], bits[q]) <= NEAR
            if of.any():
                pairs.append((p[of], q[of]))

        for size in np.unique(sizes[(sizes > 1) & (sizes <= SMALL)]).tolist():
            i, j = np.triu_indices(size, 1)
            starts = left[:-1][sizes == size]
            step = max(1, PAIRS // len(i))
            for at in range(0, len(starts), step):
                own = starts[at : at + step, None]
                meet((own + i).ravel(), (own + j).ravel())
        for k in np.flatnonzero(sizes > SMALL).tolist():
            members = np.arange(left[k], left[k + 1])
            step = max(1, PAIRS // len(members))
            for at in range(0, len(members), step):
                rows = members[at : at + step]
                p, q = np.repeat(rows, len(members) - at), np.tile(members[at:], len(rows))
                meet(p[p < q], q[p < q])
        yield _spanning(ids, pairs)


def _to_leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An edge to the first leader for each class near some leader of its key; the key again for each other class."""
    for batch in batches:
        ids, bits, left = _flat(batch.column(4))
        own = np.stack([batch.column(k).to_numpy() for k in (2, 3)], axis=1)
        row = np.repeat(np.arange(batch.num_rows), np.diff(left))
        near = np.zeros(batch.num_rows, dtype=bool)
        near[row[_differing(own[row], bits) <= NEAR]] = True
        first = ids[left[:-1]]
        edges = [pa.array(first, mask=~near), pa.array(batch.column(0).to_numpy(), mask=near)]
        yield pa.RecordBatch.from_arrays([batch.column(1), *edges, batch.column(2), batch.column(3)], ["class_id", "b", "key", "c0", "c1"])


def _to_rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges between a class and those near it in a list of the key's rest."""
    for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
        ids, bits, left = _flat(batch.column(3))
        own, names = np.stack([batch.column(k).to_numpy() for k in (1, 2)], axis=1), batch.column(0).to_numpy()
        row = np.repeat(np.arange(batch.num_rows), np.diff(left))
        of = (_differing(own[row], bits) <= NEAR) & (names[row] != ids)
        edges = np.unique(np.stack((np.maximum(names[row], ids)[of], np.minimum(names[row], ids)[of]), axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], ["a", "b"])


def _member(ids: str = "class_id"):
    return F.struct(F.col(ids).alias("class_id"), "c0", "c1")


def _maybe_broadcast(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if planned_bytes(df) <= 8 << 20 else df


def families(classes: DataFrame) -> DataFrame:
    """Edges (a, b) that span the families of classes (class_id, fp)."""
    spark = classes.sparkSession
    bits, count = plan(classes.count())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def entries(of: DataFrame) -> DataFrame:
        keyed = map_arrow(of.select("class_id", "fp"), _keyed(bits, count), f"{_MEMBERS}, keys array<long>")
        return keyed.select(F.explode("keys").alias("key"), "class_id", "c0", "c1")

    sample = entries(classes.where(F.pmod(F.xxhash64("class_id"), F.lit(SAMPLE)) == 0))
    order = F.row_number().over(Window.partitionBy("key").orderBy("class_id"))
    first = sample.withColumn("nth", order).where(F.col("nth") <= max(HOT, LEADERS))
    lists = first.groupBy("key").agg(F.slice(F.array_sort(F.collect_list(_member())), 1, LEADERS).alias("leaders"), F.count("*").alias("n"))
    hot = saved(lists.where(F.col("n") >= HOT).select("key", "leaders"), "hot-keys")
    if not hot.head(1):
        return _bucket_edges(entries(classes), parts)
    keys = _maybe_broadcast(hot.select("key"))
    edges = _bucket_edges(entries(classes).join(keys, "key", "left_anti"), parts)
    crowd = saved(entries(classes).join(keys, "key", "left_semi"), "hot-entries")
    led = crowd.join(_maybe_broadcast(hot), "key").select("key", "class_id", "c0", "c1", "leaders")
    led = saved(map_arrow(led, _to_leaders, "class_id long, b long, key long, c0 long, c1 long"), "led")
    edges = edges.unionByName(led.where("b is not null").select(F.col("class_id").alias("a"), "b").distinct())
    rest = led.where("key is not null")
    # Lists of about REST classes, as many as the key's rest needs.
    sizes = rest.groupBy("key").agg(F.ceil(F.count("*") / REST).alias("lists"))
    rest = rest.join(_maybe_broadcast(saved(sizes, "rest-sizes")), "key").withColumn("part", F.pmod(F.xxhash64("class_id"), F.col("lists")))
    rest = saved(rest.groupBy("key", "part").agg(F.collect_list(_member()).alias("members")), "rest")
    met = crowd.join(_maybe_broadcast(rest), "key").select("class_id", "c0", "c1", "members")
    return edges.unionByName(map_arrow(met, _to_rest, "a long, b long").distinct())


def _bucket_edges(entries: DataFrame, parts: int) -> DataFrame:
    # Dealt out before they are gathered: a sum per task first would sort every row once more.
    members = entries.repartition(parts, "key").groupBy("key").agg(F.collect_list(_member()).alias("members"))
    members = members.where(F.size("members") > 1).select("members")
    return map_arrow(members, _near, "a long, b long").distinct()


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many hashes each two of the sets have in common, above the diagonal."""
    n, sizes = len(sets), [len(s) for s in sets]
    values, owners = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    counts = np.diff(np.append(starts, len(values)))
    found = np.zeros((n, n), dtype=np.float32)
    dense = np.flatnonzero(counts > DENSE)
    for at in range(0, len(dense), COLUMNS):
        own = dense[at : at + COLUMNS]
        has = np.zeros((n, len(own)), dtype=np.float32)
        for c, k in enumerate(own.tolist()):
            has[owners[starts[k] : starts[k] + counts[k]], c] = 1
        found += has @ has.T
    flat = found.ravel()
    for size in np.unique(counts[(counts > 1) & (counts <= DENSE)]).tolist():
        i, j = np.triu_indices(size, 1)
        own = starts[counts == size]
        step = max(1, PAIRS // len(i))
        for at in range(0, len(own), step):
            first = own[at : at + step, None]
            p, q = owners[(first + i).ravel()], owners[(first + j).ravel()]
            np.add.at(flat, p * n + q, np.float32(1))  # owners of a hash are in rising order
    return found


def _alike(table: pa.Table) -> pa.Table:
    """Edges that span the classes of a cell which are alike."""
    ids = table["class_id"].to_numpy()
    if len(ids) > 1:
        sets = [np.frombuffer(h, "<u8") for h in table["hashes"].to_pylist()]
        sizes = np.array([len(s) for s in sets], dtype=np.float64)
        i, j = np.triu_indices(len(ids), 1)
        both = shared(sets)[i, j].astype(np.float64)
        of = both * (1 + SIMILARITY) >= SIMILARITY * (sizes[i] + sizes[j])
        return pa.Table.from_batches([_spanning(ids, [(i[of], j[of])] if of.any() else [])])
    return pa.Table.from_batches([_spanning(ids, [])])


def _cells(members: DataFrame) -> DataFrame:
    """(class_id, family, l1, b1, l2, b2) of classes (class_id, n, family): the cells that a class is compared in.

    A family of bounded size is one cell. Of others, classes are in levels by size, a factor of 1.25 apart, and in
    blocks by hash; a cell is two blocks of one level or of neighbouring ones, as others can't be alike.
    """
    totals = members.groupBy("family").agg(F.sum("n").alias("hashes"), F.count("*").alias("classes")).where("classes > 1")
    rows = members.join(totals, "family")
    small = (F.col("hashes") <= HASHES) & (F.col("classes") <= CLASSES)
    none = [F.lit(-1).alias(c) for c in ("l1", "b1", "l2", "b2")]
    large = rows.where(~small).withColumn("level", F.floor(F.log("n") / -math.log(SIMILARITY) + 1e-9).cast("int"))
    needed = F.ceil(F.greatest(F.sum("n") / HASHES, F.count("*") / CLASSES)).cast("int")
    levels = saved(large.groupBy("family", "level").agg(needed.alias("blocks")), "levels")
    beside = [levels.select("family", (F.col("level") - d).alias("level"), F.col("blocks").alias(c)) for d, c in ((1, "above"), (-1, "below"))]
    levels = levels.join(beside[0], ["family", "level"], "left").join(beside[1], ["family", "level"], "left")
    large = large.join(levels, ["family", "level"]).withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))

    def cells(count: str, l1, b1, l2, b2):
        upto = F.sequence(F.lit(0), F.coalesce(F.col(count), F.lit(0)) - 1)
        numbers = F.when(F.coalesce(F.col(count), F.lit(0)) > 0, upto).otherwise(F.array().cast("array<int>"))
        return F.transform(numbers, lambda b: F.struct(l1.alias("l1"), b1(b).alias("b1"), l2.alias("l2"), b2(b).alias("b2")))

    level, block = F.col("level"), F.col("block")
    every = F.concat(
        cells("blocks", level, lambda b: F.least(b, block), level, lambda b: F.greatest(b, block)),
        cells("above", level, lambda b: block, level + 1, lambda b: b),
        cells("below", level - 1, lambda b: b, level, lambda b: block),
    )
    large = large.select("class_id", "family", F.explode(every).alias("c")).select("class_id", "family", "c.*")
    return rows.where(small).select("class_id", "family", *none).unionByName(large)


def links(classes: DataFrame, rows: DataFrame) -> DataFrame:
    """Edges (a, b) that span the classes of Jaccard similarity of ``SIMILARITY`` or more within families.

    ``classes`` has (class_id, rep, n, fp) once each, ``rows`` (doc_id, text) with one of each class under its ``rep``.
    """
    labels = components(saved(families(classes), "family-edges")).select(F.col("node").alias("class_id"), F.col("component").alias("family"))
    members = saved(classes.select("class_id", "rep", "n").join(labels, "class_id"), "family-members")
    own = rows.join(members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").select("doc_id", "text")
    hashes = map_arrow(own, _sets, "class_id long, hashes binary").join(members.select("class_id"), "class_id", "left_semi")
    hashes = saved(hashes.dropDuplicates(["class_id"]), "sets")
    cells = saved(_cells(members.select("class_id", "n", "family")), "cells")
    ship(rows.sparkSession)

    def compared(some: DataFrame) -> DataFrame:
        groups = some.join(hashes, "class_id").groupBy("family", "l1", "b1", "l2", "b2")
        return saved(groups.applyInArrow(_alike, "a long, b long").distinct(), "alike")

    # First the small families, and of large ones each block and each pair with a first block.
    early = F.expr("b1 <= 0 or (l1 = l2 and b1 = b2)")
    edges, late = compared(cells.where(early)), cells.where(~early)
    if not late.head(1):
        return edges
    parts = components(edges).select(F.col("node").alias("class_id"), "component")
    split = members.join(parts, "class_id", "left").groupBy("family").agg(F.count_distinct(F.coalesce("component", "class_id")).alias("parts"))
    late = late.join(split.where("parts > 1").select("family"), "family", "left_semi")
    return edges.unionByName(compared(late)).distinct()


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component of classes that are alike, with all its columns: that of the least doc_id.

    Texts without words, null ones among them, are one class; a long text counts as a whole. Repeated rows and rows of
    one doc_id with equal sets are one row. Rows without a doc_id stay, and an empty table stays empty.
    """
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = saved(map_arrow(rows, _sketches, "doc_id long, class_id long, n int, fp binary"), "sketches")
    least = (F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("fp").alias("fp"))
    classes = saved(sketches.groupBy("class_id").agg(*least), "classes")
    labels = components(links(classes.where("n > 0"), rows))
    joined = classes.join(labels, F.col("class_id") == F.col("node"), "left")
    kept = joined.groupBy(F.coalesce("component", "class_id")).agg(F.min(F.struct("rep", "class_id")).alias("s"))
    kept = saved(kept.select(F.col("s.rep").alias("doc_id"), F.col("s.class_id").alias("key")), "kept")
    keys = sketches.select("doc_id", F.col("class_id").alias("key"))
    return chosen_rows(docs, keys, kept, lambda t: class_id(shingles(t)))
