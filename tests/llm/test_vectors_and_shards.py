"""Hard negatives, sharding and whitening against plain versions: odd rows, ties, repeats, empty tables, other lengths."""

import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from txnrisk.llm import negatives, queries, ring, whitening

VECTORS = "vec_id long, embedding array<double>, label int, row string, score string, x int, k int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, t, "r", "s", 1, 2) for i, e, t in rows], VECTORS).repartition(3)


ODD = [(500, None, 1), (501, [], 1), (502, [0.5] * 11 + [None], 1), (503, [float("nan")] * 12, 1), (504, [float("-inf")] * 12, 0), (None, [0.1] * 12, 1), (505, [0.1] * 12, None), (506, [0.3] * 5, 2), (600, [0.2] * 5, 2), (601, [], 2)]


# ---------------------------------------------------------------- hard negatives


def test_bit_planes_and_scores_are_exact():
    rng = np.random.default_rng(1)
    for high, d in ((1, 9), (300, 16), (1 << 20, 3), (1 << 27, 64)):
        q, anchors = rng.integers(-high, high, (50, d)), rng.integers(-high, high, (7, d))
        coded = negatives.planes(q)
        assert (negatives.integers(coded, d) == q).all()
        padded = np.pad(anchors, ((0, 0), (0, -d % 8)))
        assert (negatives.scores(coded, padded) == anchors @ q.T).all()
    assert negatives.planes(np.zeros((2, 0), np.int64)).shape == (2, 1, 0)


def plain_negatives(rows, is_anchor):
    whole = [(i, np.floor(256 * np.array(e)).astype(int), t) for i, e, t in rows if i is not None and t is not None and e is not None and None not in e and np.isfinite(np.array(e, dtype=float)).all()]
    out = []
    for a, (anchor, q, label) in enumerate(whole):
        if not is_anchor(anchor):
            continue
        scored = sorted((-int(q @ p), i, t) for b, (i, p, t) in enumerate(whole) if b != a and len(p) == len(q))
        for s, positive, _ in [x for x in scored if x[2] == label][:5]:
            near = [(-n, i) for n, i, t in scored if t != label and 80 * -s <= 100 * -n <= 100 * -s][:5]
            out += [(anchor, positive, k + 1, i, -s, n) for k, (n, i) in enumerate(near)]
    return Counter(out)


@pytest.mark.parametrize("rows,anchors", [(8192, 2048), (40, 3)])
def test_negatives_by_brute_force(spark, monkeypatch, rows, anchors):
    monkeypatch.setattr(negatives, "ROWS", rows)  # small: many cells
    monkeypatch.setattr(negatives, "ANCHORS", anchors)
    rng = np.random.default_rng(rows)
    centre = rng.standard_normal((6, 12))
    table = [(i, (centre[i % 6] + 0.4 * rng.standard_normal(12)).tolist(), int(rng.integers(0, 3))) for i in range(240)]
    table += [(i, [0.25] * 12, i % 3) for i in range(300, 340)]  # equal scores, in all labels
    table += [table[20], table[20], (20, table[21][1], 2), (7, table[8][1], 1)]  # rows and ids that stand twice
    table += [(-40, [-1.0] * 12, 0), (400, [100.0, -3.0] * 6, 1), *ODD]
    got = negatives.mine(vectors(spark, table), negatives.F.col("vec_id") % 20 == 0).collect()
    assert Counter(map(tuple, got)) == plain_negatives(table, lambda i: i % 20 == 0)
    assert len(got) > 50


def test_negatives_without_rows_or_anchors(spark):
    assert negatives.mine(vectors(spark, []), negatives.F.lit(True)).count() == 0
    assert negatives.mine(vectors(spark, [(1, [1.0], 1), *ODD]), negatives.F.lit(False)).count() == 0
    assert negatives.mine(vectors(spark, [(1, [1.0], 1)]), negatives.F.lit(True)).count() == 0
    with pytest.raises(Exception, match="too long"):
        negatives.mine(vectors(spark, [(1, [1e30] * 4, 1)]), negatives.F.lit(True)).count()


# ---------------------------------------------------------------- sharding


def place(value):
    return xxhash.xxh64_intdigest(struct.pack("<q", value), 42) >> (64 - ring.SLICE_BITS)


def plain_shards(ids, shards):
    """Rows of each slice to the shards clockwise, in rounds, each shard up to its bound, slices in ring order."""
    def point(s, r):
        h = xxhash.xxh64_intdigest(b"point", 42)
        h = xxhash.xxh64_intdigest(struct.pack("<q", s), h)
        return xxhash.xxh64_intdigest(struct.pack("<q", r), h)

    size, points = 1 << ring.SLICE_BITS, []
    for s in range(shards):
        for r in range(ring.VNODES):
            h = point(s, r)
            points.append((h >> (64 - ring.SLICE_BITS), h - (1 << 64) if h >> 63 else h, s))
    left = Counter(place(i) for i in ids)
    room = {s: len(ids) // shards + (s < len(ids) % shards) for s in range(shards)}
    order = {}
    for c in left:
        nearest = {}
        for at, h, s in points:
            nearest[s] = min(nearest.get(s, (2 * size, 0, s)), (at if at >= c else at + size, h, s))
        order[c] = [s for *_, s in sorted(nearest.values())]
    got = Counter()
    for choice in range(shards):
        for c in sorted(left):
            s = order[c][choice]
            take = min(left[c], room[s])
            got[c, s] += take
            left[c] -= take
            room[s] -= take
    return +got


@pytest.mark.parametrize("cell", [1 << 16, 20])
def test_shards_by_a_plain_version(spark, monkeypatch, cell):
    monkeypatch.setattr(ring, "CELL", cell)  # small: one id's rows fall into many cells
    rows = [(i, "é" * (i % 7)) for i in range(1500)] + [(3, "same")] * 700 + [(4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, shard string, slice int").repartition(3)
    got = ring.shard(docs, 8).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((place(r.doc_id), r.shard) for r in got) == plain_shards([i for i, _ in rows], 8)
    for s in range(8):
        own = sorted(r.slot for r in got if r.shard == s)
        assert own == list(range(len(own))) and len(own) - len(rows) // 8 in (0, 1)
    once = {r.doc_id: r.shard for r in got if r.doc_id > 5}
    grown = {r.doc_id: r.shard for r in ring.shard(docs, 9).collect() if r.doc_id > 5}
    moved = sum(grown[i] not in (8, s) for i, s in once.items()) / len(once)
    assert moved < 0.45
    # Without a hot id and with slack, hardly a row moves between old shards.
    some = docs.where("text is null or text <> 'same'")
    once, grown = ({r.doc_id: r.shard for r in ring.shard(some, n, slack=0.5).collect()} for n in (8, 9))
    assert sum(grown[i] not in (8, s) for i, s in once.items()) / len(once) < 0.05 < sum(s == 8 for s in grown.values()) / len(grown)


def test_shards_of_few_rows(spark):
    docs = spark.createDataFrame([(None, None), (1, "a"), (None, "b")], "doc_id long, text string")
    got = ring.shard(docs, 8).collect()
    assert sorted(r.shard for r in got) == [0, 1, 2] and all(r.slot == 0 for r in got)
    assert ring.shard(docs.limit(0), 8).count() == 0


def test_sharding_stays_out_of_python(spark):
    plan = queries.op12_sharding(spark, "/root/testdata/sf0.001")
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
    assert set(plan.columns) == {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}


# ---------------------------------------------------------------- ids outside the table of pieces


def test_pieces_that_do_not_exist_stop_the_run(spark):
    from txnrisk.llm import pieces

    schema = "doc_id long, ids array<int>"
    assert [r.text for r in pieces.decode(spark.createDataFrame([(1, None), (2, [])], schema), "piece_bpe_32k.model").collect()] == ["", ""]
    for ids in ([5, 10**6], [-1], [None]):
        with pytest.raises(Exception, match="table of pieces"):
            pieces.decode(spark.createDataFrame([(1, ids)], schema), "piece_bpe_32k.model").collect()


# ---------------------------------------------------------------- whitening


@pytest.mark.parametrize("block,columns", [(1024, 1024), (16, 5)])
def test_whitening_by_numpy(spark, monkeypatch, block, columns):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", block)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", columns)
    rng = np.random.default_rng(3)
    e = rng.standard_normal((300, 12)) @ rng.standard_normal((12, 12))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(e)] + [(7, e[7].tolist(), 0), (None, e[8].tolist(), 1), *[r for r in ODD if r[0] not in (None, 505)]]
    got = whitening.whiten(vectors(spark, rows), 10).collect()
    x = np.floor(64 * np.array([v for _, v, _ in rows[:302]])).astype(int) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    cov = centred.T @ centred / n
    values, directions = np.linalg.eigh(cov)
    values, directions = values[::-1], directions[:, ::-1]
    assert len(got) == 302 * 10 and {r.n for r in got} == {302}
    plain = centred @ directions[:, :10] / np.sqrt(values[:10])
    mine = {}
    for r in got:
        mine.setdefault((r.vec_id, r.component), []).append(r)
    for c in range(1, 11):
        sign = np.sign(mine[0, c][0].whitened * plain[0, c - 1])
        for k, (i, _, _) in enumerate(rows[:302]):
            own = mine[i, c]
            assert min(abs(sign * r.whitened - plain[k, c - 1]) for r in own) < 1e-7
            assert all(r.explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-10) for r in own)
    exact = Counter((i, int(((n * x[k] - sums) ** 2).sum())) for k, (i, _, _) in enumerate(rows[:302]))
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == exact
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-8


def test_whitening_of_little(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0], 0)])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0], 0)] * 3 + ODD[:5])).count() == 0
    flat = whitening.whiten(vectors(spark, [(i, [float(i), 2.0], 0) for i in range(5)])).collect()
    assert {r.component for r in flat} == {1} and {r.explained for r in flat} == {1.0}
