"""The pipeline's near-duplicate stage against brute-force Jaccard similarity of five-word shingles."""

import random
import re

import pytest
from test_llm_tables import docs, plain_components

from txnrisk.llm import simhash, similar


def plain_shingles(text):
    norm = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", norm)
    return frozenset(" ".join(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([" ".join(words)] if words else [])


def alike(x, y):
    both = len(x & y)
    return x == y or 5 * both >= 4 * (len(x) + len(y) - both)


def plain_kept(texts):
    sets = {i: plain_shingles(t) for i, t in texts.items()}
    of_size = sorted(sets, key=lambda i: len(sets[i]))
    pairs = []
    for k, a in enumerate(of_size):
        for b in of_size[k + 1 :]:
            if 5 * len(sets[a]) < 4 * len(sets[b]):
                break
            if alike(sets[a], sets[b]):
                pairs.append((a, b))
    return {i for i, c in plain_components(pairs, sets).items() if i == c}


def test_recall_of_the_retrieval():
    """Of all pairs of different sets at the threshold or above, those that meet and are near; sf0.1 by plain Python."""
    import numpy as np
    import pyarrow.parquet as pq

    sets = {}
    for text in pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"].to_pylist():
        s = similar.shingles(text)
        if len(s):
            sets.setdefault(similar.class_id(s), s)
    sets, first = list(sets.values()), {}
    for k, s in enumerate(sets):
        for h in s[: len(s) // 5 + 1].tolist():  # alike sets share one of their least hashes
            first.setdefault(h, []).append(k)
    pairs = {(a, b) for own in first.values() for n, b in enumerate(own) for a in own[:n]}
    size = [len(s) for s in sets]
    pairs = [(a, b) for a, b in pairs if 4 * max(size[a], size[b]) <= 5 * min(size[a], size[b])]
    pairs = [(a, b) for a, b in pairs if 9 * len(np.intersect1d(sets[a], sets[b], assume_unique=True)) >= 4 * (size[a] + size[b])]
    bits, count = similar.plan(len(sets))
    cut, found = similar.segments(bits, count), 0
    for a, b in pairs:
        x, y = (np.unpackbits(np.frombuffer(similar.fingerprint(sets[k]), np.uint8), bitorder="little") for k in (a, b))
        found += ((x != y)[cut].sum(axis=1) <= 1).any() and (x != y)[128:].sum() <= similar.NEAR
    assert len(pairs) > 40 and found >= 0.95 * len(pairs)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_near_dedup_stage_against_brute_force(spark, sf):
    import corpus_pipeline

    before = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in before.collect()}
    after = dict(corpus_pipeline.STAGES)["simhash near-dedup"](spark, before, sf)
    assert after.columns == before.columns
    assert sorted(r.doc_id for r in after.collect()) == sorted(plain_kept(texts))


def templates(groups, copies, rate):
    """Templates with a common part: near in the fingerprint, mostly below the threshold, some copies above it."""
    random.seed(4)
    common = [f"c{i}" for i in range(150)]
    rows = {}
    for g in range(groups):
        own = common + [f"g{g}w{i}" for i in range(27)]
        for k in range(copies):
            rows[len(rows) + 1] = " ".join(w if random.random() > rate * k else f"x{len(rows)}" for w in own)
    return rows


@pytest.mark.parametrize("limits", [{}, {"HASHES": 1000, "CLASSES": 20}, {"SAMPLE": 2, "HOT": 2, "LEADERS": 2, "REST": 5}])
def test_similar_groups_by_brute_force(spark, monkeypatch, limits):
    """As given; with families cut into cells; with nearly every shared key a hot one."""
    for name, value in limits.items():
        monkeypatch.setattr(similar, name, value)
    rows = templates(12, 6, 0.004)
    got = [r.doc_id for r in similar.keep_one(docs(spark, list(rows.items()))).collect()]
    assert sorted(got) == sorted(plain_kept(rows)) and 1 < len(got) < len(rows)


def test_pairs_below_the_threshold_stay_in_their_tasks(spark):
    """300 near texts without a link: what leaves the buckets and the cells grows with the texts, not with their pairs."""
    rows = {i: " ".join([f"c{k}" for k in range(150)] + [f"w{i}x{k}" for k in range(30)]) for i in range(300)}
    sets = {i: similar.shingles(t) for i, t in rows.items()}
    table = [(similar.class_id(s), i, len(s), similar.fingerprint(s)) for i, s in sets.items()]
    classes = spark.createDataFrame(table, "class_id long, rep long, n int, fp binary")
    assert 0 < similar.families(classes).count() < 40 * len(rows)
    assert similar.links(classes, docs(spark, list(rows.items()))).count() == 0


def test_shared_hashes_by_brute_force():
    rng = random.Random(2)
    sets = [similar.np.array(sorted(rng.sample(range(400), rng.randint(1, 120))), "<u8") for _ in range(70)]
    found = similar.shared(sets)
    assert all(found[j, i] == len(set(sets[i].tolist()) & set(sets[j].tolist())) for i in range(70) for j in range(i))


def test_segments_use_keyed_bits_only_and_meet_as_planned():
    for n in (10, 1 << 24, 1 << 34):
        bits, count = similar.plan(n)
        cut = similar.segments(bits, count)
        assert cut.shape == (count, bits) and cut.max() < similar.BITS // 2
        assert 1 - (1 - similar.meeting(bits)) ** count >= similar.RECALL


def test_similar_keeps_a_row_of_each_class_of_a_doc_id(spark):
    rows = [(5, "a text that stands only here"), (5, "one more that has a copy"), (3, "one more that has a copy"), (9, None), (4, ""), (None, "x")]
    got = similar.keep_one(docs(spark, rows)).collect()
    assert sorted(str((r.doc_id, r.text)) for r in got) == sorted(map(str, [(5, rows[0][1]), (3, rows[2][1]), (4, ""), (None, "x")]))


def test_simhash_keeps_a_text_whose_doc_id_also_has_a_copy(spark):
    rows = [(5, "unique text of this row"), (5, "a copy"), (3, "a copy"), (9, None), (4, ""), (None, "x")]
    got = simhash.keep_one(docs(spark, rows)).collect()
    assert sorted(str((r.doc_id, r.text)) for r in got) == sorted(map(str, [(5, rows[0][1]), (3, "a copy"), (4, ""), (None, "x")]))
