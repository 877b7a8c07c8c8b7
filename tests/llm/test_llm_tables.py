"""Each operator on hand-made tables against plain Python: odd rows, empty tables, clashing columns, hot groups."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash

from txnrisk.llm import chat, components, decontaminate, embeddings, licenses, pieces, pii, quality, simhash, tokenfile, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id string, _hits string, label string, score string"


def docs(spark, rows):
    """Documents with columns whose names the operators use themselves; a few partitions."""
    full = [(i, t, "en", "s", len(t or ""), "c", "h", "l", "x") for i, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One two"), (6, "One  two\nthree"), (7, "one two three"),
    (7, "one two three"), (8, "ÀÉ ñ x" * 5), (9, "word " * 30_000), (10, "z" * 50_000), (11, "a▁b \0 <|endoftext|> \U0001F600"),
    (None, "no id at all here"), (12, "one two three"),
]


def plain_fingerprint(text):
    norm = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", norm)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ---------------------------------------------------------------- components and SimHash


def test_components_of_chains_stars_and_loops(spark):
    random.seed(1)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 900)] + [(7, 7), (3, 4), (4, 3), (3, 4)]
    pairs += [(random.randint(1000, 1100), random.randint(1000, 1100)) for _ in range(60)]
    edges = spark.createDataFrame([*pairs, (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    linked = [p for p in pairs if p[0] != p[1]]
    assert got == plain_components(linked, {n for p in linked for n in p})
    assert components.components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("bucket", [256, 2])
def test_simhash_links_all_within_two_bits(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)  # 2: nearly every bucket is cut again
    random.seed(bucket)
    values = {random.getrandbits(64) for _ in range(40)}
    for v in list(values)[:20]:
        values |= {v ^ (1 << random.randrange(64)) for _ in range(8)}
        values |= {v ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64)) for _ in range(8)}
    values = sorted(values | {v ^ 3 for v in list(values)[:5]} | {0, 1, 2, 3, 7})
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)]
    fps = spark.createDataFrame(rows, "rep long, fp long")
    pairs = [tuple(sorted(p)) for p in simhash.links(fps).collect()]
    expected = {(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 2}
    assert set(pairs) == {tuple(sorted(p)) for p in expected}
    assert len(pairs) == len(set(pairs))


def test_simhash_of_odd_rows(spark):
    found = simhash.near_duplicates(docs(spark, ODD)).collect()
    fps = {(i, f"{plain_fingerprint(t):016x}") for i, t in ODD}
    assert sorted(map(str, ((r.doc_id, r.fingerprint) for r in found))) == sorted(map(str, ((i, f"{plain_fingerprint(t):016x}") for i, t in ODD)))
    assert {r.component_id for r in found if r.fingerprint == "0" * 16} == {1}
    assert len(fps) and {r.component_id for r in found if r.doc_id in (7, 12)} == {6}
    kept = simhash.keep_one(docs(spark, ODD))
    assert kept.columns == docs(spark, []).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 4, 5, 6, 8, 9, 10, 11] and ids.count(None) == 1
    assert simhash.near_duplicates(docs(spark, [])).count() == 0 and simhash.keep_one(docs(spark, [])).count() == 0


def test_simhash_query_against_brute_force(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    rows = spark.read.parquet(path).select("doc_id", "text").collect()
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    pairs = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    expected = plain_components(pairs, fps)
    got = simhash.near_duplicates(spark.read.parquet(path)).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{v:016x}", expected[i]) for i, v in fps.items()}


# ---------------------------------------------------------------- token files


@pytest.mark.parametrize("values", [
    [], [0], [1] * 500, [0] * 1000, [2**64 - 1, 5, 2**60 - 1, 2**60], list(range(50257)), [2**k for k in range(64)] * 5,
])
def test_simple8b_round_trip(values):
    v = np.array(values, dtype=np.uint64)
    words, offsets, escapes = tokenfile.pack(v)
    assert (tokenfile.unpack(words, offsets, escapes, len(v)) == v).all()
    payload = tokenfile.segment(np.array([4, 9, 9]), np.array([len(v) // 2, 0, len(v) - len(v) // 2]), v)
    assert (tokenfile.document(payload, 0) == v[: len(v) // 2]).all() and (tokenfile.document(payload, 2) == v[len(v) // 2 :]).all()
    assert len(tokenfile.document(payload, 1)) == 0
    with pytest.raises(ValueError):
        tokenfile.open_segment(payload[:-1] + bytes([payload[-1] ^ 1]) if len(payload) > 60 else b"S8B1" + payload[4:8] + bytes(40))


def test_chunked_encoding_equals_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    encoder = tokenfile.Encoder(path)
    random.seed(3)
    batch = [t or "" for _, t in ODD] + ["", "\n", "a\n\nb", "\n a", "a \n", "x\x01y", "a\x85b \x1cc", "it's we'll\nx's 's", "　x\t y"]
    batch += ["".join(random.choice(" \n\t ab'sé.9 \x01!ll") for _ in range(random.randint(0, 14))) for _ in range(2000)]
    ids, counts = encoder.encode(batch)
    expected = [e.ids for e in plain.encode_batch(batch, add_special_tokens=False)]
    assert counts.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e]


@pytest.mark.parametrize("segment_ids", [1 << 20, 7])
def test_token_files_against_the_library(spark, tmp_path, segment_ids):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    path = str(tmp_path / "tokens")
    tokenfile.write_tokens(docs(spark, ODD), path, "byte_bpe_50k.json", segment_ids=segment_ids)
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tokenfile.read_tokens(spark, path).collect())
    start, expected = 0, []
    for i, t in sorted((r for r in ODD if r[0] is not None), key=lambda r: r[0]):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == sorted(expected)
    tokenfile.write_tokens(docs(spark, []), path, "byte_bpe_50k.json")
    assert tokenfile.read_tokens(spark, path).count() == 0


# ---------------------------------------------------------------- SentencePiece


def test_viterbi_against_the_library_and_round_trips():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1  # the library's own Viterbi, over the same pieces and scores
    for p in model.pieces:
        if p.type == 1:
            p.score = pieces.rank_score(p.score)
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    table = pieces.PieceTable.load(path)
    random.seed(5)
    words = ["".join(random.choice("abcdeghinorstu") for _ in range(random.randint(1, 60))) for _ in range(1500)]
    words += ["the", "  two  spaces", "naïve café", "x" * 300, "Transformation", " lead"]
    ids, counts = table.encode(words)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode(w) for w in words]
    odd = [t or "" for _, t in ODD] + ["▁", "\0▁\0", "中文字符" * 40, " ", "\n\n", "".join(map(chr, range(1, 3000)))]
    ids, counts = table.encode(odd)
    assert table.decode(ids, counts) == odd


def test_pieces_of_odd_rows(spark):
    coded = pieces.encode(docs(spark, ODD), "piece_bpe_32k.model")
    rows = coded.collect()
    assert len(rows) == len(ODD) and all(r.exact and len(r.ids) == r.n_tokens for r in rows)
    assert [r.n_tokens for r in rows if r.doc_id in (1, 2)] == [0, 0]
    assert sorted(map(str, pieces.decode(coded, "piece_bpe_32k.model").collect())) == sorted(f"Row(doc_id={i}, text={(t or '')!r})" for i, t in ODD)
    digests = {(r.doc_id, r.decoded_sha256) for r in pieces.digests(docs(spark, ODD), "piece_bpe_32k.model").collect()}
    assert digests == {(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ODD}
    assert pieces.encode(docs(spark, []), "piece_bpe_32k.model").count() == 0


# ---------------------------------------------------------------- toxicity and quality


def learning_rows():
    random.seed(9)
    vocabulary = ["".join(random.choice("abcdefgh") for _ in range(random.randint(2, 6))) for _ in range(300)]
    rows, labels = [], []
    for i in range(700):
        own = random.choices(vocabulary, k=random.randint(20, 80))
        toxic, bad = i % 7 == 0, i % 3 == 0
        if toxic:
            for _ in range(4):
                own.insert(random.randrange(len(own)), random.choice(["zzmoron", "zzscum"]) + random.choice("xyw"))
        rows.append((i, " ".join(w.upper() + "!!" if bad else w for w in own)))
        labels.append((i, int(not bad), int(toxic), "x"))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int, text string"


def test_toxicity_on_held_out_rows(spark):
    rows, labels = learning_rows()
    table = docs(spark, rows + [(9001, None), (9002, ""), (None, "no id")])
    known = spark.createDataFrame([*labels, (9001, None, None, ""), (None, 1, 1, "")], LABELS)
    model = toxicity.learn(table, known)
    got = {r.doc_id: r for r in toxicity.report(table, model).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items() if i is not None)
    held = [(got[i].predicted, t) for i, _, t, _ in labels if got[i].held_out]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert got[9001].score == got[9002].score < 0.5 and 0 <= min(r.score for r in got.values())
    kept = toxicity.clean(table, model)
    assert kept.columns == table.columns
    assert kept.count() == sum(r.predicted == 0 for r in got.values())
    # Labels of held-out rows must not matter.
    turned = known.withColumn("toxic", (1 - known.toxic)).where("crc32(cast(doc_id as string)) % 5 = 0").unionByName(known.where("crc32(cast(doc_id as string)) % 5 <> 0"))
    again = {r.doc_id: r.score for r in toxicity.report(table, toxicity.learn(table, turned)).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_maximal_segments_by_brute_force():
    random.seed(4)
    for _ in range(300):
        n = random.randint(1, 14)
        scores = [random.choice([-1.5, -1.5, 1.0, 2.0, 2.5]) for _ in range(n)]
        places = [i for i, s in enumerate(scores) if s > 0]
        found = toxicity.segments(places, [scores[i] for i in places], -1.5)
        best = max((sum(scores[a:b]) for a in range(n) for b in range(a + 1, n + 1)), default=0)
        assert max((s for *_, s in found), default=0) == pytest.approx(max(best, 0))
        assert all(s == pytest.approx(sum(scores[a : b + 1])) for a, b, s in found)
        assert all(x[1] < y[0] for x, y in zip(found, found[1:]))
        assert {i for a, b, _ in found for i in range(a, b + 1)} >= set(places)


def test_quality_on_held_out_rows(spark):
    rows, labels = learning_rows()
    table = docs(spark, rows + [(9001, None), (9002, ""), (None, "no id")])
    known = spark.createDataFrame([*labels, (None, 1, 1, "")], LABELS)
    got = {r.doc_id: r for r in quality.report(table, quality.learn(table, known)).collect()}
    held = [(got[i].predicted, q) for i, q, _, _ in labels if got[i].held_out]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert got[9001].score == got[9002].score and all(0 <= r.score <= 1 for r in got.values())


def test_learning_without_rows(spark):
    empty = spark.createDataFrame([], LABELS)
    some = docs(spark, ODD)
    for labels in (empty, spark.createDataFrame([(4, 1, 0, "")], LABELS)):
        assert {r.predicted for r in toxicity.report(some, toxicity.learn(some, labels)).collect()} <= {0, 1}
        assert quality.report(some, quality.learn(some, labels)).count() == len(ODD)
    assert toxicity.report(docs(spark, []), toxicity.Model({})).count() == 0
    assert quality.report(docs(spark, []), quality.Model()).count() == 0


# ---------------------------------------------------------------- embeddings


def test_embedding_links_by_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 16))
    near = np.concatenate([base[:8].repeat(12, axis=0) + 0.08 * rng.standard_normal((96, 16)), base[:1].repeat(700, axis=0) + 0.05 * rng.standard_normal((700, 16))])
    rows = [(i, v.tolist(), "e") for i, v in enumerate([*base, *near, *near[:5], *(3 * near[:3])])]
    n = len(rows)
    vectors = [v for _, v, _ in rows]
    odd = [(n, None), (n + 1, []), (n + 2, [0.0] * 16), (n + 3, [1.0] * 15 + [float("nan")]), (n + 4, [1.0] * 15 + [None]), (n + 5, [float("inf")] * 16), (None, vectors[0]), (n + 6, [1e-200] * 16), (n + 7, [1e200] * 16), (n + 8, [1.0, 2.0])]
    table = spark.createDataFrame(rows + [(i, v, "o") for i, v in odd], "vec_id long, embedding array<double>, class_id string").repartition(4)
    got = {r.vec_id: r for r in embeddings.near_duplicates(table).collect()}
    x = np.array(vectors)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= embeddings.COSINE
    expected = link.sum(axis=1) - 1
    links = np.array([got[i].n_links for i in range(n)])
    assert (links <= expected).all() and links.sum() >= 0.95 * expected.sum()
    parts = plain_components(zip(*np.nonzero(link)), range(n))
    assert sum(got[i].component_id == parts[i] for i in range(n)) >= 0.99 * n
    assert all(got[i].kept == (got[i].component_id == i) for i in range(n))
    for i in (n, n + 1, n + 2, n + 3, n + 4, n + 5, n + 8):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[n + 6].n_links, got[n + 7].n_links, got[n + 7].component_id) == (1, 1, n + 6)
    assert len(got) == n + len(odd)
    assert embeddings.near_duplicates(table.limit(0)).count() == 0


# ---------------------------------------------------------------- personal data


def plain_spans(text):
    found = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(reversed(digits)))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            found.append(("card", m.start(), m.end()))
    found += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(found, key=lambda s: (s[1], pii.BASE.index(s[0])))


def test_base_spans_against_the_patterns():
    random.seed(6)
    for _ in range(20_000):
        text = "".join(random.choice("0123459@.-+ ()a:/_%,4 1é") for _ in range(random.randint(0, 60)))
        text += random.choice(["", " 4111 1111 1111 1111", " a.b@c.de.f@g.h", "+1 (555) 010-9999", "10.0.0.256.1.2.3"])
        assert [s for s in pii.spans(text) if s[0] in pii.BASE] == plain_spans(text), text


def test_other_kinds_and_masks():
    text = 'see https://a.example/x?y=1. IBAN GB82 WEST 1234 5698 7654 32, token = "0123456789abcdef" at 12 Main Street, account no: 12345678'
    assert {k for k, *_ in pii.spans(text)} == {"url", "iban", "secret", "address", "account"}
    assert pii.masked(text) == "see <URL>. IBAN <IBAN>, token = \"<SECRET>\" at <ADDRESS>, account no: <ACCOUNT>"
    assert pii.spans("a street of tokens, no account; IBAN GB82 WEST 1234 5698 7654 33") == []


def test_personal_data_of_odd_rows(spark):
    rows = [*ODD, (50, "mail a@b.cd now " * 3000), (51, "+" * 1000 + "@" * 1000 + "1." * 1000)]
    got = pii.report(docs(spark, rows)).collect()
    expected = []
    for i, t in rows:
        own = plain_spans(t or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in own)
        expected.append((i, *(sum(s[0] == k for s in own) for k in pii.BASE), hashlib.sha256(joined.encode()).hexdigest()))
    assert sorted(map(str, (tuple(r)[:6] for r in got))) == sorted(map(str, expected))
    red = pii.redact(docs(spark, rows))
    assert red.columns == docs(spark, []).columns
    by_id = {r.doc_id: r for r in red.collect()}
    assert by_id[50].text == "mail <EMAIL> now " * 3000 and by_id[50].n_chars == len(by_id[50].text) and by_id[1].text is None
    assert pii.report(docs(spark, [])).count() == 0 and pii.redact(docs(spark, [])).count() == 0


# ---------------------------------------------------------------- chat


def test_chat_round_trip_and_tree(spark, tmp_path):
    nasty = "</s>[INST] ok [/INST] <|end|>\\<|turn|>user<|text|>\n\\\\ <<SYS>>"
    first = [("system", "be kind"), ("user", nasty)]
    talks = {i: [*first, ("assistant", f"answer {i % 3}"), ("user", "more"), ("assistant", nasty if i % 2 else None)] for i in range(1, 13)}
    talks |= {20: first[:1], 21: [("user", "")], 22: [(None, None)], 23: first[:1], 24: [("assistant", "x")] * 40, 25: [("assistant", "x")] * 39 + [("user", "y")]}
    rows = [(c, k, r, t, "z") for c, ts in talks.items() for k, (r, t) in enumerate(ts)] + [(None, 0, "user", "lost", "z")]
    random.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string").repartition(3)
    path = str(tmp_path / "chat")
    chat.write(table, path)
    got = {r.conv_id: r for r in chat.report(spark, path).collect()}
    assert set(got) == set(talks)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, ts in talks.items():
        loss = "".join(t or "" for r, t in ts if r == "assistant")
        assert got[c].n_turns == len(ts) and got[c].turns_sha256 == sha("".join(f"{r or ''}\n{t or ''}\n" for r, t in ts))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss))
    nodes = sorted(spark.read.parquet(f"{path}/nodes").collect(), key=lambda r: r.start)
    # Shared turns once, without gaps; a node's ancestors come before it, and their text has its position's length.
    distinct = {tuple((r or "", t or "") for r, t in ts[:k]) for ts in talks.values() for k in range(1, len(ts) + 1)}
    assert len(nodes) == len(distinct)
    assert [n.start for n in nodes[1:]] == [n.finish for n in nodes[:-1]] and nodes[0].start == 0
    text = "".join(n.shown for n in nodes)
    for n in nodes:
        assert sum(a.finish - a.start for a in n.attention) == n.position and all(a.finish <= n.start for a in n.attention)
        whole = "".join(text[a.start : a.finish] for a in n.attention) + text[n.start : n.finish]
        assert whole.count(chat.TURN) == whole.count(chat.END)
    # Depth first: the subtree of a node follows it at once.
    for k, n in enumerate(nodes):
        inside = [any(a.start <= n.start and n.finish <= a.finish for a in m.attention) for m in nodes[k + 1 :]]
        assert inside == sorted(inside, reverse=True)
    chat.write(table.limit(0), path)
    assert chat.report(spark, path).count() == 0


# ---------------------------------------------------------------- licenses


def test_licenses_found_on_odd_and_noisy_texts(spark):
    random.seed(8)
    noise = lambda n: " ".join("".join(random.choice("abcdeé") for _ in range(5)) for _ in range(n))
    long = [n for n, t in licenses.TEMPLATES.items() if len(t.split()) > 25]
    rows, expected = list(ODD), {}
    for k in range(60):
        name = random.choice(sorted(licenses.TEMPLATES))
        words = licenses.TEMPLATES[name].split()
        if name in long and k % 2:
            words[len(words) // 2] = "changed"
        rows.append((1000 + k, f"{noise(random.randint(0, 90))}\n{' '.join(words).upper() if k % 3 else ' '.join(words)}\n{noise(random.randint(0, 40))}"))
        expected[1000 + k] = name
    rows.append((2000, noise(3000) + " licensed under the apache house, version two"))
    got = licenses.scan(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, name in expected.items():
        assert name in by_id[i].licenses.split(","), (i, name)
    assert all(r.n_licenses == 0 and r.licenses == "" for r in got if r.doc_id not in expected)
    assert licenses.scan(docs(spark, [])).count() == 0
    assert licenses.scan(docs(spark, ODD), {}).count() == len(ODD)
    with pytest.raises(ValueError):
        licenses.scan(docs(spark, ODD), {"short": "too few words"})
    read = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = licenses.scan(read)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Exchange", "Join"))


# ---------------------------------------------------------------- decontamination


def plain_hits(items, text):
    words = decontaminate.words(text)
    hit, names = set(), set()
    for name, item in items:
        own = decontaminate.words(item)
        size = min(13, len(own))
        windows = {tuple(own[j : j + size]) for j in range(len(own) - size + 1)} if own else set()
        for j in range(len(words) - size + 1 if own else 0):
            if tuple(words[j : j + size]) in windows:
                hit |= set(range(j, j + size))
                names |= {str(name)} if name is not None else set()
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize("most", [100_000, 40])
def test_decontamination_by_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate.automata, "__defaults__", (most,))
    monkeypatch.setattr(decontaminate.scan, "__defaults__", (most,))
    random.seed(most)
    for letters in ("ab", "abcdefghijklmnop"):
        text = lambda n: " ".join(random.choice(letters) for _ in range(n))
        items = [(k, text(random.choice([0, 1, 5, 12, 13, 14, 30]) if letters != "ab" else random.choice([13, 14, 30]))) for k in range(8)]
        items += [(items[3][0], items[3][1]), (None, text(20)), (99, None), (100, "...")]
        rows = list(ODD)
        for k in range(40):
            item = random.choice(items)[1] or ""
            rows.append((500 + k, f"{text(random.randint(0, 60))} ZZ {item} zz {text(5)}"))
        bench = spark.createDataFrame([(i, t, "q") for i, t in items], "item_id long, text string, _items string")
        got = decontaminate.report(docs(spark, rows), bench).collect()
        expected = []
        for i, t in rows:
            n, hit, names = plain_hits(items, t)
            expected.append((i, n, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hit > 0 and 20 * hit >= n))
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
        kept = decontaminate.clean(docs(spark, rows), bench)
        assert kept.columns == docs(spark, []).columns and kept.count() == sum(not e[-1] for e in expected)
    none = bench.limit(0)
    assert all(r.n_hit == 0 and not r.contaminated for r in decontaminate.report(docs(spark, ODD), none).collect())
    assert decontaminate.report(docs(spark, []), bench).count() == 0


# ---------------------------------------------------------------- registered queries and the pipeline


def test_queries_with_twins(spark):
    import compare

    from txnrisk.llm import queries

    sf = "/root/testdata/sf0.001"
    con, every = compare.connect(sf), queries.all_queries()
    assert {n: compare.differences(every[n](spark, sf), con, sql) for n, sql in queries.all_twins().items()} == dict.fromkeys(queries.all_twins())


def test_pipeline_stages_by_plain_versions(spark):
    import corpus_pipeline
    from test_similar import plain_kept

    sf = "/root/testdata/sf0.001"
    before = spark.read.parquet(f"{sf}/documents.parquet")
    columns, stages = before.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash near-dedup", "benchmark decontamination", "pii", "sentencepiece"]
    rows = {r.doc_id: r for r in before.collect()}
    model = toxicity.learn(before, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = {i: r for i, r in rows.items() if model.score(r.text) < 0.5}
    after = stages["toxicity"](spark, before, sf)
    assert after.columns == columns and {r.doc_id: r for r in after.collect()} == rows
    kept = plain_kept({i: r.text for i, r in rows.items()})
    after = stages["simhash near-dedup"](spark, after, sf)
    rows = {i: r for i, r in rows.items() if i in kept}
    assert after.columns == columns and {r.doc_id: r for r in after.collect()} == rows
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    hit = {i: plain_hits(items, r.text) for i, r in rows.items()}
    rows = {i: r for i, r in rows.items() if not (hit[i][1] and 20 * hit[i][1] >= hit[i][0])}
    after = stages["benchmark decontamination"](spark, after, sf)
    assert after.columns == columns and {r.doc_id: r for r in after.collect()} == rows
    after = stages["pii"](spark, after, sf)
    got = {r.doc_id: r for r in after.collect()}
    assert after.columns == columns and set(got) == set(rows)
    assert all(got[i].text == pii.masked(r.text) and got[i].n_chars == len(got[i].text) and not plain_spans(got[i].text) for i, r in rows.items())
    coded = stages["sentencepiece"](spark, after, sf).collect()
    assert {r.doc_id for r in coded} == set(rows) and all(r.exact for r in coded)
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()} == set(rows)


def test_pipeline_stages_on_odd_rows(spark):
    import corpus_pipeline

    sf, odd = "/root/testdata/sf0.001", docs(spark, ODD)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, odd, sf)
        assert found.count() > 0 and (name == "sentencepiece" or found.columns == odd.columns)
        assert stage(spark, odd.limit(0), sf).count() == 0
