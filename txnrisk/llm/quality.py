"""Quality classifier: supervised subword embeddings.

A document is the average of the learned vectors of its words, of the words' character n-grams and of
pairs of neighbours, all hashed to a fixed table; a softmax layer over the average gives the class. Both
are trained with stochastic gradient descent in numpy on the driver, on a bounded sample of labelled
rows whose features Spark tasks extract. To score, each feature's vector is reduced to what it adds to
the log-odds, so that tasks hold one number per feature and a document is a sum over its words.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import held_out, map_arrow, texts
from txnrisk.llm.toxicity import labelled

BUCKETS = 1 << 17
DIMENSIONS = 16
GRAMS = (2, 3)
STEPS, BATCH, RATE = 800, 32, 0.5
#: Labelled rows that the classifier is fitted on, the first by hash of doc_id; every other row is only scored.
TRAINING_ROWS = 5_000
THRESHOLD = 0.3
SEED = 7
#: Texts that a task scores at a time.
TEXTS = 512
#: Different words whose sums a task remembers.
REMEMBER = 400_000
#: Pairs count as much as so many n-grams of each word.
PAIR_WEIGHT = 8
#: A word like the one before it, and one unlike it: what a pair of neighbours says whatever the words.
AGAIN, CHANGE = zlib.crc32(b"pair again") % BUCKETS, zlib.crc32(b"pair change") % BUCKETS


_ODD = np.uint64(0x9E3779B97F4A7C15)


def _bucket(values: np.ndarray) -> np.ndarray:
    """Multiplicative hash to the table's buckets."""
    with np.errstate(over="ignore"):
        return ((values * _ODD) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def word_features(words: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashed features of many words at once: each word's own, then its n-grams with marks for both ends.

    Returns the words' buckets; by n, the bucket of the n-gram at each byte (-1 where it would cross the
    word's end); where each word's bytes begin; and how many features each word has.
    """
    sizes = np.array([len(w) + 2 for w in words])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    codes = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    place = np.arange(len(codes)) - np.repeat(starts, sizes)
    left = np.repeat(sizes, sizes) - place
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(sizes.max()), 1_000_003, np.uint64))
        own = _bucket(np.add.reduceat(codes * powers[place], starts))
        grams = []
        for n in GRAMS:
            value = np.full(len(codes), n, np.uint64)
            for k in range(n):
                value[: len(codes) - k] = value[: len(codes) - k] * np.uint64(257) + codes[k:]
            grams.append(np.where(left >= n, _bucket(value), -1))
    return own, grams, starts, 1 + sum(np.maximum(sizes - n + 1, 0) for n in GRAMS)


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and the share each has. Empty texts have none."""
    tokens = text.encode("utf-8", "replace").split()
    if not tokens:
        return np.zeros(0, np.int64), np.zeros(0)
    counts = Counter(tokens)
    own, grams, starts, _ = word_features(list(counts))
    times = np.array(list(counts.values()))
    each = np.repeat(times, np.diff(np.append(starts, len(grams[0]))))
    again = sum(a == b for a, b in zip(tokens, tokens[1:]))
    pairs = np.array([again, len(tokens) - 1 - again]) * PAIR_WEIGHT
    ids = np.concatenate([own, *(g[g >= 0] for g in grams), [AGAIN, CHANGE]])
    n = np.concatenate([times, *(each[g >= 0] for g in grams), pairs])
    used, place = np.unique(ids, return_inverse=True)
    total = np.bincount(place, weights=n)
    return used, total / total.sum()


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    bias: float = 0.0
    _known: dict[bytes, int] = field(default_factory=dict)
    _sums: np.ndarray = field(default_factory=lambda: np.zeros((0, 2)))

    def _learn(self, words: list[bytes]) -> None:
        own, grams, starts, parts = word_features(words)
        sums = self.weights[own].astype(np.float64)
        for g in grams:
            sums += np.add.reduceat(np.where(g >= 0, self.weights[g], 0).astype(np.float64), starts)
        at = len(self._known)
        if at + len(words) > len(self._sums):
            self._sums = np.concatenate((self._sums[:at], np.zeros((at + 2 * len(words), 2))))
        self._sums[at : at + len(words)] = np.column_stack((sums, parts))
        self._known.update(zip(words, range(at, at + len(words))))

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probabilities of label 1; an empty text has that of the bias alone."""
        if len(self._known) > REMEMBER:
            self._known.clear()
        tokens: list[bytes] = []
        sizes = np.zeros(len(texts), dtype=np.int64)
        for k, text in enumerate(texts):
            own = text.encode("utf-8", "replace").split()
            tokens += own
            sizes[k] = len(own)
        at = np.fromiter(map(self._known.get, tokens, repeat(-1)), dtype=np.int64, count=len(tokens))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            self._learn(list(dict.fromkeys(tokens[i] for i in missing)))
            at[missing] = [self._known[tokens[i]] for i in missing]
        owner = np.repeat(np.arange(len(texts)), sizes)
        n = len(texts)
        total, parts = (np.bincount(owner, weights=self._sums[at, k], minlength=n) for k in range(2))
        inside = owner[1:] == owner[:-1]
        again = np.bincount(owner[1:][inside & (at[1:] == at[:-1])], minlength=n)
        change = np.bincount(owner[1:][inside & (at[1:] != at[:-1])], minlength=n)
        total = total + PAIR_WEIGHT * (again * float(self.weights[AGAIN]) + change * float(self.weights[CHANGE]))
        logit = self.bias + total / np.maximum(1.0, parts + PAIR_WEIGHT * (again + change))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """Train vectors and softmax layer on (features, shares, label); without both labels, on the counts alone."""
    labels = np.array([y for *_, y in rows], dtype=np.int64)
    if not len(rows) or labels.min() == labels.max():
        n1 = int(labels.sum())
        return Model(bias=math.log((n1 + 0.5) / (len(rows) - n1 + 0.5)))
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((DIMENSIONS, 2), np.float32)
    bias = np.zeros(2, np.float32)
    squares = np.full(BUCKETS, 1e-6, np.float32)  # of the gradients so far, by feature: sets its rate
    order = np.concatenate([rng.permutation(len(rows)) for _ in range(-(-STEPS * BATCH // len(rows)))])
    for step in range(STEPS):
        chosen = order[step * BATCH : (step + 1) * BATCH]
        rate = RATE * (1 - step / STEPS)
        ids = np.concatenate([rows[i][0] for i in chosen])
        share = np.concatenate([rows[i][1] for i in chosen]).astype(np.float32)
        owner = np.repeat(np.arange(len(chosen)), [len(rows[i][0]) for i in chosen])
        average = np.stack([np.bincount(owner, weights=share * vectors[ids, d], minlength=len(chosen)) for d in range(DIMENSIONS)], axis=1).astype(np.float32)
        logits = average @ layer + bias
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(chosen)), labels[chosen]] -= 1
        back = p @ layer.T
        layer -= rate * average.T @ p / len(chosen)
        bias -= rate * p.mean(axis=0)
        # Gradients of the same feature meet before the step.
        sort = np.argsort(ids, kind="stable")
        first = np.flatnonzero(np.diff(ids[sort], prepend=-1))
        grads = np.add.reduceat(share[sort, None] * back[owner[sort]], first, axis=0)
        own = ids[sort][first]
        squares[own] += (grads**2).mean(axis=1)
        vectors[own] -= rate * grads / np.sqrt(squares[own])[:, None] * 0.1
    weights = vectors @ (layer[:, 1] - layer[:, 0])
    return Model(weights.astype(np.float32), float(bias[1] - bias[0]))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [document_features(t) for t in batch.column(0).to_pylist()]
        ids, shares = pa.array([i for i, _ in found], pa.list_(pa.int32())), pa.array([s for _, s in found], pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([ids, shares, batch.column(1)], ["ids", "shares", "label"])


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on at most ``TRAINING_ROWS`` documents with a quality label that aren't held out."""
    train = labelled(docs, labels, "quality")
    first = train.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_ROWS)
    chosen = train.join(F.broadcast(first.withColumnRenamed("doc_id", "_own")), F.col("doc_id") == F.col("_own"))
    found = map_arrow(chosen.select("text", "label"), _features, "ids array<int>, shares array<float>, label int").toArrow()
    columns = [found.column(k).combine_chunks() for k in range(3)]
    rows = [(i.values.to_numpy(), s.values.to_numpy(), y) for i, s, y in zip(columns[0], columns[1], columns[2].to_pylist())]
    rows.sort(key=lambda r: (len(r[0]), r[2], zlib.crc32(r[0].tobytes())))  # the same order however tasks ended
    return fit(rows)


def report(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.

    A null text is empty; repeated rows and a null doc_id (not held out) stay. Other columns aren't read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                scores = pa.array(model.scores(part.column(1).to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(0), scores], ["doc_id", "score"])

    scored = map_arrow(texts(docs), work, "doc_id long, score double")
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))
