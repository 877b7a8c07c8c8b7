"""Toxic passages: maximum-scoring segments of token log-odds.

Tokens and the beginnings of tokens are counted in toxic and in clean training documents. Log-odds with
a Dirichlet prior, less one and a half standard errors, decide which enter the lexicon and with which score; any
other token has the log-odds of being outside the lexicon, a little below zero. As scores are log
likelihood ratios, the maximal segments of a text (all of them, in one linear scan) follow an
extreme-value law with rate 1, and a segment of score S in n tokens is expected K n exp(-S) times by
chance. The evidence of a document's significant segments is summed up (without one, its best segment
counts by its chance), and a logistic curve, fitted on training documents, turns the sum to a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import held_out, in_slices, map_arrow, saved, texts
from txnrisk.llm.decontaminate import words
from txnrisk.storage import planned_bytes

#: Bytes of a token's beginnings that are features beside the token itself.
PREFIXES = (4, 5, 6)
#: Dirichlet prior: weight of the pooled share of a feature, and what every feature has besides.
PRIOR_SHARE, PRIOR_EACH = 1000.0, 0.5
ERRORS = 1.5
LEAST_COUNT, LEAST_LOG_ODDS = 3, 2.5
#: Entries of the lexicon, the surest first: the size of the model, which each task holds.
LEXICON = 50_000
#: Training rows whose scores fit the curve: of one fold in five, the first by hash of doc_id. The lexicon takes
#: all training rows; the curve is fitted with a lexicon that has not seen its fold.
CALIBRATION_ROWS = 40_000
CURVE_FOLD = 1
#: A passage is significant if at most so many as good are expected by chance.
SIGNIFICANT = 0.05
THRESHOLD = 0.5
#: Labels are broadcast up to this planned size; beyond, documents are shuffled to them.
LABEL_BYTES = 8 << 20
#: Different words whose scores a task remembers.
REMEMBER = 500_000


def segments(places: list[int], scores: list[float], other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last token, score), in linear time.

    Tokens at ``places`` have positive ``scores``, all others have ``other``, which is negative. Each step
    adds a token; segments on a stack join while that makes a better one.
    """
    stack: list[tuple[int, int, float, float]] = []  # first, last, total before, total after
    total, before = 0.0, -1
    for at, score in zip(places, scores):
        total += other * (at - before - 1)
        first, low, high = at, total, total + score
        total, before = high, at
        while True:
            k = len(stack) - 1
            while k >= 0 and stack[k][2] >= low:
                k -= 1
            if k < 0 or stack[k][3] >= high:
                break
            first, low = stack[k][0], stack[k][2]
            del stack[k:]
        stack.append((first, at, low, high))
    return [(a, b, high - low) for a, b, low, high in stack]


@dataclass
class Model:
    lexicon: dict[bytes, float]
    other: float = -0.01
    k: float = 1.0
    curve: tuple[float, float] = (0.0, 1.0)
    _known: dict[bytes, float] = field(default_factory=dict)

    def token(self, word: bytes) -> float:
        own = [self.lexicon[f] for f in features(word) if f in self.lexicon]
        return max(own, default=0.0)

    def passages(self, text: str | None) -> tuple[list[tuple[int, int, float]], int, int]:
        """Maximal segments of the text's tokens, how many tokens it has, and how many the lexicon has of them."""
        tokens = words(text)
        if len(self._known) > REMEMBER:
            self._known.clear()
        found = np.fromiter(map(self._known.get, tokens, repeat(-1.0)), dtype=np.float64, count=len(tokens))
        for i in np.flatnonzero(found < 0).tolist():
            found[i] = self._known[tokens[i]] = self.token(tokens[i])
        places = np.flatnonzero(found > 0)
        return segments(places.tolist(), found[places].tolist(), self.other), len(tokens), len(places)

    def _expected(self, text: str | None) -> list[tuple[int, int, float, float]]:
        found, n, _ = self.passages(text)
        return [(a, b, s, self.k * n * math.exp(-s)) for a, b, s in found]

    def significant(self, text: str | None) -> list[tuple[int, int, float, float]]:
        """Toxic passages: first and last token, score, and how many as good are expected by chance."""
        return [p for p in self._expected(text) if p[3] <= SIGNIFICANT]

    def evidence(self, text: str | None) -> float:
        """Against chance: minus the log of what is expected of each significant passage; without one, of the best one's chance."""
        found = self._expected(text)
        if not found:
            return 0.0
        least = min(e for *_, e in found)
        if least > SIGNIFICANT:
            return -math.log(-math.expm1(-least)) if least < 700 else 0.0
        return sum(-math.log(max(e, 1e-300)) for *_, e in found if e <= SIGNIFICANT)

    def score(self, text: str | None) -> float:
        a, b = self.curve
        return 1 / (1 + math.exp(-min(max(a + b * math.log1p(self.evidence(text)), -30), 30)))


def features(word: bytes) -> list[bytes]:
    """The token, and its beginnings marked as such."""
    return [word, *(word[:n] + b"*" for n in PREFIXES if len(word) >= n)]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of features in toxic and in clean documents, and in those of the curve's fold alone."""
    for batch in batches:
        tokens = [Counter() for _ in range(4)]
        for text, kind in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            tokens[kind].update(words(text))
        out = [Counter({b"": own.total()}) for own in tokens]
        for of, to in zip(tokens, out):
            for word, n in of.items():
                for f in features(word):
                    to[f] += n
        keys = list(set().union(*out))
        counts = [pa.array([own[k] for k in keys], pa.int64()) for own in out]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *counts], ["feature", "c", "t", "c_curve", "t_curve"])


def _lexicon(summed: DataFrame, t: str, c: str, t_all: int, c_all: int) -> dict[bytes, float]:
    if not t_all or not c_all:
        return {}
    prior = f"({PRIOR_SHARE} * (t + c) / {t_all + c_all} + {PRIOR_EACH})"
    odds = f"ln((t + {prior}) / ({t_all} - t + {PRIOR_SHARE})) - ln((c + {prior}) / ({c_all} - c + {PRIOR_SHARE}))"
    sure = f"{odds} - {ERRORS} * sqrt(1 / (t + {prior}) + 1 / (c + {prior}))"
    counts = summed.select("feature", F.expr(t).alias("t"), F.expr(c).alias("c"))
    kept = counts.where(f"length(feature) > 0 and t >= {LEAST_COUNT}").select("feature", F.expr(sure).alias("score"))
    kept = kept.where(F.col("score") >= LEAST_LOG_ODDS).orderBy(F.desc("score"), "feature").limit(LEXICON)
    return {bytes(r.feature): r.score for r in kept.collect()}


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, text, label as 0 or 1) of the training rows; labels of other values or none are left out."""
    own = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    own = own.where(~held_out("_id")).groupBy("_id").agg(F.max("label").alias("label"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = F.broadcast(own) if planned_bytes(labels) <= LABEL_BYTES else own
    return rows.join(own, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label")


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one feature by Newton steps, with a little ridge."""
    a = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        ridge = np.array([1e-3, 1e-3])
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge), a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit the model on documents with a label that aren't held out.

    Without toxic or clean training rows nothing is known: the lexicon is empty, and every score is the
    share of toxic rows (0.5 without any).
    """
    train = labelled(docs, labels, "toxic")
    in_curve = F.crc32(F.col("doc_id").cast("string")) % 5 == CURVE_FOLD
    kinds = train.select("text", (F.col("label") + 2 * in_curve.cast("int")).alias("kind"))
    counted = map_arrow(kinds, _counts, "feature binary, c long, t long, c_curve long, t_curve long")
    sums = {k: F.sum(k) for k in ("c", "t", "c_curve", "t_curve")}
    summed = counted.groupBy("feature").agg(*(v.alias(k) for k, v in sums.items()))
    summed = saved(summed.where(f"t + t_curve >= {LEAST_COUNT} or length(feature) = 0"), "token-counts")
    whole = summed.where(F.length("feature") == 0).first() or {"c": 0, "t": 0, "c_curve": 0, "t_curve": 0}
    model = Model(_lexicon(summed, "t", "c", whole["t"], whole["c"]))
    first = train.where(in_curve).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION_ROWS)
    chosen = train.join(F.broadcast(first.select(F.col("doc_id").alias("_own")).distinct()), F.col("doc_id") == F.col("_own"))
    chosen = saved(chosen.select("text", "label"), "calibration")
    rows = map_arrow(chosen, _best(model), "label int, n long, best double, inside long").toPandas()
    toxic = rows.label.to_numpy() == 1
    if not len(rows) or toxic.all() or not toxic.any():
        model.curve = (float(np.log((toxic.sum() + 0.5) / ((~toxic).sum() + 0.5))), 0.0)
    else:
        # Log-odds of a token outside the lexicon; then chance's constant K, the likeliest for clean documents.
        share = [(rows.inside[of].sum() + 0.5) / (rows.n[of].sum() + 1) for of in (toxic, ~toxic)]
        model.other = min(-1e-4, math.log1p(-share[0]) - math.log1p(-share[1]))
        again = map_arrow(chosen, _best(model), "label int, n long, best double, inside long").toPandas()
        clean = again[(again.label == 0) & (again.n > 0)]
        model.k = max(1e-6, min(1.0, len(clean) / float((clean.n * np.exp(-clean.best)).sum()))) if len(clean) else 1.0
        fit = map_arrow(chosen, _evidence(model), "label int, evidence double").toPandas()
        model.curve = _curve(np.log1p(fit.evidence.to_numpy()), fit.label.to_numpy())
    return Model(_lexicon(summed, "t + t_curve", "c + c_curve", whole["t"] + whole["t_curve"], whole["c"] + whole["c_curve"]), model.other, model.k, model.curve)


def _best(model: Model):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.passages(t) for t in batch.column(0).to_pylist()]
            best = [max((s for *_, s in own), default=0.0) for own, _, _ in found]
            columns = [batch.column(1), pa.array([n for _, n, _ in found], pa.int64()), pa.array(best, pa.float64()), pa.array([k for *_, k in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["label", "n", "best", "inside"])

    return work


def _evidence(model: Model):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([model.evidence(t) for t in batch.column(0).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(1), found], ["label", "evidence"])

    return work


def report(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, and the significant passages as first and last token with score.

    A null text is empty; an empty text has the score of a text without significant passage. Repeated rows
    and a null doc_id (not held out) stay. Other columns aren't read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(1).to_pylist()
            spans = [",".join(f"{a}:{b}:{s:.3f}" for a, b, s, _ in model.significant(t)) for t in own]
            scores = pa.array([model.score(t) for t in own], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores, pa.array(spans, pa.string())], ["doc_id", "score", "passages"])

    scored = map_arrow(texts(docs), work, "doc_id long, score double, passages string")
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"), "passages")


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with all their columns.

    A null or empty text has the score of a text without a significant passage and stays with it; a long text is
    judged as a whole. Each row is judged by its text alone, so repeated rows stay or go together.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            keep = pa.array([model.score(t) < THRESHOLD for t in batch.column("text").to_pylist()], pa.bool_())
            yield batch.filter(keep)

    return map_arrow(docs, work, docs.schema)
