"""Benchmark decontamination: a generalised suffix automaton of the test items, streamed over documents.

A window is ``WINDOW`` consecutive words of an item, or all words of a shorter item. The automaton
follows the longest match that ends at each document word; a match of ``WINDOW`` words or more ends a
window there, and short items are found on the suffix links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import free_names, map_arrow, saved

WINDOW = 13
#: A document is contaminated if one word in so many, or more, is hit.
SHARE = 20
#: Words in one automaton (some 100 MB in a task at most). More items are cut into more automata, one after the other.
AUTOMATON_WORDS = 100_000
#: Upper to lower case; other ASCII but digits and lower case becomes a space.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of digits, letters a-z and anything outside ASCII."""
    return (text or "").encode("utf-8", "replace").translate(_WORD_BYTES).split()


class Automaton:
    """Generalised suffix automaton over words; transitions, suffix links and lengths by state."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]]):
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [0], [0]
        items = [(i, w) for i, w in items if w]
        self.least = min([min(len(w), WINDOW) for _, w in items], default=WINDOW)
        coded = [(i, [self.vocabulary.setdefault(x, len(self.vocabulary)) for x in w]) for i, w in items]
        for _, ids in coded:
            last = 0
            for t in ids:
                last = self._extend(last, t)
        #: Items that hold a window of the state; short items that end in the state, with their lengths.
        self.items: dict[int, set] = {}
        self.short: dict[int, list] = {}
        for item, ids in coded:
            state = 0
            for t in ids:
                state = self.step[state][t]
                v = state
                while self.length[v] >= WINDOW and item not in (own := self.items.setdefault(v, set())):
                    own.add(item)
                    v = self.link[v]
            if len(ids) < WINDOW:
                while self.length[self.link[state]] >= len(ids):
                    state = self.link[state]
                self.short.setdefault(state, []).append((len(ids), item))
        #: Next state with short items, the state itself or on its suffix links; 0: none.
        self.ends = [0] * len(self.step)
        for v in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            self.ends[v] = v if v in self.short else self.ends[self.link[v]]

    def _new(self, step: dict[int, int], length: int, link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.step) - 1

    def _split(self, p: int, q: int, t: int) -> int:
        """A copy of ``q`` for the strings of ``p`` and one word ``t``."""
        copy = self._new(dict(self.step[q]), self.length[p] + 1, self.link[q])
        self.link[q] = copy
        at = p
        while self.step[at].get(t) == q:
            self.step[at][t] = copy
            if not at:
                break
            at = self.link[at]
        return copy

    def _extend(self, last: int, t: int) -> int:
        q = self.step[last].get(t)
        if q is not None:  # another item had this prefix
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, t)
        new, p = self._new({}, self.length[last] + 1, 0), last
        while t not in self.step[p]:
            self.step[p][t] = new
            if not p:
                return new
            p = self.link[p]
        q = self.step[p][t]
        self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, t)
        return new

    def scan(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Intervals of hit words (end exclusive, may overlap), and the items with a window there."""
        n = len(found)
        ids = np.fromiter(map(self.vocabulary.get, found, repeat(-1)), dtype=np.int64, count=n)
        # A window lies in a run of known words; shorter runs are passed over.
        gaps = np.concatenate(([-1], np.flatnonzero(ids < 0), [n]))
        hits: list[tuple[int, int]] = []
        items: set = set()
        for g in np.flatnonzero(np.diff(gaps) > self.least).tolist():
            low = int(gaps[g]) + 1
            self._stream(ids[low : int(gaps[g + 1])].tolist(), low, hits, items)
        return hits, items

    def _stream(self, ids: list[int], low: int, hits: list, items: set) -> None:
        step, link, length, ends = self.step, self.link, self.length, self.ends
        state = matched = 0
        for at, t in enumerate(ids, low + 1):
            while state and t not in step[state]:
                state = link[state]
                matched = length[state]
            if t in step[state]:
                state = step[state][t]
                matched += 1
            if matched >= WINDOW:
                v = state
                while length[link[v]] >= WINDOW:
                    v = link[v]
                hits.append((at - WINDOW, at))
                items |= self.items[v]
            v = ends[state]
            while v:
                for n, item in self.short[v]:
                    if n <= matched:
                        hits.append((at - n, at))
                        items.add(item)
                v = ends[link[v]]


def _merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(hits):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _pass(automaton: Automaton):
    """Scan ``text``; add to what earlier automata found, in the last three columns."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, rest = batch.schema.names, batch.columns[:-3]
            n_words, hits, items = [], [], []
            for text, before, held in zip(batch.column("text").to_pylist(), batch.column(-2).to_pylist(), batch.column(-1).to_pylist()):
                own = words(text)
                spans, found = automaton.scan(own)
                spans += zip(before[::2], before[1::2])
                n_words.append(len(own))
                hits.append([x for span in _merged(spans) for x in span])
                items.append(sorted(set(held) | {str(i) for i in found if i is not None}))
            new = [pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*rest, *new], names)

    return scan


def automata(benchmark: DataFrame, most: int = AUTOMATON_WORDS) -> Iterator[Automaton]:
    """Automata of at most about ``most`` words each (one item is never cut); at least one, if empty.

    Only the items of one automaton are on the driver at a time. Null and wordless texts have no window.
    """
    size = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, -(-size // (2 * most)))  # a word takes two characters at least, with its gap
    rows = benchmark.where("text is not null").select(F.col("item_id").cast("string").alias("i"), "text")
    for k in range(shards):
        own = rows if shards == 1 else rows.where(F.pmod(F.xxhash64("i", "text"), F.lit(shards)) == k)
        yield Automaton([(r.i, words(r.text)) for r in own.collect()])


def scan(docs: DataFrame, benchmark: DataFrame, most: int = AUTOMATON_WORDS) -> DataFrame:
    """``docs`` (any columns, ``text`` among them) and three more at the end, whatever their names: the
    number of words, starts and ends of the hit runs of words, and the items."""
    names = free_names(docs, "_words", "_hits", "_items")
    docs = docs.select("*", F.lit(0).cast("long").alias(names[0]), F.array().cast("array<int>").alias(names[1]), F.array().cast("array<string>").alias(names[2]))
    for k, automaton in enumerate(automata(benchmark, most)):
        docs = map_arrow(saved(docs, "scanned") if k else docs, _pass(automaton), docs.schema)
    return docs


def _judged(found: DataFrame) -> tuple[str, Column, str, Column]:
    """Names of the number of words and of the items, with the number of hit words and the verdict."""
    n_words, hits, items = found.columns[-3:]
    pairs = F.sequence(F.lit(0), F.size(hits) - 2, F.lit(2))
    n_hit = F.aggregate(pairs, F.lit(0).cast("long"), lambda n, k: n + F.get(hits, k + 1) - F.get(hits, k))
    hit = F.when(F.size(hits) > 0, n_hit).otherwise(F.lit(0).cast("long"))
    return n_words, hit, items, (hit > 0) & (hit * SHARE >= F.col(n_words))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null text has no words; repeated rows stay; items that share an id count once; an item without
    an id makes hits but isn't counted. Without items nothing is hit. Other columns aren't read.
    """
    found = scan(docs.select("doc_id", "text"), benchmark)
    n_words, hit, items, bad = _judged(found)
    return found.select(
        "doc_id", F.col(n_words).alias("n_words"), hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), bad.alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that aren't contaminated, unchanged, with all their columns."""
    found = scan(docs, benchmark)
    return found.where(~_judged(found)[-1]).select(docs.columns)
