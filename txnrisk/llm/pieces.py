"""SentencePiece encoding and decoding with a batched numpy Viterbi.

The piece table (surfaces, scores, byte pieces) comes from a SentencePiece model file; the segmentation
of a text is the one with the largest sum of scores, as in that library's unigram models. The file of a
merge (BPE) model has ranks for scores; they are turned to log-probabilities. Words of equal
length advance together: hashes of all their substrings of one length are looked up in the sorted hashes
of the pieces at once, a vectorised maximum per end keeps the best score and a backpointer, and the
backpointers are followed for all words at once. Equal sums go to the longest last piece. Characters
outside the table become byte pieces, so that decoding gives back every text exactly.

A word begins at a space (written as U+2581 in the table) after something else. No piece crosses that
boundary, so words are independent; a task remembers the ids of words it has seen.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from txnrisk.llm.common import map_arrow, sha256_hex, texts, unsigned_crc32

SPACE = "▁"
#: Stands for a space mark that the text itself has; no text has a lone surrogate.
MARK = "\udc81"
#: Different words whose ids a task remembers.
REMEMBER = 500_000
#: Texts that a task cuts into words at a time; their words and ids are what takes memory.
TEXTS = 256
#: Longer words are first cut where no piece crosses.
LONG = 48
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.int64(-1)
_UNKNOWN = 10


def rank_score(score: float) -> float:
    """A log-probability by Zipf's law for a merge model's score, which is minus the piece's rank.

    In steps of 1/1024, so that sums over a word are exact in single precision too.
    """
    return -round(1024 * math.log(2 - score)) / 1024


class PieceTable:
    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int]):
        """``byte_ids``: the ids of the 256 byte pieces. Ids whose piece is empty are never used for text."""
        self.byte_ids = np.array(byte_ids, dtype=np.int64)
        self.scores = np.array(scores, dtype=np.float64)
        usable = [i for i, p in enumerate(pieces) if p]
        crossing = [p for p in pieces if SPACE in p.lstrip(SPACE) or "\n" in p and len(p) > 1]
        if crossing:
            raise ValueError(f"a piece goes on over the bounds of words: {crossing[0]!r}")
        self.longest = max(len(pieces[i]) for i in usable)
        #: Below every piece, as the library scores a character without one.
        self.unknown = float(min(s for s, p in zip(scores, pieces) if p)) - _UNKNOWN
        codes = np.zeros((len(pieces), self.longest), dtype=np.uint32)
        self.powers = np.ones(self.longest + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(1, self.longest + 1):
                self.powers[k] = self.powers[k - 1] * _BASE
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for i in usable:
            codes[i, : len(pieces[i])] = [ord(c) for c in pieces[i]]
        self.codes = codes
        for length in sorted({len(pieces[i]) for i in usable}):
            ids = np.array([i for i in usable if len(pieces[i]) == length], dtype=np.int64)
            keys = self._prefix(codes[ids, :length])[:, length]
            order = np.argsort(keys)
            if len(np.unique(keys)) < len(keys):
                raise ValueError("two pieces share a hash")
            near = np.zeros(1 << 16, dtype=bool)
            near[(keys >> np.uint64(48)).astype(np.int64)] = True
            self.by_length[length] = (keys[order], ids[order], near)
        self.lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        surfaces = [p.replace(SPACE, " ").encode() for p in pieces]
        for b, i in enumerate(byte_ids):
            surfaces[i] = bytes([b])
        self.surface_size = np.array([len(s) for s in surfaces], dtype=np.int64)
        self.surface_at = np.concatenate(([0], np.cumsum(self.surface_size)[:-1]))
        self.surface = np.frombuffer(b"".join(surfaces), dtype=np.uint8)
        self.place: dict[str, int] = {}
        self.reset()

    @classmethod
    def load(cls, path: str) -> PieceTable:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(not model.is_byte(i) for i in byte_ids):
            raise ValueError("the table has no byte pieces, so it can't give back every text")
        special = set(byte_ids) | {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        scores = [model.get_score(i) for i in range(n)]
        if all(scores[i] == int(scores[i]) for i in range(n) if i not in special):
            scores = [rank_score(s) for s in scores]
        return cls(["" if i in special else model.id_to_piece(i) for i in range(n)], scores, byte_ids)

    def reset(self) -> None:
        self.place.clear()
        self.starts, self.ids, self.known, self.used = np.zeros(1, np.int64), np.zeros(1 << 16, np.int32), 0, 0

    @staticmethod
    def _prefix(codes: np.ndarray) -> np.ndarray:
        """Polynomial hashes of the prefixes of each row."""
        out = np.zeros((len(codes), codes.shape[1] + 1), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(codes.shape[1]):
                out[:, k + 1] = out[:, k] * _BASE + (codes[:, k].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        return out

    def _matches(self, codes: np.ndarray) -> dict[int, np.ndarray]:
        """By length: for each word and start, the id of the piece there, or -1."""
        n = codes.shape[1]
        prefix, found = self._prefix(codes), {}
        for length, (keys, ids, near) in self.by_length.items():
            if length > n:
                continue
            with np.errstate(over="ignore"):
                own = prefix[:, length:] - prefix[:, : n - length + 1] * self.powers[length]
            rows, starts = np.nonzero(near[own >> np.uint64(48)])
            at = np.minimum(np.searchsorted(keys, own[rows, starts]), len(keys) - 1)
            hit = keys[at] == own[rows, starts]
            rows, starts, at = rows[hit], starts[hit], at[hit]
            same = np.ones(len(rows), dtype=bool)
            for k in range(length):  # equal hashes are compared as text
                same &= codes[rows, starts + k] == self.codes[ids[at], k]
            if same.any():
                found[length] = np.full((len(codes), n - length + 1), _NONE)
                found[length][rows[same], starts[same]] = ids[at[same]]
        return found

    def _viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of words of equal length: their ids one after the other (-1: a character without piece), and how many each has."""
        w, n = codes.shape
        matches = self._matches(codes)
        order = sorted(matches, reverse=True)
        best = np.full((w, n + 1), -np.inf)
        best[:, 0] = 0
        back = np.full((w, n + 1), _NONE)
        for end in range(1, n + 1):
            for length in order:
                if length > end:
                    continue
                ids = matches[length][:, end - length]
                score = np.where(ids >= 0, best[:, end - length] + self.scores[ids], -np.inf)
                better = score > best[:, end]
                best[better, end] = score[better]
                back[better, end] = ids[better]
            alone = matches[1][:, end - 1] < 0 if 1 in matches else np.ones(w, dtype=bool)
            score = np.where(alone, best[:, end - 1] + self.unknown, -np.inf)
            better = score > best[:, end]
            best[better, end] = score[better]
            back[better, end] = _NONE
        rows, at, kept_rows, kept_ids = np.arange(w), np.full(w, n), [], []
        while len(rows):
            ids = back[rows, at]
            kept_rows.append(rows)
            kept_ids.append(np.where(ids < 0, -1 - codes[rows, at - 1].astype(np.int64), ids))
            at = at - np.where(ids < 0, 1, self.lengths[ids])
            rows, at = rows[at > 0], at[at > 0]
        rows, ids = np.concatenate(kept_rows)[::-1], np.concatenate(kept_ids)[::-1]
        order = np.argsort(rows, kind="stable")
        return ids[order], np.bincount(rows, minlength=w)

    def _cut(self, codes: np.ndarray) -> list[np.ndarray]:
        """A long word in parts, cut where no piece of the table crosses: its segmentation is theirs."""
        n = len(codes)
        cover = np.zeros(n + 1, dtype=np.int64)
        for length, ids in self._matches(codes[None, :]).items():
            starts = np.flatnonzero(ids[0] >= 0)
            np.add.at(cover, starts + 1, 1)
            np.add.at(cover, starts + length, -1)
        return np.split(codes, np.flatnonzero(np.cumsum(cover)[1:n] == 0) + 1)

    def _learn(self, words: list[str]) -> None:
        parts: list[np.ndarray] = []
        owner: list[int] = []
        for k, word in enumerate(words):
            codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), dtype="<u4")
            own = [codes] if len(codes) <= LONG else self._cut(codes)
            parts += own
            owner += [k] * len(own)
        sizes = np.array([len(p) for p in parts])
        ids: list[np.ndarray] = [np.zeros(0, np.int64)] * len(parts)
        for n in np.unique(sizes).tolist():
            of = np.flatnonzero(sizes == n)
            if not n:
                continue
            found, counts = self._viterbi(np.stack([parts[i] for i in of.tolist()]))
            for i, own in zip(of.tolist(), np.split(found, np.cumsum(counts)[:-1])):
                ids[i] = own
        flat = np.concatenate(ids)
        counts = np.bincount(np.array(owner), weights=[len(i) for i in ids], minlength=len(words)).astype(np.int64)
        strange = np.flatnonzero(flat < 0)
        if len(strange):  # characters to their bytes
            as_bytes = {c: self.byte_ids[list((SPACE if chr(-1 - c) == MARK else chr(-1 - c)).encode())] for c in np.unique(flat[strange]).tolist()}
            grown = [flat[i : i + 1] if flat[i] >= 0 else as_bytes[int(flat[i])] for i in range(len(flat))]
            word_of = np.repeat(np.arange(len(words)), counts)
            counts = np.bincount(word_of, weights=[len(g) for g in grown], minlength=len(words)).astype(np.int64)
            flat = np.concatenate(grown)
        if self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids[: self.used], np.zeros(self.used + 2 * len(flat), np.int32)))
        self.ids[self.used : self.used + len(flat)] = flat
        self.starts = np.concatenate((self.starts[: self.known + 1], self.used + np.cumsum(counts)))
        self.place.update(zip(words, range(self.known, self.known + len(words))))
        self.known += len(words)
        self.used += len(flat)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has. An empty text has none."""
        if len(self.place) > REMEMBER:
            self.reset()
        words: list[str] = []
        counts = np.zeros(len(texts), dtype=np.int64)
        for k, text in enumerate(texts):
            if not text:
                continue
            own = _split(text)
            words += own
            counts[k] = len(own)
        if not words:
            return np.zeros(0, np.int32), counts
        at = np.fromiter(map(self.place.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            self._learn(list(dict.fromkeys(words[i] for i in missing)))
            at[missing] = [self.place[words[i]] for i in missing]
        starts = self.starts[at]
        sizes = self.starts[at + 1] - starts
        ends = np.cumsum(sizes)
        source = np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])
        upto = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        return self.ids[source], np.diff(upto)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts again: surfaces of the pieces, less the first space, which the encoder adds."""
        sizes = self.surface_size[ids]
        ends = np.cumsum(sizes)
        source = np.repeat(self.surface_at[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        data = self.surface[source].tobytes()
        upto = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))].tolist()
        return [data[a + 1 : b].decode("utf-8", "replace") for a, b in zip(upto[:-1], upto[1:])]


def _split(text: str) -> list[str]:
    """Words, each with the space marks before it; line feeds alone. A mark in the text itself stays a character of its own."""
    if "\0" not in text and SPACE not in text:
        words = [w for w in (SPACE + text.replace(" ", "\0" + SPACE).replace("\n", "\0\n\0")).split("\0") if w]
    else:
        words, own = [], SPACE
        for c in text:
            if c == " ":
                words.append(own)
                own = SPACE
            elif c in "\n\0" or c == SPACE:
                words += [own, MARK if c == SPACE else c]
                own = ""
            else:
                own += c
        words = [w for w in [*words, own] if w]
    if "  " not in text and text[0] != " ":
        return words
    joined = [words[0]]
    for w in words[1:]:
        if w[0] == SPACE and not joined[-1].strip(SPACE):
            joined[-1] += w
        else:
            joined.append(w)
    return joined


_TABLES: dict[str, PieceTable] = {}


def _table(name: str) -> PieceTable:
    if name not in _TABLES:
        path = name
        if not os.path.isabs(name):
            import public_tokenizers

            path = public_tokenizers.path(name)
        _TABLES[name] = PieceTable.load(path)
    return _TABLES[name]


def _coded(tokenizer: str, finish):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                own = part.column(1).to_pylist()
                ids, counts = table.encode(own)
                yield finish(table, part.column(0), own, ids, counts)

    return work


def _lists(table: PieceTable, keys: pa.Array, own: list[str], ids: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
    exact = [a == b for a, b in zip(table.decode(ids, counts), own)]
    lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
    return pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64()), lists, pa.array(exact)], ["doc_id", "n_tokens", "ids", "exact"])


def _digests(table: PieceTable, keys: pa.Array, own: list[str], ids: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    upto = np.concatenate(([0], np.cumsum(counts))).tolist()
    crc = [unsigned_crc32(ids[a:b]) for a, b in zip(upto[:-1], upto[1:])]
    sha = [sha256_hex(t) for t in table.decode(ids, counts)]
    return pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64()), pa.array(crc, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_tokens", "ids_crc32", "decoded_sha256"])


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids (array), exact (whether decoding them gave the text again).

    A null text is empty and has no ids; repeated rows and a null doc_id stay; other columns aren't
    read. ``tokenizer`` is a path or a name of the public tokenizer files.
    """
    return map_arrow(texts(docs), _coded(tokenizer, _lists), "doc_id long, n_tokens long, ids array<int>, exact boolean")


def decode(coded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text) of rows with doc_id and ids; null ids are none, and no ids give an empty text.

    An id that the table doesn't have, or a null among the ids, stops the run: its text isn't known. Repeated
    rows and a null doc_id stay; other columns aren't read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(tokenizer)
        for batch in batches:
            lists = [x or [] for x in batch.column(1).to_pylist()]
            flat = [i for x in lists for i in x]
            if None in flat or flat and not 0 <= min(flat) <= max(flat) < len(table.surface_size):
                raise ValueError("an id that the table of pieces doesn't have")
            ids = np.array(flat, dtype=np.int64)
            found = table.decode(ids, np.array([len(x) for x in lists], dtype=np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["doc_id", "text"])

    return map_arrow(coded.select("doc_id", "ids"), work, "doc_id long, text string")


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Per row: doc_id, n_tokens, CRC-32 of the ids, SHA-256 of the text that decoding them gives.

    A null text is empty, and an empty one has no ids and the digest of nothing; long texts are taken as a whole.
    Repeated rows and a null doc_id stay; other columns aren't read.
    """
    return map_arrow(texts(docs), _coded(tokenizer, _digests), "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string")
