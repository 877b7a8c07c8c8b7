"""Token ids in Simple-8b words: 64-bit words that hold as many ids as fit, in independent blocks.

A word is a selector of 4 bits and 60 bits of data; the selector says how many values of how many bits
the data holds. A value of over 60 bits is an escape: selector 15, whose data is a place in a table of
whole values at the end. Words never cross a block of ``BLOCK`` ids, and the offset of each block's
first word is kept, so that any document can be read without the ids before it, and all words of a
segment are decoded at once with numpy.

A segment holds whole documents in ascending order:

    magic "S8B1", CRC-32 of the rest; then the counts of documents, ids, blocks, words and escapes (u8);
    document ids (i8), ids per document (u8), first word of each block (u8), words (u8), escapes (u8)

All numbers are little-endian. Spark writes the segments as rows of Parquet files, so that its commit
protocol holds for them: a task that is lost leaves no half-written file.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnrisk.llm.common import map_arrow, texts, unsigned_crc32

#: (values, bits) of a word by selector 0 to 14; 15 is the escape.
PACKINGS = (
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30),
    (1, 60), (1, 60),
)
ESCAPE = 15
BLOCK = 128
MAGIC = b"S8B1"
HEADER = struct.Struct("<4sI5Q")
#: Ids in a segment, but for a longer last document.
SEGMENT_IDS = 1 << 20
#: Different chunks of text whose ids a task remembers.
REMEMBER = 600_000
END_ID = 2
SEGMENTS = "part int, seq int, first_doc long, n_docs long, n_ids long, payload binary"


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, first word of each block, and escaped values of unsigned ``values``."""
    values = np.asarray(values, dtype=np.uint64)
    n = len(values)
    blocks = -(-n // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    pad = PACKINGS[0][0]
    # Bits of each value, by block; what lies past the end needs none, so that a last word may run over.
    bits = np.zeros((blocks, BLOCK + pad), dtype=np.uint8)
    need = np.zeros(blocks * BLOCK, dtype=np.uint8)
    big = values >> np.uint64(60) > 0
    small = np.where(big, np.uint64(0), values)
    need[:n] = np.frexp(small.astype(np.float64))[1]  # a value near 2**60 may round up to 61 bits and escape
    need[:n][big] = 64
    bits[:, :BLOCK] = need.reshape(blocks, BLOCK)
    selector = np.full((blocks, BLOCK), ESCAPE, dtype=np.uint8)
    widest, size = bits[:, :], 1
    known = {1: bits}
    for count, width in reversed(PACKINGS[:14]):
        while size < count:  # the largest need of ``count`` values from each place on
            step = max(k for k in known if k <= count - size)
            grown = widest.copy()
            grown[:, : -size] = np.maximum(widest[:, :-size], known[step][:, size:])
            widest, size = grown, size + step
            known[size] = widest
        selector[widest[:, :BLOCK] <= width] = PACKINGS.index((count, width))
    taken = np.array([c for c, _ in PACKINGS] + [1], dtype=np.int64)
    at, row, places, counts = np.zeros(blocks, np.int64), np.arange(blocks), [], np.zeros(blocks, np.int64)
    last = np.full(blocks, BLOCK, dtype=np.int64)
    last[-1] = n - (blocks - 1) * BLOCK
    while len(row):  # every block goes on by one word
        places.append(row * BLOCK + at)
        counts[row] += 1
        at = at + taken[selector[row, at]]
        more = at < last[row]
        row, at = row[more], at[more]
    place = np.sort(np.concatenate(places))
    chosen = selector.reshape(-1)[place]
    words = chosen.astype(np.uint64) << np.uint64(60)
    padded = np.zeros(blocks * BLOCK + pad, dtype=np.uint64)
    padded[:n] = values
    inside = BLOCK - place % BLOCK
    for s, (count, width) in enumerate(PACKINGS[:14]):
        of = np.flatnonzero(chosen == s)
        for k in range(count if len(of) else 0):
            # Past the end of its block a word holds zeros.
            own = of[inside[of] > k]
            words[own] |= padded[place[own] + k] << np.uint64(k * width)
    escaped = np.flatnonzero(chosen == ESCAPE)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64)
    offsets = np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.uint64)
    return words, offsets, values[place[escaped]]


def unpack(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of all blocks, or of consecutive blocks whose first is the first of ``words``."""
    out = np.zeros(n, dtype=np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    taken = np.array([c for c, _ in PACKINGS] + [1], dtype=np.int64)[selector]
    ends = np.cumsum(taken)
    starts = ends - taken
    first = (offsets - offsets[0]).astype(np.int64)
    block = np.searchsorted(first, np.arange(len(words)), side="right") - 1
    starts = starts - starts[first][block] + block * BLOCK
    limit = np.minimum((block + 1) * BLOCK, n)
    for s, (count, width) in enumerate(PACKINGS[:14]):
        of = np.flatnonzero(selector == s)
        mask = np.uint64((1 << width) - 1)
        for k in range(count if len(of) else 0):
            own = of[starts[of] + k < limit[of]]
            out[starts[own] + k] = words[own] >> np.uint64(k * width) & mask
    of = np.flatnonzero(selector == ESCAPE)
    out[starts[of]] = escapes[(words[of] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out


def segment(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    words, offsets, escapes = pack(ids)
    parts = (doc_ids.astype("<i8"), lengths.astype("<u8"), offsets.astype("<u8"), words.astype("<u8"), escapes.astype("<u8"))
    body = b"".join(p.tobytes() for p in parts)
    counts = struct.pack("<5Q", len(doc_ids), len(ids), len(offsets), len(words), len(escapes))
    return MAGIC + struct.pack("<I", zlib.crc32(counts + body)) + counts + body


def open_segment(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, ids per document, block offsets, words and escapes; a damaged segment is an error."""
    magic, crc, docs, ids, blocks, words, escapes = HEADER.unpack_from(payload)
    if magic != MAGIC or zlib.crc32(memoryview(payload)[8:]) != crc:
        raise ValueError("not a whole segment")
    at, out = HEADER.size, []
    for kind, count in (("<i8", docs), ("<u8", docs), ("<u8", blocks), ("<u8", words), ("<u8", escapes)):
        out.append(np.frombuffer(payload, kind, count, at))
        at += 8 * count
    if int(out[1].sum()) != ids:
        raise ValueError("lengths and ids differ")
    return tuple(out)


def document(payload: bytes, k: int) -> np.ndarray:
    """Ids of the segment's k-th document; only the blocks that hold it are decoded."""
    _, lengths, offsets, words, escapes = open_segment(payload)
    start, n = int(lengths[:k].sum()), int(lengths[k])
    if not n:
        return np.zeros(0, np.uint64)
    low, high = start // BLOCK, -(-(start + n) // BLOCK)
    stop = int(offsets[high]) if high < len(offsets) else len(words)
    held = min(int(lengths.sum()), high * BLOCK) - low * BLOCK
    values = unpack(words[int(offsets[low]) : stop], offsets[low:high], escapes, held)
    return values[start - low * BLOCK :][:n]


#: A chunk whose ids don't hang on what stands around it.
PLAIN = re.compile(r" ?\S+")
#: What makes one of several chunks, with line feeds between them, no such chunk.
NOT_PLAIN = re.compile(r"[^\S \n]| [ \n]| \Z")
#: Marks that are a piece of their own, and one id, where they end a chunk after a letter or digit.
MARKS = frozenset(".,;:!?")


class Encoder:
    """Ids of texts by the tokenizers library; what lies between two sure cuts is encoded once and remembered.

    The byte-level pre-tokenizer starts a new piece at every space that follows and precedes something
    other than white space, and around every such line feed. Merges never cross pieces, so the ids of
    the chunks between these places, one after the other, are those of the text. A text with other
    white space, two in a row, or a special token of the tokenizer is encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line_feed = int(self._ids("\n")[0])
        self.marks = {c: int(self._ids(c)[0]) for c in MARKS}
        self.place: dict[str, int] = {}
        self.reset()

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def reset(self) -> None:
        self.place = {"\0": 0, "": 1}
        self.starts, self.ids, self.known, self.used = np.array([0, 1, 1]), np.zeros(1 << 16, np.uint32), 2, 1
        self.ids[0] = self.line_feed
        self.uses = np.zeros(2, np.int64)

    def forget(self) -> None:
        """Keep the chunks that came more than once, at most half of ``REMEMBER``: most others never come again."""
        order = np.argsort(-self.uses[2 : self.known], kind="stable")[: REMEMBER // 2] + 2
        kept = np.sort(order[self.uses[order] > 1])
        names = list(self.place)  # in order of their numbers
        sizes = self.starts[kept + 1] - self.starts[kept]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.starts[kept] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        uses = self.uses[kept] // 2  # what was frequent long ago makes room in time
        self.reset()
        self._add([names[k] for k in kept.tolist()], ids, sizes)
        self.uses[2:] = uses

    def _learn(self, new: list[str]) -> None:
        """Remember new chunks; of a word and the mark behind it, the word is encoded once for all marks."""
        # Latin only: what is a letter elsewhere depends on the version of Unicode.
        marked = [c for c in new if c[-1] in MARKS and c[-2:-1].isalnum() and c[-2] < "\u0250"]
        words = dict.fromkeys(new)
        for c in marked:
            del words[c]
        stems = [c[:-1] for c in marked]
        words.update(dict.fromkeys(c for c in stems if c not in self.place))
        if words:
            self._encode_new(list(words))
        if not marked:
            return
        at = np.fromiter(map(self.place.__getitem__, stems), dtype=np.int64, count=len(stems))
        sizes = self.starts[at + 1] - self.starts[at] + 1
        ends = np.cumsum(sizes)
        source = np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(ends[-1])
        ids = self.ids[np.minimum(source, self.used - 1)]
        ids[ends - 1] = [self.marks[c[-1]] for c in marked]
        self._add(marked, ids, sizes)

    def _encode_new(self, new: list[str]) -> None:
        """Encode chunks, many in one text with a line feed between them, where pieces are cut for sure."""
        lines = self.tokenizer.encode_batch_fast(["\n".join(new[k : k + 64]) for k in range(0, len(new), 64)], add_special_tokens=False)
        found = [np.array(e.ids, dtype=np.uint32) for e in lines]
        ends = np.cumsum([len(f) + 1 for f in found]) - 1
        joined = np.full(ends[-1] + 1, self.line_feed, dtype=np.uint32)
        inner = np.ones(len(joined), dtype=bool)
        inner[ends] = False
        joined[inner] = np.concatenate(found)
        counts = np.diff(np.flatnonzero(joined == self.line_feed), prepend=-1) - 1
        self._add(new, joined[joined != self.line_feed], counts)

    def _add(self, new: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids[: self.used], np.zeros(self.used + 2 * len(ids), np.uint32)))
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts = np.concatenate((self.starts[: self.known + 1], self.used + np.cumsum(counts)))
        self.place.update(zip(new, range(self.known, self.known + len(new))))
        self.known += len(new)
        self.used += len(ids)
        self.uses = np.concatenate((self.uses, np.zeros(len(new), np.int64)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        if len(self.place) > REMEMBER:
            self.forget()
        cut: list[str] = []
        counts = np.zeros(len(texts), dtype=np.int64)
        odd: dict[int, np.ndarray] = {}
        for k, text in enumerate(texts):
            if "\n\n" in text or "\0" in text or "\1" in text or any(s in text for s in self.special):
                odd[k] = self._ids(text)
            elif text:
                cut.append(text)
                counts[k] = 1 + text.count(" ") + 2 * text.count("\n")
        # Chunks are told apart by Arrow, so that only different ones are looked up.
        joined = ["\1".join(cut).replace(" ", "\1 ").replace("\n", "\1\0\1")] if cut else []
        chunks = pc.list_flatten(pc.split_pattern(pa.array(joined, pa.large_string()), "\1")).dictionary_encode()
        index, names = chunks.indices.to_numpy(), chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter(map(self.place.get, names, repeat(-1)), dtype=np.int64, count=len(names))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            named = [names[i] for i in missing.tolist()]
            new = named
            if NOT_PLAIN.search("\n".join(new)):
                plain = PLAIN.fullmatch
                odd_ones = [i for i, c in zip(missing.tolist(), named) if plain(c) is None]
                new = [c for c in named if plain(c)]
                upto = np.cumsum(counts)
                for k in np.unique(np.searchsorted(upto, np.flatnonzero(np.isin(index, odd_ones)), side="right")).tolist():
                    odd[k] = self._ids(texts[k])
            if new:
                self._learn(new)
            at[missing] = np.fromiter(map(self.place.get, named, repeat(1)), dtype=np.int64, count=len(named))
        self.uses[at] += np.bincount(index, minlength=len(names))
        starts = self.starts[at]
        sizes = (self.starts[at + 1] - starts)[index]
        starts = starts[index]
        ends = np.cumsum(sizes)
        source = np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        upto = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        ids, sizes = self.ids[source], np.diff(upto)
        if odd:
            pieces = [odd.get(k, ids[upto[k] : upto[k + 1]]) for k in range(len(texts))]
            ids, sizes = np.concatenate(pieces), np.array([len(p) for p in pieces])
        return ids, sizes


_ENCODERS: dict[str, Encoder] = {}


def _encoder(name: str) -> Encoder:
    if name not in _ENCODERS:
        path = name
        if not os.path.isabs(name):
            import public_tokenizers

            path = public_tokenizers.path(name)
        _ENCODERS[name] = Encoder(path)
    return _ENCODERS[name]


def _writer(tokenizer: str, end_id: int, segment_ids: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, encoder = TaskContext.get().partitionId(), 0, _encoder(tokenizer)
        docs: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, held
            keys, lengths = np.concatenate([d for d, _ in docs]), np.concatenate([n for _, n in docs])
            payload = segment(keys, lengths, np.concatenate(ids))
            row = {"part": [part], "seq": [seq], "first_doc": [int(keys[0])], "n_docs": [len(keys)], "n_ids": [held], "payload": [payload]}
            seq, held = seq + 1, 0
            docs.clear()
            ids.clear()
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("first_doc", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())]))

        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            own = batch.column(1).to_pylist()
            for at in range(0, len(own), 256):
                found, counts = encoder.encode(own[at : at + 256])
                ended = np.full(len(found) + len(counts), end_id, dtype=np.uint32)
                inner = np.ones(len(ended), dtype=bool)
                inner[np.cumsum(counts + 1) - 1] = False
                ended[inner] = found
                docs.append((keys[at : at + 256], counts + 1))
                ids.append(ended)
                held += len(ended)
                if held >= segment_ids:
                    yield flush()
        if docs:
            yield flush()

    return encode


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode every text and write segments in ascending order of doc_id below ``path``.

    A null or empty text is the end id alone; a row without a doc_id has no place in the order and isn't
    written; rows that share a doc_id follow each other in order of text. ``tokenizer`` is a path or a
    name of the public tokenizer files.
    """
    ordered = texts(docs).where("doc_id is not null").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    map_arrow(ordered, _writer(tokenizer, end_id, segment_ids), SEGMENTS).write.mode("overwrite").parquet(path)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, seq, payload in zip(*(batch.column(k).to_pylist() for k in range(3))):
            doc_ids, lengths, offsets, words, escapes = open_segment(payload)
            ids = unpack(words, offsets, escapes, int(lengths.sum()))
            ends = np.cumsum(lengths.astype(np.int64))
            starts = ends - lengths.astype(np.int64)
            crc = [unsigned_crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            n = len(doc_ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, seq, np.int32)), pa.array(doc_ids), pa.array(starts), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())],
                ["part", "seq", "doc_id", "inner", "n_tokens", "ids_crc32"],
            )


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, seq, before): ids in all segments before each one. Payloads aren't read.

    Sums run inside a part, and over one row per part: as many rows as the job that wrote had tasks.
    """
    heads = spark.read.schema(SEGMENTS).parquet(path).select("part", "seq", "first_doc", "n_ids")
    totals = heads.groupBy("part").agg(F.sum("n_ids").alias("n"), F.min("first_doc").alias("first"))
    over = Window.orderBy("first", "part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select("part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("_before"))
    inner = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    own = heads.withColumn("_own", F.coalesce(F.sum("n_ids").over(inner), F.lit(0)))
    return own.join(parts, "part").select("part", "seq", (F.col("_before") + F.col("_own")).alias("before"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, decoded from the written segments."""
    rows = map_arrow(spark.read.schema(SEGMENTS).parquet(path).select("part", "seq", "payload"), _reader, "part int, seq int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    found = rows.join(segment_starts(spark, path), ["part", "seq"])
    return found.select("doc_id", (F.col("before") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
