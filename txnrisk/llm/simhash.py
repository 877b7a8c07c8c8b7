"""SimHash near-duplicates: deletion-variant signatures, equality joins, exact check.

A fingerprint of 64 bits is cut into two halves. If two fingerprints differ in at most two bits, one
of the halves differs in at most one, so both share that half with one bit position wiped. Every
fingerprint is indexed under its 64 wiped halves; equal keys meet in a join, and the join condition
checks the whole distance. A pair meets under several keys and is taken at one of them only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.common import chosen_rows, map_arrow, saved, texts
from txnrisk.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
BITS = 64
#: Buckets with more fingerprints than this are cut again, by the bits their key leaves open.
BUCKET = 256


def fingerprint(text: str) -> int:
    """Unsigned 64-bit SimHash: a bit is set if it is set in over half of the shingles' hashes.

    Text without words has fingerprint 0; with fewer than three words, they are one shingle.
    """
    import xxhash

    words = text.encode("utf-8", "replace").lower().split()  # bytes: only A-Z change, only ASCII space cuts
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= SHINGLE_WORDS:
        shingles = [whole]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: 1 - SHINGLE_WORDS].tolist()
        shingles = [whole[s:e] for s, e in zip(starts, ends[SHINGLE_WORDS - 1 :].tolist())]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        block = hashes[at : at + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _signed(text: str | None) -> int:
    value = fingerprint(text or "")
    return value - (1 << 64) if value >> 63 else value


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for every row; fp holds the 64 bits in a signed long."""
    return map_arrow(texts(docs), _fingerprints, "doc_id long, fp long")


def _variants(rows: DataFrame, width: int, tag: str) -> DataFrame:
    """A row for each of two segments of ``width`` bits, from the bit ``_open`` on, and each bit wiped in it."""
    mask = (1 << width) - 1
    places = F.explode(F.array([F.struct(F.lit(s).alias("s"), F.lit(w).alias("w")) for s in range(2) for w in range(width)]))
    cut = rows.withColumn("_v", places).withColumns({f"s{tag}": F.col("_v.s"), f"w{tag}": F.col("_v.w")}).drop("_v")
    bits = F.expr(f"(shiftrightunsigned(fp, _open + s{tag} * {width}) & {mask}L) & ~shiftleft(1L, w{tag})")
    return cut.withColumn(f"k{tag}", bits).withColumnRenamed("_open", f"_low{tag}")


def _same_segment(tag: str, width: int) -> Column:
    """The pair (x, y) differs in the bits below in at most one place of one segment; and this row is its one key."""
    mask = (1 << width) - 1
    first = f"(shiftrightunsigned(x.fp ^ y.fp, x._low{tag}) & {mask}L)"
    own = f"(shiftrightunsigned(x.fp ^ y.fp, x._low{tag} + x.s{tag} * {width}) & {mask}L)"
    segment = f"x.s{tag} = if(bit_count({first}) <= 1, 0, 1)"
    wiped = f"if({own} = 0L, x.w{tag} = 0, {own} = shiftleft(1L, x.w{tag}))"
    return F.expr(f"({segment}) AND ({wiped})")


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of ``rep`` of different fingerprints (fp, rep) that differ in at most two bits, each once.

    A bucket of over ``BUCKET`` fingerprints isn't paired: half of its bits are open, and those are cut
    into two and indexed with one bit wiped in turn, for this bucket alone. After halves of 32, 16 and
    8 bits at most 11 bits are open, so that no bucket can hold over 2,048 fingerprints.
    """
    if max_bits > 3:
        raise ValueError("two segments find at most three differing bits")
    rows, keys, pairs = fps.select("fp", "rep").withColumn("_open", F.lit(0)), [], []
    condition = F.expr(f"x.fp < y.fp AND bit_count(x.fp ^ y.fp) <= {max_bits}")
    for width in (32, 16, 8):
        tag = str(width)
        indexed = _variants(rows, width, tag)
        keys += [f"s{tag}", f"w{tag}", f"k{tag}"]
        counted = indexed.withColumn("_n", F.count("*").over(Window.partitionBy(*keys))).where("_n > 1")
        met = saved(counted, "buckets")
        condition = condition & _same_segment(tag, width)
        small = met if width == 8 else met.where(F.col("_n") <= BUCKET)
        same = F.expr(" AND ".join(f"x.{k} = y.{k}" for k in keys))
        pairs.append(small.alias("x").join(small.alias("y"), same & condition).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")))
        if width == 8 or not met.where(F.col("_n") > BUCKET).head(1):
            break
        # The other segment's bits are the open ones.
        rows = met.where(F.col("_n") > BUCKET).withColumn("_open", F.expr(f"_low{tag} + (1 - s{tag}) * {width}")).drop("_n")
    found = pairs[0]
    for more in pairs[1:]:
        found = found.unionByName(more)
    return found


def classes(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component) for each different fingerprint of (doc_id, fp): the least doc_id that links reach."""
    groups = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "groups")
    labels = components(links(groups.where("rep is not null"), max_bits))
    joined = groups.join(labels, groups.rep == labels.node, "left")
    return joined.select("fp", F.coalesce("component", "rep").alias("component"))


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``.

    Null and empty texts have fingerprint zero and link like any other. A row with a null doc_id keeps
    its place; it names no component unless all of its class have none. Repeated rows stay repeated.
    Other columns aren't read.
    """
    fps = saved(fingerprints(docs), "fingerprints")
    labelled = fps.join(saved(classes(fps, max_bits), "classes"), "fp")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return labelled.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: that of the least doc_id.

    A doc_id in several rows stays once for each component that it is the least of, with a text (the least)
    of that component. Rows without a doc_id stay.
    """
    fps = saved(fingerprints(docs), "fingerprints")
    labelled = fps.where("doc_id is not null").join(saved(classes(fps, max_bits), "classes"), "fp")
    kept = labelled.where("doc_id = component").groupBy("doc_id").agg(F.min("fp").alias("key"))
    keys = fps.where("doc_id is not null").select("doc_id", F.col("fp").alias("key"))
    return chosen_rows(docs, keys, saved(kept, "kept"), _signed)
