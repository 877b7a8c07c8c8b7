"""Where a job keeps the tables it writes for itself, and plan-size checks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A dimension is broadcast only when its rows take at most this in memory: the driver holds them, too, and more than once.
BROADCAST_BYTES = 64 * 1024 * 1024
#: What a row that is held takes besides its values: lengths, offsets, its place in the hash table.
ROW_BYTES = 64
#: Rows in files of up to this part of a limit are taken to fit; those of larger files are looked at, as files may be packed tightly.
PACKED = 256
#: A key is cut into this many slices at least by :func:`join_dimension`, and into more for a
#: larger fact table, so that even one that holds all rows leaves about so many bytes per slice.
SALTS = 16
SLICE_BYTES = 1 << 30
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: A dimension row is copied into each slice; adaptive execution splits what is still too large.
MOST_SALTS = 4096


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, unique to this application.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting falls back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/txnrisk-{spark.sparkContext.applicationId}"


_LOCAL: list[tempfile.TemporaryDirectory] = []


def _local_base() -> str:
    if not _LOCAL:
        _LOCAL.append(tempfile.TemporaryDirectory(prefix="txnrisk-"))  # goes when the process ends
    return _LOCAL[0].name


def new_path(spark: SparkSession, name: str) -> str:
    """A path nothing else uses."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: the same on every later use, and cheap to read again."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def open_folders(spark: SparkSession, most: int = 64) -> Iterator[None]:
    """Writes inside keep up to ``most`` output folders of a task open at once; else a task's rows are sorted by folder first."""
    before = spark.conf.get(OPEN_WRITERS)
    spark.conf.set(OPEN_WRITERS, str(most))
    try:
        yield
    finally:
        spark.conf.set(OPEN_WRITERS, before)


def observed(seen: Observation) -> dict:
    """What an observation counted; nothing where the optimiser knew the rows to be none and left it out."""
    try:
        return dict(seen.get)
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return {}


def planned_bytes(df: DataFrame) -> int:
    """Optimizer's size estimate; for plain files this is the file size, or less where columns are left out."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def read_bytes(df: DataFrame) -> int:
    """Planned size of all that is read for ``df``. The estimate for a join is the product of its sides, so that
    after a join :func:`planned_bytes` says nothing about the rows."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def held_bytes(df: DataFrame) -> int:
    """What the rows take in memory; found by a pass over them, for which numbers and times aren't read."""
    size = F.lit(ROW_BYTES)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) + 16
        elif isinstance(f.dataType, T.AtomicType):
            size = size + f.dataType.typeName().startswith("decimal") * 8 + 8
        else:
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(f"`{f.name}`"))), F.lit(0)) + 16
    return df.agg(F.sum(size.cast("bigint"))).first()[0] or 0


def held_within(df: DataFrame, most: int) -> bool:
    """May the rows be sent to every task? Planned sizes are those of packed files, often a tenth of what the
    rows take in memory or less, so rows of more than very small files are measured."""
    planned = planned_bytes(df)
    return planned <= most and (planned <= most // PACKED or held_bytes(df) <= most)


def join_dimension(fact: DataFrame, dim: DataFrame, key: str, spread: Column) -> DataFrame:
    """Left join to a one-row-per-key dimension, safe for a hot ``key``.

    A dimension of checked size is broadcast. A larger one is joined on
    (key, slice): ``spread`` puts each fact row into one of the slices and
    the dimension has a copy of its row in each, so no key lands in one task.
    Its files may be packed so tightly that Spark would broadcast the copies by
    itself; the hint says not to.
    """
    if held_within(dim, BROADCAST_BYTES):
        return fact.join(F.broadcast(dim), key, "left")
    salts = max(SALTS, -(-read_bytes(fact) // SLICE_BYTES)) if not fact.isStreaming else SALTS
    salts = min(salts, MOST_SALTS)
    slices = dim.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    sliced = fact.withColumn("_slice", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    return sliced.join(slices.hint("merge"), [key, "_slice"], "left").drop("_slice")
