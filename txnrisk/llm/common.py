"""What the training-data operators share: shipping code, saved tables, key spreading, hashes."""

from __future__ import annotations

import hashlib
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from txnrisk.storage import new_path

_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give executors this package, once per application, so that tasks can import it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    folder = tempfile.TemporaryDirectory(prefix="txnrisk-code-")  # the driver serves it while it runs
    archive = Path(folder.name) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED[app] = folder


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the folder all executors share, and read back.

    It cuts the lineage: a lost executor costs a read, not the work above.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator], schema: str) -> DataFrame:
    """``mapInArrow`` with this package available in the tasks."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that less of them is in Python at a time."""
    return (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows))


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text alone, whatever else the table has; a null text is empty."""
    return docs.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias(text))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, longer where ``df`` has them already, in whatever case."""
    used, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in used:
            name += "_"
        out.append(name)
    return out


def chosen_rows(docs: DataFrame, keys: DataFrame, kept: DataFrame, key: Callable[[str | None], int]) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, key of the text) is in ``kept``, one each (that of the least text), and those without a doc_id.

    ``keys`` has (doc_id, key) of all rows with a doc_id. Keys are taken again only of texts whose doc_id has several.
    """
    own, number, nth = free_names(docs, "_own", "_key", "_nth")
    several = keys.groupBy("doc_id").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high")
    several = saved(several.select(F.col("doc_id").alias(own)), "several")
    plain = kept.select(F.col("doc_id").alias(own)).distinct().join(several, own, "left_anti")
    rows = docs.join(plain, F.col("doc_id") == F.col(own), "left_semi")
    once = rows.withColumn(nth, F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))).where(F.col(nth) == 1).drop(nth)
    place = docs.columns.index("text")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([key(t) for t in batch.column(place).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, number])

    shared = docs.join(several, F.col("doc_id") == F.col(own), "left_semi")
    shared = map_arrow(shared, keyed, StructType([*docs.schema.fields, StructField(number, LongType())]))
    both = kept.select(F.col("doc_id").alias(own), F.col("key").alias(nth))
    shared = shared.join(both, (F.col("doc_id") == F.col(own)) & (F.col(number) == F.col(nth)), "left_semi")
    order = Window.partitionBy("doc_id", number).orderBy("text")
    shared = shared.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).drop(nth, number)
    return once.unionByName(shared).unionByName(docs.where(F.col("doc_id").isNull()))


def unsigned_crc32(values) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    import zlib

    return zlib.crc32(values.astype("<u4").tobytes())


def held_out(key: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the id as text is a multiple of five."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
