"""File sources and sinks of the lake."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnrisk.schema import FEATURES, GOLD_TABLES, LABEL, RAW_TRANSACTIONS
from txnrisk.storage import open_folders

DATE_PARTS = ["year", "month", "day"]
#: Written messages are compressed; Spark's readers and streams tell it by the files' names. A denser
#: codec would put so many messages into one read task that sorts of the parsed rows spill.
TEXT_CODEC = "lz4"


# ---------------------------------------------------------------- sources


def read_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw transaction log with header; the schema is fixed, never inferred."""
    return spark.read.schema(RAW_TRANSACTIONS).csv(path, header=True)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Messages as text, one per line, from all folders below ``path``.

    Many small files share one task: Spark packs them up to
    ``spark.sql.files.maxPartitionBytes``, each counted with
    ``spark.sql.files.openCostInBytes``.
    """
    return spark.read.option("recursiveFileLookup", "true").text(path).withColumnRenamed("value", "body")


def read_silver(
    spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None
) -> DataFrame:
    """Silver table. A day range becomes a predicate on the partition columns,
    so folders outside it are not listed into the scan."""
    silver = spark.read.parquet(path)
    packed = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    for day, keep in ((first_day, packed.__ge__), (last_day, packed.__le__)):
        if day:
            silver = silver.where(keep(int(day.replace("-", ""))))
    return silver


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet table that may not have been written yet."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    if root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def sample_stream(df: DataFrame, n: int, order: list[Column] | None = None) -> DataFrame:
    """The first ``n`` records of a source in the given order (a top-k, no full sort), for a look at it."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


# ---------------------------------------------------------------- sinks


def by_partition(df: DataFrame, columns: list[str]) -> DataFrame:
    """Gather rows of one output folder into few files; a folder that is too big
    for one task is split again at run time (rebalance)."""
    return df.hint("rebalance", *columns)


def write_bronze(messages: DataFrame, path: str, ingest_time: Column, run_id: str = "run", body: str = "body") -> None:
    """Raw messages of a run under the date they were taken in, many per file; a rerun replaces its own."""
    dated = messages.select(
        F.col(body).alias("value"), F.date_format(ingest_time, "yyyy").alias("year"),
        F.date_format(ingest_time, "MM").alias("month"), F.date_format(ingest_time, "dd").alias("day"),
    )
    with open_folders(messages.sparkSession):
        by_partition(dated, DATE_PARTS).write.mode("overwrite").partitionBy(*DATE_PARTS).text(f"{path}/run_id={run_id}", TEXT_CODEC)


def write_quarantine(rows: DataFrame, path: str, run_id: str) -> None:
    """Quarantined rows as JSON; a rerun with the same id replaces its rows."""
    rows.write.mode("overwrite").json(f"{path}/run_id={run_id}")


def write_silver(silver: DataFrame, path: str, dynamic: bool = False) -> None:
    """Parquet by event date. ``dynamic`` replaces only the dates that occur."""
    mode = "dynamic" if dynamic else "static"
    with open_folders(silver.sparkSession):
        (
            by_partition(silver, DATE_PARTS)
            .write.mode("overwrite").option("partitionOverwriteMode", mode)
            .partitionBy(*DATE_PARTS).parquet(path)
        )


def write_gold(df: DataFrame, base: str, name: str) -> int:
    """Write one Gold table and return its row count, counted while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{base}/{name}")
    return seen.get["n"]


def register_tables(spark: SparkSession, silver: str, gold: str, database: str | None = None) -> list[str]:
    """Make Silver and Gold queryable as ``silver_transactions`` and ``gold_*``.

    Without a database these are temporary views; with one, external tables
    whose partitions are recovered from the folders.
    """
    places = {"silver_transactions": silver} | {f"gold_{t}": f"{gold}/{t}" for t in GOLD_TABLES}
    for name, path in places.items():
        if database is None:
            spark.read.parquet(path).createOrReplaceTempView(name)
            continue
        spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")
        if name == "silver_transactions":
            spark.catalog.recoverPartitions(f"{database}.{name}")
    return list(places)


def write_alerts(alerts: DataFrame, path: str) -> None:
    alerts.write.mode("overwrite").json(path)


def write_dims(tables: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Dimensions and chargebacks, one folder each."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", "true")
        writer.format(fmt).save(f"{path}/{name}")


def export_training(split: DataFrame, path: str) -> None:
    """Training and validation CSV: label first, no header."""
    columns = [LABEL, *FEATURES]
    for name, test in (("train", ~F.col("is_validation")), ("validation", F.col("is_validation"))):
        split.where(test).select(*columns).write.mode("overwrite").csv(f"{path}/{name}", header=False)


def json_status(body: Column) -> Column:
    """``uploaded`` for valid JSON, else ``skipped``."""
    parsed = F.try_parse_json(body)
    return F.when(parsed.isNotNull(), "uploaded").otherwise("skipped")


def promotion_counts(messages: DataFrame, body: str = "body") -> DataFrame:
    status = json_status(F.col(body))
    return messages.groupBy(status.alias("status")).agg(F.count("*").alias("records"))


def promote_bronze(spark: SparkSession, source: str, target: str, run_id: str = "promoted") -> dict[str, int]:
    """Copy valid messages to another lake; counts come from the same pass.

    Messages keep the day of their folder (``year=/month=/day=`` or ``yyyy/mm/dd``, wherever
    it stands in the path) as text. A run replaces its own earlier copy and nothing else.
    A record that cannot be written fails the job, so ``errors`` is 0 on return.
    """
    seen = Observation()
    place = F.regexp_replace(F.col("_metadata.file_path"), "(year|month|day)=", "")
    read = spark.read.option("recursiveFileLookup", "true").text(source)
    dated = [F.regexp_extract(place, r"/(\d{4})/(\d{2})/(\d{2})/", k + 1).alias(p) for k, p in enumerate(DATE_PARTS)]
    checked = read.select("value", *dated).withColumn("_status", json_status(F.col("value")))
    counted = checked.observe(
        seen,
        F.count_if(F.col("_status") == "uploaded").alias("uploaded"),
        F.count_if(F.col("_status") == "skipped").alias("skipped"),
    )
    good = counted.where("_status = 'uploaded'").drop("_status")
    by_partition(good, DATE_PARTS).write.mode("overwrite").partitionBy(*DATE_PARTS).text(f"{target}/run_id={run_id}", TEXT_CODEC)
    return {**seen.get, "errors": 0}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this job wrote for itself."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def drop_partitions_before(spark: SparkSession, path: str, column: str, first_kept: str) -> int:
    """Delete partition folders ``column=value`` with a smaller value (text order), here or one level below."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = 0
    for pattern in (f"{column}=*", f"*/{column}=*"):
        for entry in fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, pattern)) or []:
            if entry.getPath().getName().partition("=")[2] < first_kept:
                fs.delete(entry.getPath(), True)
                dropped += 1
    return dropped
