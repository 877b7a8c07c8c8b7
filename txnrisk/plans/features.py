"""Raw transaction log -> enhanced transactions and dimensions, as one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.functions import columns as C
from txnrisk.operators import dims, history
from txnrisk.schema import RAW_TRANSACTIONS
from txnrisk.sources import files
from txnrisk.storage import join_dimension


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows with ``seq``, a text that orders them as they stand in the files.

    Files are ordered by name, then by place. The number of a row is only compared inside
    one stretch of a file, which one task reads from its start, so tasks need no common count.
    """
    place = F.monotonically_increasing_id().cast("string")
    rows = spark.read.schema(RAW_TRANSACTIONS).csv(path, header=True)
    return rows.select(
        "*",
        F.concat_ws(
            "#", F.col("_metadata.file_path"), F.lpad(F.col("_metadata.file_block_start").cast("string"), 19, "0"),
            F.lpad(place, 19, "0"),
        ).alias("seq"),
    )


def enhance(log: DataFrame, customers: DataFrame | None = None, merchants: DataFrame | None = None) -> DataFrame:
    """Step time, version, season and the customer's history for each raw row.

    ``customers`` (customer_id, customer_country, ...) and ``merchants`` (merchant_id,
    merchant_country, ...) bring what the log itself lacks; without countries no row is abroad.
    Rows of one customer in one step follow each other as in the log.
    """
    step = F.col("step")
    rows = log.select(
        "seq", "step", F.col("type").alias("transaction_type"), "amount", F.col("nameOrig").alias("customer_id"),
        F.col("nameDest").alias("merchant_id"), F.col("oldbalanceOrg").alias("balance_before"),
        F.col("newbalanceOrig").alias("balance_after"), F.col("oldbalanceDest").alias("dest_balance_before"),
        F.col("newbalanceDest").alias("dest_balance_after"), F.col("isFraud").alias("is_fraud"),
        F.col("isFlaggedFraud").alias("is_flagged_fraud"), C.step_time(step).alias("event_time"),
        C.schema_version(step).alias("schema_version"), C.traffic_period(step).alias("traffic_period"),
    )
    for dim, key in ((customers, "customer_id"), (merchants, "merchant_id")):
        rows = rows if dim is None else join_dimension(rows, dim, key, F.col("seq"))
    for country in ("customer_country", "merchant_country"):
        rows = rows if country in rows.columns else rows.withColumn(country, F.lit(None).cast("string"))
    return history.customer_features(rows, seq="seq")


def run(
    spark: SparkSession, log: str, out: str, customers: DataFrame | None = None, merchants: DataFrame | None = None
) -> DataFrame:
    """Write the enhanced table and the dimensions that its rows allow; returns the table read back."""
    enhance(read_log(spark, log), customers, merchants).write.mode("overwrite").parquet(f"{out}/enhanced")
    enhanced = spark.read.parquet(f"{out}/enhanced")
    tables = {}
    if "customer_segment" in enhanced.columns:
        tables["customers"] = dims.customers_dim(enhanced)
    if {"merchant_category", "merchant_risk_score"} <= set(enhanced.columns):
        tables["merchants"] = dims.merchants_dim(enhanced)
    files.write_dims(tables, f"{out}/dims")
    return enhanced
