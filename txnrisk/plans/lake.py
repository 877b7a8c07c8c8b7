"""Raw -> clean -> aggregates, as one application."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txnrisk.operators import gold as G
from txnrisk.operators.envelope import flatten, message_status, parse_times
from txnrisk.operators.silver import OUTCOMES, classified_rows, quarantine_reasons, to_silver
from txnrisk.schema import GOLD_TABLES
from txnrisk.sources import files
from txnrisk.storage import open_folders


@dataclass
class RunMetrics:
    """Counters of a run, each observed while its output was written."""

    counts: dict[str, int] = field(default_factory=dict)
    gold_rows: dict[str, int] = field(default_factory=dict)


def require_rows(df: DataFrame, what: str) -> None:
    """Stop cleanly when nothing was read."""
    if df.isEmpty():
        raise ValueError(f"no rows in {what}")


def typed_rows(messages: DataFrame) -> DataFrame:
    """Messages with their status -> typed rows with their status."""
    return parse_times(flatten(messages, keep=["status"]))


def gold_frames(silver: DataFrame, run_date: str, location: str = "", database: str = "") -> dict[str, DataFrame]:
    """All Gold tables over a Silver table."""
    return {
        "fraud_by_merchant": G.fraud_by_merchant(silver, run_date),
        "fraud_by_segment": G.fraud_by_segment(silver, run_date),
        "fraud_by_hour": G.fraud_by_hour(silver, run_date),
        "high_risk_customers": G.high_risk_customers(silver, run_date),
        "pipeline_run_summary": G.pipeline_run_summary(silver, run_date, location, database),
    }


#: A run stops when a larger share of its messages can't be read at all.
UNREADABLE_SHARE = 0.5


def bronze_to_silver(spark: SparkSession, bronze: str, out: str, run_ts: str, run_id: str) -> dict[str, int]:
    """Parse, quarantine, de-duplicate and write Silver; returns the run counters.

    input = output + duplicates_removed + corrupted + dead_letter: no message is lost.
    """
    messages = files.read_bronze(spark, bronze)
    require_rows(messages, bronze)
    # The raw text is read and parsed once: typed rows are staged by outcome, and
    # each output then reads only its own folder and columns.
    staging = f"{out}/staging/run_id={run_id}"
    seen, written = Observation(), Observation()
    outcome = F.col("outcome")
    counts = [F.count_if(outcome == name).alias(name) for name in OUTCOMES]
    staged = classified_rows(messages).observe(seen, F.count(F.lit(1)).alias("input"), *counts)
    with open_folders(spark):
        staged.write.mode("overwrite").partitionBy("outcome").parquet(staging)
    if seen.get["dead_letter"] > UNREADABLE_SHARE * seen.get["input"]:
        files.remove(spark, staging)
        raise ValueError(f"{seen.get['dead_letter']} of {seen.get['input']} messages can't be read")

    rows = spark.read.schema(staged.schema).parquet(staging)
    good, bad, dead = [rows.where(outcome == n).drop("outcome") for n in OUTCOMES]
    silver = to_silver(good.drop("body"), run_ts).observe(written, F.count(F.lit(1)).alias("output"))
    files.write_silver(silver, f"{out}/silver")
    files.write_quarantine(quarantine_reasons(bad.drop("body")), f"{out}/quarantine", run_id)
    dead.select("body").write.mode("overwrite").text(f"{out}/dead_letters/run_id={run_id}")
    files.remove(spark, staging)
    result = {**seen.get, **written.get}
    result["duplicates_removed"] = result["valid"] - result["output"]
    return result


def silver_to_gold(
    spark: SparkSession, out: str, run_date: str, database: str = ""
) -> dict[str, int]:
    """Write every Gold table from Silver; returns their row counts."""
    silver = files.read_silver(spark, f"{out}/silver")
    require_rows(silver, f"{out}/silver")
    frames = gold_frames(silver, run_date, out, database)
    return {name: files.write_gold(df, f"{out}/gold", name) for name, df in frames.items()}


def verify_gold(spark: SparkSession, base: str) -> dict[str, bool]:
    """Which Gold tables hold at least one row."""
    return {t: not spark.read.parquet(f"{base}/{t}").isEmpty() for t in GOLD_TABLES}


def run(spark: SparkSession, bronze: str, out: str, run_ts: str, run_id: str = "run") -> RunMetrics:
    """The whole batch: raw messages to registered Gold tables."""
    metrics = RunMetrics()
    metrics.counts = bronze_to_silver(spark, bronze, out, run_ts, run_id)
    metrics.gold_rows = silver_to_gold(spark, out, run_ts)
    files.register_tables(spark, f"{out}/silver", f"{out}/gold")
    return metrics


# The saved queries over the registered Gold tables. Ties are
# broken by the group keys, so a limited result is always the same.
SAVED_QUERIES = {
    "rate_by_category": """
        SELECT merchant_category, merchant_risk_tier, fraud_rate_pct, total_transactions
        FROM {gold_fraud_by_merchant}
        ORDER BY fraud_rate_pct DESC, merchant_category, merchant_risk_tier""",
    "rate_by_segment": """
        SELECT customer_segment, fraud_rate_pct, total_transactions
        FROM {gold_fraud_by_segment} ORDER BY fraud_rate_pct DESC, customer_segment""",
    "peak_hours": """
        SELECT hour_of_day, traffic_period, fraud_rate_pct, total_transactions
        FROM {gold_fraud_by_hour}
        ORDER BY fraud_rate_pct DESC, hour_of_day, traffic_period LIMIT 5""",
    "top_customers": """
        SELECT customer_id, confirmed_fraud_count, max_signal_score, total_transaction_volume
        FROM {gold_high_risk_customers}
        ORDER BY max_signal_score DESC NULLS LAST, customer_id LIMIT 10""",
    "run_summary": "SELECT * FROM {gold_pipeline_run_summary}",
}


def saved_query(spark: SparkSession, name: str, gold: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run a saved query on given Gold frames, or on the registered tables."""
    text = SAVED_QUERIES[name]
    frames = gold or {t: spark.table(f"gold_{t}") for t in GOLD_TABLES}
    used = {f"gold_{t}": df for t, df in frames.items() if f"{{gold_{t}}}" in text}
    return spark.sql(text, **used)
