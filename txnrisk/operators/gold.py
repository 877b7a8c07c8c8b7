"""Aggregate tables over Silver. Each is one grouped aggregate, combined map-side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.functions.columns import cents

RISK_SCALE = "decimal(18,6)"


def count_all() -> Column:
    return F.count("*")


def mean_of(total: Column, n: Column, digits: int) -> Column:
    """Mean from an exact total, divided and rounded as decimals: neither row
    order nor binary fractions can tip a value that ends in 5."""
    mean = total.cast("decimal(30,6)") / n.cast("decimal(20,0)")
    return F.round(mean, digits).cast("double")


def percent_of(part: Column, whole: Column) -> Column:
    return mean_of(part * 100, whole, 2)


def fraud_rate() -> Column:
    return percent_of(F.sum("is_fraud"), count_all())


def mean_money(column: str, digits: int = 2) -> Column:
    return mean_of(F.sum(cents(F.col(column))), F.count(column), digits)


def mean_risk() -> Column:
    risk = F.col("merchant_risk_score")
    return mean_of(F.sum(risk.cast(RISK_SCALE)), F.count(risk), 4)


def mean_count(column: str, digits: int) -> Column:
    return mean_of(F.sum(column), F.count(column), digits)


def money_total() -> Column:
    return F.round(F.sum(cents(F.col("amount"))), 2).cast("double")


def summarise(
    silver: DataFrame, by: list[Column | str], run_date: str, measures: dict[str, Column]
) -> DataFrame:
    columns = [measure.alias(name) for name, measure in measures.items()]
    return silver.groupBy(*by).agg(*columns, F.lit(run_date).alias("computed_at"))


def _fraud_counts() -> dict[str, Column]:
    return {
        "total_transactions": count_all(),
        "fraud_transactions": F.sum("is_fraud"),
        "fraud_rate_pct": fraud_rate(),
    }


def fraud_by_merchant(silver: DataFrame, run_date: str) -> DataFrame:
    """Which merchant categories and risk tiers attract fraud."""
    measures = _fraud_counts() | {
        "avg_transaction_amount": mean_money("amount"),
        "total_volume": money_total(),
        "avg_merchant_risk_score": mean_risk(),
        "avg_signal_score": mean_count("rule_signal_score", 2),
    }
    return summarise(silver, ["merchant_category", "merchant_risk_tier"], run_date, measures)


def fraud_by_segment(silver: DataFrame, run_date: str) -> DataFrame:
    """Which customer segments are hit."""
    measures = _fraud_counts() | {
        "avg_transaction_amount": mean_money("amount"),
        "avg_lifetime_transactions": mean_count("lifetime_tx_count", 1),
        "avg_lifetime_spend": mean_money("lifetime_spend"),
        "geo_anomaly_count": F.sum("geo_anomaly_flag"),
        "new_device_count": F.sum("new_device_flag"),
    }
    return summarise(silver, ["customer_segment"], run_date, measures)


def fraud_by_hour(silver: DataFrame, run_date: str) -> DataFrame:
    """When attacks peak."""
    measures = _fraud_counts() | {
        "avg_amount": mean_money("amount"),
        "avg_velocity_5min": mean_count("velocity_5min", 2),
    }
    by = [F.hour("event_time").alias("hour_of_day"), "traffic_period"]
    return summarise(silver, by, run_date, measures)


HIGH_RISK = (
    "confirmed_fraud_count > 0 OR (geo_anomaly_count > 0 AND new_device_count > 0) "
    "OR max_velocity_5min >= 5 OR max_signal_score >= 5"
)


def high_risk_customers(silver: DataFrame, run_date: str) -> DataFrame:
    """Customers with fraud, takeover signs, bursts or a high signal score."""
    measures = {
        "total_transactions": count_all(),
        "confirmed_fraud_count": F.sum("is_fraud"),
        "geo_anomaly_count": F.sum("geo_anomaly_flag"),
        "new_device_count": F.sum("new_device_flag"),
        "duplicate_event_count": F.sum("duplicate_event_flag"),
        "max_velocity_5min": F.max("velocity_5min"),
        "max_signal_score": F.max("rule_signal_score"),
        "total_transaction_volume": money_total(),
        "avg_merchant_risk": mean_risk(),
        "last_transaction_time": F.max("event_time"),
    }
    by = ["customer_id", "customer_segment", "customer_country"]
    return summarise(silver, by, run_date, measures).where(HIGH_RISK)


# Summary field -> condition counted.
SUMMARY_COUNTS = {
    "fraud_transactions": "is_fraud = 1",
    "geo_anomaly_count": "geo_anomaly_flag = 1",
    "new_device_count": "new_device_flag = 1",
    "high_risk_merchant_count": "merchant_risk_tier = 'HIGH'",
    "balance_mismatch_count": "balance_mismatch_flag = 1",
}
SUMMARY_DISTINCT = {"unique_customers": "customer_id", "unique_merchants": "merchant_id"}


def pipeline_run_summary(silver: DataFrame, run_date: str, location: str, database: str) -> DataFrame:
    """One row about the whole table.

    Flags are counted in one pass. Each distinct count is a group-by of one
    column with partial aggregation (NULL counts as a value), which reads only
    that column and needs no row expansion; the one-row parts are then merged.
    """
    names = ["silver_records_read", *SUMMARY_COUNTS, *SUMMARY_DISTINCT]

    def part(df: DataFrame, values: dict[str, Column]) -> DataFrame:
        return df.agg(*[values.get(n, F.lit(None)).cast("bigint").alias(n) for n in names])

    counts = {n: F.count_if(F.expr(test)) for n, test in SUMMARY_COUNTS.items()}
    parts = [part(silver, {"silver_records_read": count_all()} | counts)]
    for name, column in SUMMARY_DISTINCT.items():
        parts.append(part(silver.groupBy(column).agg(F.lit(1)), {name: count_all()}))
    merged = reduce(DataFrame.unionAll, parts).agg(*[F.max(n).alias(n) for n in names])
    rate = percent_of(F.col("fraud_transactions"), F.greatest("silver_records_read", F.lit(1)))
    return merged.select(
        F.lit(run_date).alias("run_date"),
        "silver_records_read", "fraud_transactions", rate.alias("fraud_rate_pct"),
        "unique_customers", "unique_merchants", "geo_anomaly_count", "new_device_count",
        "high_risk_merchant_count", "balance_mismatch_count",
        F.lit(location).alias("location"), F.lit(database).alias("database"),
    )
