"""Gold tables kept up to date by loads: partial sums per load, merged on read.

A load adds the sums of its own rows and takes off those of the rows it replaces,
so a correction costs as much as the load it comes with. Maxima can't be taken
off: where a load replaces rows of a customer, that customer's maxima are taken
anew from the event store and stand in place of the earlier ones.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnrisk.functions.columns import cents
from txnrisk.operators import gold as G
from txnrisk.operators.store import EventStore

CUSTOMER = ["customer_id", "customer_segment", "customer_country"]
#: Table -> its groups, as columns over Silver.
GROUPS: dict[str, dict[str, Column | str]] = {
    "merchant": {"merchant_category": "merchant_category", "merchant_risk_tier": "merchant_risk_tier"},
    "segment": {"customer_segment": "customer_segment"},
    "hour": {"hour_of_day": "hour(event_time)", "traffic_period": "traffic_period"},
    "customer": {c: c for c in CUSTOMER},
    "merchant_id": {"merchant_id": "merchant_id"},
}
#: Summed columns: money as exact cents, risk with six decimals, the rest as they are.
MONEY, RISK, NUMBERS = ("amount", "lifetime_spend"), ("merchant_risk_score",), (
    "is_fraud", "geo_anomaly_flag", "new_device_flag", "duplicate_event_flag", "rule_signal_score", "lifetime_tx_count", "velocity_5min",
)
MAXIMA = {"max_velocity_5min": "velocity_5min", "max_signal_score": "rule_signal_score", "last_transaction_time": "event_time"}
#: Columns of Silver that the parts are made of.
USED = sorted({"event_id", "customer_id", "customer_segment", "customer_country", "merchant_id", "merchant_category", "merchant_risk_tier",
               "event_time", "traffic_period", "balance_mismatch_flag", *MONEY, *RISK, *NUMBERS})


def _sums(sign: Column) -> list[Column]:
    """Signed counts and sums of a group."""
    value = {c: cents(F.col(c)) for c in MONEY} | {c: F.col(c).cast(G.RISK_SCALE) for c in RISK} | {c: F.col(c).cast("bigint") for c in NUMBERS}
    kind = {c: "decimal(38,2)" for c in MONEY} | {c: "decimal(38,6)" for c in RISK} | {c: "bigint" for c in NUMBERS}
    found = [F.sum(sign).alias("n")]
    for name, test in G.SUMMARY_COUNTS.items():
        found.append(F.sum(F.when(F.expr(test), sign).otherwise(0)).alias(f"if_{name}"))
    for c in value:
        found.append(F.sum(sign * value[c]).cast(kind[c]).alias(f"sum_{c}"))
        found.append(F.sum(F.when(F.col(c).isNotNull(), sign).otherwise(0)).alias(f"n_{c}"))
    return found


@dataclass
class GoldParts:
    """Partial sums below ``base``, a folder per table and load, beside the event store they follow."""

    base: str

    @property
    def store(self) -> EventStore:
        return EventStore(f"{self.base}/store")

    def load(self, silver: DataFrame, load_id: int) -> None:
        """Take in Silver rows: new events, and corrections of earlier ones by their id."""
        spark = silver.sparkSession
        rows = silver.select(*USED, F.to_date("event_time").alias("day"), F.lit(load_id).cast("bigint").alias("loaded"))
        replaced = self.store.upsert(rows, load_id, version="loaded")
        schema = rows.schema
        taken = self.store.current(spark, schema).where(F.col("loaded") == load_id)
        signed = taken.withColumn("sign", F.lit(1).cast("bigint")).unionByName(replaced.withColumn("sign", F.lit(-1).cast("bigint")))
        for table, groups in GROUPS.items():
            by = [F.expr(e).alias(n) for n, e in groups.items()]
            signed.groupBy(*by).agg(*_sums(F.col("sign"))).write.mode("overwrite").parquet(f"{self.base}/parts/{table}/load_id={load_id}")
        self._maxima(replaced, schema, load_id)

    def _maxima(self, replaced: DataFrame, schema, load_id: int) -> None:
        spark = replaced.sparkSession
        # Groups with a replaced row are taken from the store as a whole, all others from the load: both in
        # one grouping, to which a replaced row brings nothing but its group.
        own = self.store.current(spark, schema).select(
            *CUSTOMER, *sorted(set(MAXIMA.values())), (F.col("loaded") == load_id).alias("fresh"), F.lit(True).alias("held"),
        )
        gone = replaced.select(*CUSTOMER, F.lit(False).alias("fresh"), F.lit(False).alias("held"))
        found = own.unionByName(gone, allowMissingColumns=True).groupBy(*CUSTOMER).agg(
            F.bool_or("held").alias("held"), F.bool_or("fresh").alias("fresh"), F.bool_or(~F.col("held")).alias("anew"),
            *(F.max(c).alias(f"all_{n}") for n, c in MAXIMA.items()), *(F.max(F.when(F.col("fresh"), F.col(c))).alias(f"own_{n}") for n, c in MAXIMA.items()),
        )
        tops = [F.when(F.col("anew"), F.col(f"all_{n}")).otherwise(F.col(f"own_{n}")).alias(n) for n in MAXIMA]
        out = found.where("held and (anew or fresh)").select(*CUSTOMER, *tops, "anew")
        out.write.mode("overwrite").parquet(f"{self.base}/parts/maxima/load_id={load_id}")

    # ------------------------------------------------------------ merged on read

    def parts(self, spark: SparkSession, table: str) -> DataFrame:
        """Sums over all loads, without the groups that no row is left of."""
        found = spark.read.parquet(f"{self.base}/parts/{table}")
        names = [c for c in found.columns if c not in GROUPS[table] and c != "load_id"]
        return found.groupBy(*GROUPS[table]).agg(*(F.sum(c).alias(c) for c in names)).where("n > 0")

    def maxima(self, spark: SparkSession) -> DataFrame:
        found = spark.read.parquet(f"{self.base}/parts/maxima")
        since = F.max(F.when(F.col("anew"), F.col("load_id"))).over(Window.partitionBy(*CUSTOMER))
        found = found.withColumn("since", since).where("since is null or load_id >= since")
        return found.groupBy(*CUSTOMER).agg(*(F.max(n).alias(n) for n in MAXIMA))

    def table(self, spark: SparkSession, name: str, run_date: str, location: str = "", database: str = "") -> DataFrame:
        """A Gold table, with the names and values it has when it is built from all of Silver."""
        makers: dict[str, Callable] = {
            "fraud_by_merchant": self._by_merchant, "fraud_by_segment": self._by_segment, "fraud_by_hour": self._by_hour,
            "high_risk_customers": self._customers,
        }
        if name == "pipeline_run_summary":
            return self._summary(spark, run_date, location, database)
        return makers[name](spark).withColumn("computed_at", F.lit(run_date))

    def _counts(self) -> list[Column]:
        return [
            F.col("n").alias("total_transactions"), F.col("sum_is_fraud").alias("fraud_transactions"),
            G.percent_of(F.col("sum_is_fraud"), F.col("n")).alias("fraud_rate_pct"),
        ]

    @staticmethod
    def _mean(column: str, digits: int) -> Column:
        n = F.col(f"n_{column}")
        return G.mean_of(F.when(n > 0, F.col(f"sum_{column}")), F.when(n > 0, n), digits)

    @staticmethod
    def _volume() -> Column:
        return F.round("sum_amount", 2).cast("double")

    def _by_merchant(self, spark: SparkSession) -> DataFrame:
        return self.parts(spark, "merchant").select(
            *GROUPS["merchant"], *self._counts(), self._mean("amount", 2).alias("avg_transaction_amount"), self._volume().alias("total_volume"),
            self._mean("merchant_risk_score", 4).alias("avg_merchant_risk_score"), self._mean("rule_signal_score", 2).alias("avg_signal_score"),
        )

    def _by_segment(self, spark: SparkSession) -> DataFrame:
        return self.parts(spark, "segment").select(
            *GROUPS["segment"], *self._counts(), self._mean("amount", 2).alias("avg_transaction_amount"),
            self._mean("lifetime_tx_count", 1).alias("avg_lifetime_transactions"), self._mean("lifetime_spend", 2).alias("avg_lifetime_spend"),
            F.col("sum_geo_anomaly_flag").alias("geo_anomaly_count"), F.col("sum_new_device_flag").alias("new_device_count"),
        )

    def _by_hour(self, spark: SparkSession) -> DataFrame:
        return self.parts(spark, "hour").select(
            *GROUPS["hour"], *self._counts(), self._mean("amount", 2).alias("avg_amount"), self._mean("velocity_5min", 2).alias("avg_velocity_5min"),
        )

    def _customers(self, spark: SparkSession) -> DataFrame:
        sums, tops = self.parts(spark, "customer").alias("p"), self.maxima(spark).alias("m")
        same = F.expr(" and ".join(f"p.{c} <=> m.{c}" for c in CUSTOMER))
        found = sums.join(tops.hint("merge"), same).select(  # neither side's packed size tells how much a driver would hold
            *(F.col(f"p.{c}").alias(c) for c in CUSTOMER), F.col("n").alias("total_transactions"),
            F.col("sum_is_fraud").alias("confirmed_fraud_count"), F.col("sum_geo_anomaly_flag").alias("geo_anomaly_count"),
            F.col("sum_new_device_flag").alias("new_device_count"), F.col("sum_duplicate_event_flag").alias("duplicate_event_count"),
            "max_velocity_5min", "max_signal_score", self._volume().alias("total_transaction_volume"),
            self._mean("merchant_risk_score", 4).alias("avg_merchant_risk"), "last_transaction_time",
        )
        return found.where(G.HIGH_RISK)

    def _summary(self, spark: SparkSession, run_date: str, location: str, database: str) -> DataFrame:
        whole = self.parts(spark, "customer").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("silver_records_read"),
            *(F.coalesce(F.sum(f"if_{c}"), F.lit(0)).alias(c) for c in G.SUMMARY_COUNTS),
        )
        # A customer may stand in several groups; a value that is NULL counts as one.
        customers = self.parts(spark, "customer").select("customer_id").distinct().agg(F.count("*")).scalar()
        merchants = self.parts(spark, "merchant_id").agg(F.count("*")).scalar()
        rate = G.percent_of(F.col("fraud_transactions"), F.greatest("silver_records_read", F.lit(1)))
        return whole.select(
            F.lit(run_date).alias("run_date"), "silver_records_read", "fraud_transactions", rate.alias("fraud_rate_pct"),
            customers.alias("unique_customers"), merchants.alias("unique_merchants"), "geo_anomaly_count", "new_device_count",
            "high_risk_merchant_count", "balance_mismatch_count", F.lit(location).alias("location"), F.lit(database).alias("database"),
        )
