"""Dimensions, the chargeback fact and replay copies.

Attributes that nobody observed are functions of the key (``assign_stable``),
so every run and every task agrees on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.functions.columns import (
    DISPUTE_OUTCOMES, EPOCH, OPERATING_SYSTEMS, RISK_PROFILES, assign_stable, cents, digest, finite, micros, plus_seconds, stable_int,
)

# Age of accounts, merchants and devices in days, dispute delay in days.
ACCOUNT_DAYS = (30, 1824)
MERCHANT_DAYS = (60, 3649)
DISPUTE_DAYS = (7, 90)


def _first_seen(tx: DataFrame, key: str, columns: dict[str, Column]) -> DataFrame:
    """Per key the given columns as of its first event, in ``f``; at one time the least of them.

    The table is first reduced to its different attributes with their first time, which is a
    hash aggregate; only those few rows are compared as a whole.
    """
    rows = tx.where(F.col(key).isNotNull()).select(key, *[c.alias(n) for n, c in columns.items()], micros(F.col("event_time")).alias("us"))
    cells = rows.groupBy(key, *columns).agg(F.min("us").alias("us"))
    return cells.where("us is not null").groupBy(key).agg(F.min_by(F.struct(*columns), F.struct("us", *columns)).alias("f"))


def _created(key: str, days: tuple[int, int], salt: str) -> Column:
    return F.date_sub(F.lit(EPOCH[:10]).cast("date"), stable_int(F.col(key), *days, salt))


def customers_dim(tx: DataFrame) -> DataFrame:
    key = F.col("customer_id")
    slot = F.col("device_slot") if "device_slot" in tx.columns else stable_int(key, 0, 2, "slot")
    seen = {"segment": F.col("customer_segment"), "country": F.col("customer_country"), "slot": slot}
    first = _first_seen(tx, "customer_id", seen)
    return first.select(
        "customer_id",
        F.coalesce("f.segment", F.lit("Family")).alias("customer_segment"),
        F.coalesce("f.country", F.lit("US")).alias("home_country"),
        _created("customer_id", ACCOUNT_DAYS, "account").alias("account_creation_date"),
        assign_stable(key, RISK_PROFILES, "risk").alias("risk_profile"),
        F.col("f.slot").cast("int").alias("preferred_device_type"),
    )


def merchants_dim(tx: DataFrame) -> DataFrame:
    seen = {
        "category": F.col("merchant_category"), "country": F.col("merchant_country"),
        "risk": F.col("merchant_risk_score"),
    }
    first = _first_seen(tx, "merchant_id", seen)
    return first.select(
        "merchant_id",
        F.coalesce("f.category", F.lit("Retail")).alias("merchant_category"),
        F.coalesce("f.country", F.lit("US")).alias("merchant_country"),
        F.round(F.coalesce("f.risk", F.lit(0.1)), 4).alias("merchant_risk_score"),
        _created("merchant_id", MERCHANT_DAYS, "merchant").alias("merchant_creation_date"),
    )


def devices_dim(tx: DataFrame) -> DataFrame:
    key = F.col("device_id")
    seen = {"kind": F.col("device_type"), "age": F.col("device_age_days")}
    first = _first_seen(tx, "device_id", seen)
    system = F.lit(None).cast("string")
    for kind, names in OPERATING_SYSTEMS.items():
        system = F.when(F.col("f.kind") == kind, assign_stable(key, names, "os")).otherwise(system)
    return first.select(
        "device_id", F.col("f.kind").alias("device_type"),
        F.col("f.age").cast("int").alias("device_age_days"), system.alias("operating_system"),
    )


def chargebacks(tx: DataFrame, mode: str = "code") -> DataFrame:
    """One dispute per fraud row (``code``) or per filed chargeback (``documented``)."""
    tests = {"code": "is_fraud = 1", "documented": "chargeback_status = 'Filed'"}
    key = F.col("event_id")
    return tx.where(tests[mode]).select(
        F.concat(F.lit("CB-"), F.upper(F.substring(digest(key, "cb"), 1, 10))).alias("chargeback_id"),
        key.alias("transaction_id"),
        "customer_id",
        stable_int(key, *DISPUTE_DAYS, "days").alias("days_to_dispute"),
        assign_stable(key, DISPUTE_OUTCOMES, "outcome").alias("resolution_status"),
    )


def filed_chargebacks(rows: DataFrame) -> DataFrame:
    """Chargebacks that were filed, from the status and the delay that came with the events.

    A delay that is negative, no number or missing is NULL, and so is the day of filing then.
    A chargeback on an event that was no fraud is a friendly one.
    """
    days = finite(F.col("chargeback_delay_days").try_cast("double"))
    days = F.when(days >= 0, days)
    filed = plus_seconds(F.col("event_time"), F.floor(days * 86400))
    return rows.where("chargeback_status = 'Filed'").select(
        F.col("event_id").alias("transaction_id"), "customer_id", "customer_segment", "amount", days.alias("days_to_dispute"),
        F.to_date(filed).alias("filed_on"), F.when(F.col("is_fraud") == 0, 1).otherwise(0).alias("is_friendly"),
    )


# Upper ends of the delay classes of a report, in days.
DELAY_CLASSES = {"week": 7, "month": 30, "quarter": 90}


def chargeback_report(filed: DataFrame) -> DataFrame:
    """Per customer segment and delay class: chargebacks, friendly ones among them, and their amount."""
    place = F.lit("later")
    for name, most in reversed(DELAY_CLASSES.items()):
        place = F.when(F.col("days_to_dispute") <= most, name).otherwise(place)
    place = F.when(F.col("days_to_dispute").isNull(), "unknown").otherwise(place)
    return filed.groupBy("customer_segment", place.alias("delay_class")).agg(
        F.count("*").alias("chargebacks"), F.sum("is_friendly").alias("friendly"),
        F.round(F.sum(cents(F.col("amount"))), 2).cast("double").alias("amount"),
    )


# Replay modes.
REPLAY_MODES = {"1x": 1, "10x": 10, "100x": 100}


def replay(df: DataFrame, copies: int) -> DataFrame:
    """``copies`` of every row; round 0 keeps its event id, others get a derived one.

    Rows are unfolded in place: no join and no shuffle.
    """
    rounds = df.withColumn("replay_round", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    text = F.concat("event_id", F.lit("|"), F.col("replay_round").cast("string"))
    fresh = F.concat(F.lit("EVT-"), F.upper(F.substring(F.md5(text), 1, 16)))
    return rounds.withColumn(
        "event_id", F.when(F.col("replay_round") == 0, F.col("event_id")).otherwise(fresh)
    )
