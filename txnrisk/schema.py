"""Table and message layouts shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and order of the data contract.
METADATA_FIELDS = [
    "event_id", "event_time", "arrival_time", "schema_version",
    "producer_id", "produced_at", "source",
]

# Silver column, envelope field, type.
SILVER_FIELDS = [
    tuple(line.split())
    for line in """
    event_id              metadata.event_id                        string
    event_time_text       metadata.event_time                      string
    arrival_time_text     metadata.arrival_time                    string
    schema_version        metadata.schema_version                  string
    produced_at           metadata.produced_at                     string
    source                metadata.source                          string
    step                  payload.step                             int
    transaction_type      payload.type                             string
    amount                payload.amount                           double
    customer_id           payload.nameOrig                         string
    balance_before        payload.oldbalanceOrg                    double
    balance_after         payload.newbalanceOrig                   double
    merchant_id           payload.nameDest                         string
    dest_balance_before   payload.oldbalanceDest                   double
    dest_balance_after    payload.newbalanceDest                   double
    is_fraud              payload.isFraud                          int
    is_flagged_fraud      payload.isFlaggedFraud                   int
    customer_segment      payload.customer_segment                 string
    device_id             payload.device_id                        string
    device_type           payload.device_type                      string
    device_age_days       payload.device_age_days                  int
    customer_country      payload.customer_country                 string
    merchant_country      payload.merchant_country                 string
    merchant_category     payload.merchant_category                string
    merchant_risk_score   payload.merchant_risk_score              double
    ip_address            payload.ip_address                       string
    ip_risk_score         payload.ip_risk_score                    double
    chargeback_status     payload.chargeback_status                string
    days_since_last_tx    payload.days_since_last_transaction      double
    velocity_5min         payload.transaction_velocity_5min        int
    velocity_1hour        payload.transaction_velocity_1hour       int
    lifetime_tx_count     payload.customer_lifetime_transactions   bigint
    lifetime_spend        payload.customer_lifetime_spend          double
    geo_anomaly_flag      payload.geo_anomaly_flag                 int
    new_device_flag       payload.new_device_flag                  int
    duplicate_event_flag  payload.duplicate_event_flag             int
    late_arrival_flag     payload.late_arrival_flag                int
    out_of_order_flag     payload.out_of_order_flag                int
    traffic_period        payload.traffic_period                   string
    """.strip().splitlines()
]

#: Envelope payload field -> Silver-style column of the flat transaction table.
PAYLOAD_FIELDS = {
    path.split(".", 1)[1]: (name, kind)
    for name, path, kind in SILVER_FIELDS
    if path.startswith("payload.")
}

# The raw transaction log, before any feature is added.
RAW_TRANSACTIONS = (
    "step int, type string, amount double, nameOrig string, oldbalanceOrg double, "
    "newbalanceOrig double, nameDest string, oldbalanceDest double, newbalanceDest double, "
    "isFraud int, isFlaggedFraud int"
)

# Model inputs, in training order.
FEATURES = [
    "merchant_risk_score", "velocity_5min", "velocity_1hour", "geo_anomaly_flag",
    "new_device_flag", "balance_mismatch_flag", "amount", "rule_signal_score",
]
LABEL = "is_fraud"

# Documented nullable columns of the transaction table.
NULLABLE_COLUMNS = [
    "merchant_category", "ip_address", "device_age_days", "days_since_last_tx",
    "merchant_risk_score", "customer_segment", "device_type", "ip_risk_score",
]

# The Gold tables.
GOLD_TABLES = [
    "fraud_by_merchant", "fraud_by_segment", "fraud_by_hour",
    "high_risk_customers", "pipeline_run_summary",
]

CORRUPT = "_corrupt"


def envelope_schema() -> T.StructType:
    """Message layout with text leaves, so ``365``, ``365.0`` and ``"365"`` all parse."""

    def text(names):
        return T.StructType([T.StructField(n, T.StringType()) for n in names])

    return T.StructType(
        [
            T.StructField("metadata", text(METADATA_FIELDS)),
            T.StructField("payload", text([*PAYLOAD_FIELDS, "chargeback_delay_days"])),
            T.StructField(CORRUPT, T.StringType()),
        ]
    )
