"""Boundary rows of the pure operators."""

import json
import math
import re

import pytest
from pyspark.sql import functions as F

from txnrisk import storage
from txnrisk.functions import columns as C
from txnrisk.operators import dims, envelope, gold, ledger, ml, quality, rules, silver, sketches
from txnrisk.schema import FEATURES

ROW = dict(
    event_id="E1", event_time="2024-01-01T00:00:00", arrival_time="2024-01-01T00:00:05",
    schema_version="v1", produced_at="p", source="s", step=1, transaction_type="PAYMENT",
    amount=1500.0, customer_id="C1", balance_before=5000.0, balance_after=3500.0, merchant_id="M1",
    dest_balance_before=0.0, dest_balance_after=0.0, is_fraud=0, is_flagged_fraud=0,
    customer_segment="Family", device_id="D", device_type="Web", device_age_days=10,
    customer_country="US", merchant_country="US", merchant_category="Food",
    merchant_risk_score=0.15, ip_address="1.1.1.1", ip_risk_score=None, chargeback_status="None",
    days_since_last_tx=None, velocity_5min=0, velocity_1hour=0, lifetime_tx_count=1,
    lifetime_spend=1500.0, geo_anomaly_flag=0, new_device_flag=0, duplicate_event_flag=0,
    late_arrival_flag=0, out_of_order_flag=0, traffic_period="Normal",
)
DDL = (
    "event_id string, event_time string, arrival_time string, schema_version string, produced_at string, "
    "source string, step int, transaction_type string, amount double, customer_id string, "
    "balance_before double, balance_after double, merchant_id string, dest_balance_before double, "
    "dest_balance_after double, is_fraud int, is_flagged_fraud int, customer_segment string, "
    "device_id string, device_type string, device_age_days int, customer_country string, "
    "merchant_country string, merchant_category string, merchant_risk_score double, ip_address string, "
    "ip_risk_score double, chargeback_status string, days_since_last_tx double, velocity_5min int, "
    "velocity_1hour int, lifetime_tx_count bigint, lifetime_spend double, geo_anomaly_flag int, "
    "new_device_flag int, duplicate_event_flag int, late_arrival_flag int, out_of_order_flag int, "
    "traffic_period string"
)


def flat(spark, *changes):
    rows = [{**ROW, **c} for c in changes]
    return spark.createDataFrame([tuple(r.values()) for r in rows], DDL)


def timed(df):
    return df.withColumns({c: C.strict_time(F.col(c)) for c in ("event_time", "arrival_time")})


RISKY = dict(event_id="E2", transaction_type="CASH_OUT", amount=85000.0, merchant_risk_score=0.92, new_device_flag=1)
ALL_BUT_BURST = dict(
    event_id="E3", transaction_type="TRANSFER", amount=450000.0, balance_before=450000.0,
    balance_after=450000.0, merchant_risk_score=0.88, geo_anomaly_flag=1, new_device_flag=1,
    is_fraud=1, schema_version="v2",
)


def test_rule_golden_rows(spark):
    df = flat(
        spark, {}, RISKY, ALL_BUT_BURST,
        dict(ALL_BUT_BURST, event_id="E4", velocity_5min=5),
        dict(event_id="E5", transaction_type="TRANSFER", amount=10.0, balance_before=0.0, balance_after=0.0),
        dict(event_id="E6", merchant_risk_score=None, geo_anomaly_flag=None, velocity_5min=4),
    )
    got = {r.event_id: r for r in rules.apply_rules(df, velocity="velocity_5min").collect()}
    assert got["E1"].triggered_rules == [] and got["E1"].risk_score == 0 and not got["E1"].is_flagged
    assert got["E2"].triggered_rules == ["HIGH_RISK_MERCHANT"] and got["E2"].risk_score == 3
    assert got["E3"].triggered_rules == [r.name for r in rules.RULES["online"][1:]]
    assert got["E3"].risk_score == 14 and got["E4"].risk_score == 18
    assert got["E5"].triggered_rules == [] and got["E6"].triggered_rules == []
    bare = rules.apply_rules(df, include_label=False, velocity="velocity_5min").collect()
    assert {r.event_id: r.risk_score for r in bare}["E3"] == 12
    batch = {r.event_id: r for r in rules.apply_rules(df, "consumer").collect()}
    assert "BALANCE_MISMATCH_TRANSFER" not in batch["E3"].triggered_rules
    alert = rules.alert_records(rules.apply_rules(df, velocity="velocity_5min"), alerted_at="t", velocity="velocity_5min")
    subject = {r.event_id: r.subject for r in alert.collect()}
    assert subject["E2"] == "[FRAUD ALERT] Risk Score 3 — CASH_OUT $85000.00" and len(alert.columns) == 16


def test_silver_columns(spark):
    df = flat(
        spark, ALL_BUT_BURST, dict(event_id="Z", transaction_type="TRANSFER", amount=10.0, balance_before=0.0, balance_after=0.0),
        dict(event_id="N", merchant_risk_score=None, geo_anomaly_flag=None), dict(event_id="T", merchant_risk_score=0.40),
        dict(event_id="H", merchant_risk_score=0.75, velocity_5min=5),
    )
    out = silver.to_silver(timed(df), "now")
    got = {r.event_id: r for r in out.collect()}
    assert len(out.columns) == 47
    assert (got["E3"].rule_signal_score, got["E3"].balance_mismatch_flag, got["E3"].merchant_risk_tier) == (8, 1, "HIGH")
    assert got["Z"].balance_mismatch_flag == 1
    assert got["N"].merchant_risk_tier == "LOW" and got["N"].rule_signal_score is None
    assert got["T"].merchant_risk_tier == "MEDIUM" and got["H"].rule_signal_score == 7
    assert (got["E3"].year, got["E3"].month, got["E3"].day) == (2024, 1, 1)


def test_valid_split_is_total_and_reasons(spark):
    df = timed(flat(
        spark, {}, dict(event_id=None), dict(event_id="a", amount=None), dict(event_id="b", amount=0.0),
        dict(event_id="c", transaction_type=None), dict(event_id="d", event_time="2024-01-01T00:00:00.5"),
        dict(event_id="e", merchant_risk_score=99.9),
    ))
    good, bad = silver.split_valid(df)
    assert good.count() == 2 and bad.count() == 5
    _, lossy = silver.split_valid(df, strict_reference=True)
    assert lossy.count() == 4
    reasons = {r.event_id: r.reasons for r in silver.quarantine_reasons(df).collect()}
    assert reasons[None] == ["missing_event_id"] and reasons["a"] == ["null_amount"]
    assert reasons["b"] == ["non_positive_amount"] and reasons["c"] == ["missing_type"]
    assert reasons["d"] == ["malformed_event_time"] and reasons["e"] == ["risk_out_of_range"]


def test_dedup_keeps_earliest_and_is_limited_before_the_shuffle(spark):
    df = timed(flat(
        spark, dict(arrival_time="2024-01-01T00:05:00"), dict(arrival_time="2024-01-01T00:01:00", amount=7.0),
        dict(arrival_time=None),
    ))
    out = silver.dedup_events(df)
    plan = out._jdf.queryExecution().executedPlan().toString()  # before it runs: one copy
    assert plan.count("WindowGroupLimit") == 2
    assert [r.amount for r in out.collect()] == [7.0]


def test_dedup_of_stored_rows_shuffles_repeated_ids_only(spark, monkeypatch):
    """F4 to F11, F18: a row whose id comes once goes through no sort and no exchange of whole rows."""
    rows = [dict(event_id=f"E{i}", arrival_time=f"2024-01-01T00:0{k}:00", amount=float(10 * i + k + 1)) for i in range(40) for k in range(1 + (i % 8 == 0) + (i % 16 == 0))]
    df = timed(flat(spark, *rows, dict(event_id="E0", arrival_time="2024-01-01T00:00:00", amount=1.0)))
    expected = sorted(map(tuple, silver.dedup_events(df).collect()), key=str)
    out = silver.dedup_stored(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    whole, part = plan.split("Window [", 1)
    assert "LeftAnti" in whole and "LeftSemi" in part and out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == expected and len(expected) == 40
    monkeypatch.setattr(silver, "REPEATED_BYTES", -1)  # too many repeated ids to send out
    assert sorted(map(tuple, silver.dedup_stored(df).collect()), key=str) == expected


def test_envelope_round_trip(spark):
    odd = dict(event_id="E2", schema_version="v2", ip_risk_score=0.5, merchant_risk_score=float("nan"),
               lifetime_spend=float("inf"), ip_address="nan")
    df = envelope.build_envelope(flat(spark, {}, odd), "p1", "2024-01-01T00:00:09")
    bodies = {json.loads(r.body)["metadata"]["event_id"]: json.loads(r.body) for r in df.collect()}
    assert "ip_risk_score" not in bodies["E1"]["payload"] and bodies["E2"]["payload"]["ip_risk_score"] == 0.5
    assert bodies["E2"]["payload"]["merchant_risk_score"] is None
    assert bodies["E1"]["payload"]["days_since_last_transaction"] is None
    got = {r.event_id: r for r in envelope.parse_envelope(df.select("body")).collect()}
    assert got["E1"].amount == 1500.0 and got["E1"].step == 1 and got["E1"].lifetime_tx_count == 1
    assert got["E2"].merchant_risk_score is None and got["E2"].lifetime_spend is None
    assert got["E2"].ip_address is None and len(got["E1"].asDict()) == 39


def test_lenient_numbers_and_message_status(spark):
    bodies = [
        '{"metadata":{"event_id":"A","event_time":"bad"},"payload":{"step":"365","device_age_days":365.0,"amount":"1e3"}}',
        '{"metadata":{"event_id":""},"payload":{}}', '{"metadata":{"event_id":"B"}}', '{"metadata":{"event', "[]", None,
    ]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    status = [r.status for r in envelope.message_status(df).collect()]
    assert status == ["parsed", "skipped", "dead_letter", "dead_letter", "dead_letter", "dead_letter"]
    row = envelope.parse_envelope(df).first()
    assert (row.step, row.device_age_days, row.amount, row.event_time) == (365, 365, 1000.0, None)
    good, dead = envelope.split_dead_letter(df)
    assert good.count() == 2 and dead.count() == 4
    late = envelope.parse_envelope(df, fallback=F.expr("timestamp_ntz'2024-05-05 00:00:00'")).first()
    assert str(late.event_time) == "2024-05-05 00:00:00"
    with pytest.raises(ValueError):
        envelope.assert_envelope(df)


def test_times(spark):
    df = spark.createDataFrame(
        [("2024-01-01T00:00:05",), ("2024-01-01T00:00:05.25",), ("2024-01-01T02:00:05+02:00",), ("2024-13-01T00:00:00",)],
        "t string",
    )
    strict = [str(r[0]) for r in df.select(C.strict_time(F.col("t"))).collect()]
    assert strict == ["2024-01-01 00:00:05", "None", "None", "None"]
    iso = [str(r[0]) for r in df.select(C.iso_time_utc(F.col("t"))).collect()]
    assert iso == ["2024-01-01 00:00:05", "2024-01-01 00:00:05.250000", "2024-01-01 00:00:05", "None"]
    stamps = spark.sql(
        "SELECT explode(array(timestamp_ntz'1969-12-31 23:59:59.999999', timestamp_ntz'2024-02-29 12:34:56.789012', "
        "timestamp_ntz'9999-12-31 23:59:59.999999')) AS t"
    )
    assert stamps.where(C.from_micros(C.micros(F.col("t"))) != F.col("t")).count() == 0
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        spring = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00' AS t")
        assert spring.select(C.micros(F.col("t"))).first()[0] == 1710037800 * 10**6
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_steps_seasons_devices(spark):
    steps = [167, 168, 192, 193, 335, 336, 360, 361, 399, 400]
    df = spark.createDataFrame([(s,) for s in steps], "s int")
    got = df.select(C.traffic_period(F.col("s")), C.schema_version(F.col("s")), C.step_time(F.col("s"))).collect()
    assert "".join(r[0][0] for r in got[:8]) == "NPPNNHHN"
    assert [r[1] for r in got[-2:]] == ["v1", "v2"] and str(got[0][2]) == "2023-01-07 23:00:00"
    device = spark.range(1).select(C.device_id(F.lit("C1"), F.lit(0))).first()[0]
    assert device == "DEV-7E13F2A745F1"
    ages = spark.createDataFrame([(1,), (2,), (None,)], "a int").select(C.new_device(F.col("a"))).collect()
    assert [r[0] for r in ages] == [1, 0, 0]


def test_stable_assignment_follows_the_weights(spark):
    keys = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    share = {r.v: r["count"] / 20000 for r in keys.groupBy(C.assign_stable(F.col("k"), C.DEVICE_TYPES, "x").alias("v")).count().collect()}
    assert all(abs(share[d] - w / 100) < 0.02 for d, w in C.DEVICE_TYPES.items())
    low, high = keys.select(F.min(C.stable_int(F.col("k"), 7, 90, "d")), F.max(C.stable_int(F.col("k"), 7, 90, "d"))).first()
    assert (low, high) == (7, 90)


def test_oversize_and_routing(spark):
    df = envelope.build_envelope(flat(spark, {}), "p", "t").unionByName(
        envelope.build_envelope(flat(spark, dict(event_id="é" * 300, is_fraud=1)), "p", "t"))
    limit = len(df.first().body.encode()) + 10
    fits, rejects = envelope.split_oversize(df, limit)
    assert fits.count() == 1 and rejects.first().body_bytes > limit
    attrs = envelope.routing_attributes(fits).first()
    assert (attrs.attr_event_id, attrs.attr_schema_version, attrs.attr_is_fraud, attrs.attr_customer_id) == ("E1", "v1", "0", "C1")


def test_content_duplicates_and_late(spark):
    df = timed(flat(
        spark, {}, dict(event_id="E2", arrival_time="2024-01-01T00:05:00"), dict(event_id="E3", amount=2.0, arrival_time="2024-01-01T00:05:01"),
        dict(event_id="E0", arrival_time="2024-01-01T00:05:00"),
    ))
    flags = {r.event_id: r.content_duplicate for r in quality.flag_content_duplicates(df).collect()}
    assert flags == {"E1": 0, "E2": 1, "E3": 0, "E0": 1}
    late = {r.event_id: r.is_late for r in quality.flag_late(df).collect()}
    assert late == {"E1": 0, "E2": 0, "E3": 1, "E0": 0}


def test_reports_on_hand_rows(spark):
    df = timed(flat(spark, {}, dict(event_id="E2", customer_id="C2", merchant_risk_score=None), dict(event_id="E3")))
    skew = quality.key_skew(df, "customer_id").first()
    assert (skew.unique_keys, skew.top_key, skew.top_count, skew.singleton_keys) == (2, "C1", 2, 1)
    nulls = {r.column_name: (r.null_count, r.null_pct) for r in quality.null_profile(df, ["merchant_risk_score", "step"]).collect()}
    assert nulls == {"merchant_risk_score": (1, 33.33), "step": (0, 0.0)}
    changed = df.withColumn("is_fraud", F.when(F.col("event_id") == "E2", 1).otherwise(0)).where("event_id <> 'E3'")
    check = quality.label_check(df.unionByName(df), changed).first()
    assert tuple(check) == (2, 1, 0, 1, 0)
    exact = quality.latency_profile(df).first()
    assert exact.p50_seconds == 5.0 and exact.late_pct == 0.0
    assert quality.latency_profile(df, accuracy=100).first().p99_seconds == 5.0


def test_gold_having_and_distinct_with_null(spark):
    df = silver.to_silver(timed(flat(
        spark, {}, dict(event_id="a", customer_id=None), dict(event_id="b", customer_id="C9", is_fraud=1),
        dict(event_id="c", customer_id="C8", geo_anomaly_flag=None),
    )), "now")
    summary = gold.pipeline_run_summary(df, "d", "here", "db").first()
    assert summary.unique_customers == 4 and summary.fraud_rate_pct == 25.0 and len(summary) == 12
    assert [r.customer_id for r in gold.high_risk_customers(df, "d").collect()] == ["C9"]
    empty = gold.pipeline_run_summary(df.limit(0), "d", "", "").first()
    assert (empty.silver_records_read, empty.fraud_rate_pct) == (0, 0.0)


def test_dims_replay_chargebacks(spark):
    df = timed(flat(
        spark, {}, dict(event_id="E2", event_time="2023-12-31T00:00:00", customer_segment="Student", is_fraud=1),
        dict(event_id="E3", chargeback_status="Filed"),
    ))
    c = dims.customers_dim(df).first()
    assert c.customer_segment == "Student" and c.preferred_device_type in (0, 1, 2)
    assert dims.merchants_dim(df).count() == 1 and dims.devices_dim(df).first().operating_system in C.OPERATING_SYSTEMS["Web"]
    assert [r.transaction_id for r in dims.chargebacks(df).collect()] == ["E2"]
    assert [r.transaction_id for r in dims.chargebacks(df, "documented").collect()] == ["E3"]
    many = dims.replay(df, dims.REPLAY_MODES["10x"])
    assert many.count() == 30 and many.select("event_id").distinct().count() == 30
    assert many.where("replay_round = 0 AND event_id IN ('E1','E2','E3')").count() == 3


def test_ledger_expiry_and_upsert(spark):
    now = F.expr("timestamp_ntz'2024-01-02 00:00:00'")
    df = timed(flat(spark, {}, {}, dict(event_id="E2"), dict(event_id="E3")))
    marks = spark.sql(
        "SELECT 'E2' AS event_id, timestamp_ntz'2024-01-01 00:00:01' AS processed_at "
        "UNION ALL SELECT 'E3', timestamp_ntz'2024-01-01 00:00:00'"
    )
    left = sorted(r.event_id for r in ledger.filter_processed(df, marks, now).collect())
    assert left == ["E1", "E3"]
    store = spark.sql("SELECT 'a' AS event_id, 1 AS v, 5 AS processed_at UNION ALL SELECT 'b', 1, 5")
    batch = spark.sql("SELECT 'a' AS event_id, 2 AS v, 5 AS processed_at UNION ALL SELECT 'c', 2, 6")
    merged = {r.event_id: r.v for r in ledger.upsert_events(store, batch).collect()}
    assert merged == {"a": 2, "b": 1, "c": 2}
    none = df.limit(0)
    assert ledger.reconcile(df, df, none, none).first().status == "healthy"
    assert ledger.reconcile(none, none, none, df).first().status == "dead_letters"
    assert ledger.reconcile(none, none, none, none).first().status == "nothing_processed"


def test_ledger_of_kept_rows_shuffles_ids_that_come_again_only(spark, monkeypatch):
    """a row whose id is new and comes once goes through no sort and no exchange of whole rows."""
    now = F.expr("timestamp_ntz'2024-01-02 00:00:00'")
    rows = [dict(event_id=f"E{i}", arrival_time=f"2024-01-01T00:0{k}:00", amount=float(10 * i + k + 1)) for i in range(40) for k in range(1 + (i % 8 == 0) + (i % 16 == 0))]
    df = timed(flat(spark, *rows, dict(event_id="E0", arrival_time="2024-01-01T00:00:00", amount=1.0), dict(event_id=None, amount=2.0), dict(event_id=None, amount=3.0)))
    marks = spark.sql(
        "SELECT concat('E', id) AS event_id, timestamp_ntz'2024-01-01 00:00:01' AS processed_at FROM range(8, 60, 5) "
        "UNION ALL SELECT 'E3', timestamp_ntz'2024-01-01 00:00:00' UNION ALL SELECT 'E13', timestamp_ntz'2024-01-01 00:00:01' "
        "UNION ALL SELECT NULL, timestamp_ntz'2024-01-01 00:00:01'"
    )
    expected = sorted(map(tuple, ledger.filter_processed(df, marks, now).collect()), key=str)
    assert len(expected) == 34 and sum(r[0] is None for r in expected) == 1
    out = ledger.filter_kept(df, marks, now)
    whole, part = out._jdf.queryExecution().optimizedPlan().toString().split("Window [", 1)
    assert "LeftAnti" in whole and "LeftSemi" in part and out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == expected
    monkeypatch.setattr(ledger, "REPEATED_BYTES", -1)  # too many such ids to send out
    assert sorted(map(tuple, ledger.filter_kept(df, marks, now).collect()), key=str) == expected


def test_metric_guards_and_split(spark):
    scored = spark.createDataFrame([(0, 0.1), (1, 0.2)], "is_fraud int, fraud_score double")
    m = ml.evaluate(scored).first()
    assert (m.tp, m.fn, m.precision, m.recall, m.f1) == (0, 1, 0.0, 0.0, 0.0)
    one = spark.createDataFrame([(f"E{i}", int(i == 3)) for i in range(400)], "event_id string, is_fraud int")
    parts = ml.stratified_split(one)
    assert parts.where("is_fraud = 1 AND is_validation").count() == 1
    assert 50 < parts.where("is_validation").count() < 110
    weights = ml.class_weights(one).first()
    assert (weights.fraud, weights.legitimate, weights.positive_weight) == (1, 399, 399.0)
    lacking = ml.feature_frame(timed(flat(spark, dict(merchant_risk_score=None))), "managed").first()
    assert lacking.merchant_risk_score == 0.1 and lacking.rule_signal_score == 0.0


def test_training_orders_the_three_vectors(spark, tmp_path):
    vectors = [
        ("n", 0.15, 0, 1, 0, 0, 0, 1500.0, 0), ("r", 0.92, 2, 4, 0, 1, 0, 85000.0, 5),
        ("a", 0.88, 0, 1, 1, 1, 1, 450000.0, 14),
    ]
    rows = []
    for i in range(300):
        name, *v = vectors[i % 3] if i % 10 else vectors[1]
        label = 1 if name == "a" else int(name == "r" and i % 4 == 0)
        rows.append((f"E{i}", *[float(x) for x in v], label))
    ddl = "event_id string, " + ", ".join(f"{f} double" for f in FEATURES) + ", is_fraud int"
    data = ml.with_weights(ml.stratified_split(spark.createDataFrame(rows, ddl)))
    model = ml.train(data, ml.TreeParams(rounds=5, depth=3))
    ml.save_model(model, str(tmp_path / "m"))
    again = ml.load_model(str(tmp_path / "m"))
    probe = spark.createDataFrame([(n, *[float(x) for x in v], 0) for n, *v in vectors], ddl)
    s = {r.event_id: r.fraud_score for r in ml.score(probe, again).collect()}
    assert s["n"] < s["r"] < s["a"] and s["a"] > 0.5
    assert len(ml.importances(again)) == 5 and math.isclose(sum(g for _, g in ml.importances(again, 8)), 1.0)
    assert ml.auc(ml.score(data, again)) > 0.8


def test_dimension_join_same_result_salted(spark, monkeypatch):
    fact = spark.range(500).select("id", F.when(F.col("id") < 300, 1).otherwise(F.col("id") % 7).alias("k"))
    dim = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    small = storage.join_dimension(fact, dim, "k", F.col("id"))
    monkeypatch.setattr(storage, "BROADCAST_BYTES", -1)
    large = storage.join_dimension(fact, dim, "k", F.col("id"))
    key = lambda df: sorted((r.id, r.k, r.v if r.v is not None else -1) for r in df.collect())
    assert key(small) == key(large) and len(key(large)) == 500


def test_many_ids_are_sent_out_as_bits(spark, tmp_path, monkeypatch):
    """F4, F6, F7, F16: repeated or replaced ids whose files are small but that a driver can't hold well."""
    name = lambda i: F.concat(F.lit("EVT-"), F.lpad(i.cast("string"), 16, "0"))
    spark.range(0, 400_000, 2).select(name(F.col("id")).alias("event_id")).union(spark.sql("SELECT CAST(NULL AS string)")).write.parquet(str(tmp_path / "ids"))
    ids = spark.read.parquet(str(tmp_path / "ids"))
    rows = spark.range(0, 420_000, 7).select(F.when(F.col("id") % 1000 > 0, name(F.col("id"))).alias("event_id"), "id", (F.col("id") % 2 == 0).alias("known"))
    assert storage.planned_bytes(ids) <= silver.REPEATED_BYTES < storage.held_bytes(ids)
    hit, miss = silver.split_by_ids(rows, ids.where("event_id is not null"))
    for found in (hit, miss):
        assert found.columns == rows.columns
        assert not re.search(r"Broadcast.*event_id", found._jdf.queryExecution().executedPlan().toString())
    is_known = "event_id is not null and known and id < 400000"
    assert hit.where(f"not ({is_known})").count() == 0 and hit.count() == rows.where(is_known).count()
    assert miss.where(is_known).count() == 0 and hit.count() + miss.count() == rows.count()
    may, others = silver.sifted(rows, ids)
    assert others.where(f"event_id is null or {is_known}").count() == 0 and may.where("event_id is null").count() == rows.where("event_id is null").count()
    assert may.count() + others.count() == rows.count() and others.count() > 0.9 * rows.where("event_id is not null and not known").count()
    monkeypatch.setattr(silver, "MOST_BITMAPS", 1)  # crowded, and as right
    hit, miss = silver.split_by_ids(rows, ids.where("event_id is not null"))
    assert hit.count() == rows.where(is_known).count() and hit.count() + miss.count() == rows.count()
    assert all(x.count() == n for x, n in zip(silver.sifted(rows.limit(9), ids.limit(0)), (0, 9)))


def test_ids_in_small_files_are_not_broadcast_by_spark(spark, tmp_path):
    """F6, F7, F9 to F11, F13, F15: what earlier batches left is joined without a hint by the size of its files only."""
    marks = spark.range(300_000).select(F.concat(F.lit("E"), F.lpad("id", 16, "0")).alias("event_id"), F.expr("timestamp_ntz'2024-01-01 12:00:00'").alias("processed_at"))
    marks.write.parquet(str(tmp_path / "marks"))
    marks, now = spark.read.parquet(str(tmp_path / "marks")), F.expr("timestamp_ntz'2024-01-02 00:00:00'")
    assert storage.planned_bytes(marks.select("event_id")) < 8 << 20  # Spark's limit is 10 MB
    rows = timed(flat(spark, dict(event_id="E0000000000000007"), dict(event_id="E0000000000300000"), dict(event_id=None)))
    fresh = ledger.filter_processed(rows, marks, now)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {r.event_id for r in fresh.collect()} == {r.event_id for r in ledger.filter_kept(rows, marks, now).collect()} == {"E0000000000300000", None}


def test_a_tightly_packed_dimension_stays_off_the_driver(spark, tmp_path):
    """F1 to F17: files of a few MB may unpack to more than a driver holds; neither we nor Spark send them out."""
    path = str(tmp_path / "dim")
    spark.range(600_000).select(F.col("id").alias("k"), F.lit("a name that all the rows share").alias("v")).write.parquet(path)
    dim = spark.read.parquet(path)
    assert storage.planned_bytes(dim) < storage.BROADCAST_BYTES // 8 and storage.held_bytes(dim) > storage.BROADCAST_BYTES
    fact = spark.range(400).select("id", F.when(F.col("id") % 4 > 0, 7).when(F.col("id") % 8 > 0, F.col("id")).alias("k"))
    found = [join(fact, dim, "k", F.col("id")) for join in (storage.join_dimension, sketches.join_dimension_by_weight)]
    for rows in found:
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [k" in plan and not re.search(r"Broadcast.*\bv#", plan)
        assert rows.columns == ["k", "id", "v"] and rows.where("v is not null").count() == 350 and rows.count() == 400
    few = spark.createDataFrame([("a" * 1000, [1, 2], None)], "s string, a array<int>, n decimal(20,2)")
    assert 1000 < storage.held_bytes(few) < 1300 and storage.held_bytes(few.where("s = 'b'")) == 0


def test_copies_of_a_dimension_do_not_hang_on_joins_before(spark, monkeypatch):
    """F1 to F17: the planned size of a join is the product of its sides, which made 4,096 copies of the next dimension."""
    monkeypatch.setattr(storage, "BROADCAST_BYTES", -1)
    fact = spark.range(100_000).select("id", (F.col("id") % 7).alias("a"), (F.col("id") % 5).alias("b"))
    dims_ = {k: spark.range(50_000).select(F.col("id").alias(k), F.col("id").alias(f"v_{k}")) for k in "ab"}
    one = storage.join_dimension(fact, dims_["a"], "a", F.col("id"))
    two = storage.join_dimension(one, dims_["b"], "b", F.col("id"))
    assert storage.planned_bytes(one) > storage.SLICE_BYTES > storage.read_bytes(one)
    copies = re.findall(r"explode\((.*?)\)", two._jdf.queryExecution().optimizedPlan().toString())
    assert len(copies) == 2 and copies[0] == copies[1]
    assert two.where("v_a = a and v_b = b").count() == 100_000


def test_folders_are_written_without_a_sort(spark, tmp_path):
    """F4 to F11, F18: rows of a task aren't sorted by folder; the session's setting stays as it was."""
    before = spark.conf.get(storage.OPEN_WRITERS)
    rows = spark.range(3000).select("id", F.concat(F.lit("d"), F.pmod(F.xxhash64("id"), F.lit(100)).cast("string")).alias("day"))
    with storage.open_folders(spark):
        rows.write.partitionBy("day").parquet(str(tmp_path / "p"))  # more folders than stay open: the rest is sorted
    assert spark.conf.get(storage.OPEN_WRITERS) == before
    got = spark.read.parquet(str(tmp_path / "p")).select("id", "day").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, rows.collect()))
