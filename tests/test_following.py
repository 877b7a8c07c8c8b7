"""What follows its input: late rows of streams, keyed state with expiry, the event store, Gold from partial sums."""

import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from txnrisk.operators import gold as G
from txnrisk.operators import dims, gold_parts, history, sketches, store
from txnrisk.operators.store import BITS, BUCKETS, EventStore
from txnrisk.plans import lake
from txnrisk.streaming import late, online, ordered, state

T0 = datetime(2024, 1, 1)
EVENTS = "event_id string, customer_id string, event_time timestamp_ntz, arrival_time timestamp_ntz"


def event(i, hours, customer="A", wait=0):
    t = T0 + timedelta(hours=hours)
    return (f"E{i}", customer, t, t + timedelta(hours=wait))


# ---------------------------------------------------------------- late rows


def test_late_first_deliveries_are_kept_and_counted(spark, tmp_path):
    job = late.LateAwareDedup(str(tmp_path))
    batches = [
        [event(1, 0), event(2, 1), event(2, 1)],
        [event(3, 100), event(2, 2)],  # 2 again, within the delay of its first delivery
        [event(4, 30), event(5, 101), event(6, 50), event(3, 101), event(2, 3)],  # 4 and 6 are late and new, 2 is late and known
    ]
    for k, rows in enumerate(batches):
        job.process(spark.createDataFrame(rows, EVENTS), k)
    got = {(r.event_id, r.late) for r in late.first_deliveries(spark, job.base).collect()}
    assert sorted(got) == [("E1", False), ("E2", False), ("E3", False), ("E4", True), ("E5", False), ("E6", True)]
    record = {r.batch_id: (r.input, r.output, r.late) for r in late.batch_record(spark, job.base).collect()}
    assert record == {0: (3, 2, 0), 1: (2, 1, 0), 2: (5, 3, 2)}
    before = sorted(map(str, late.first_deliveries(spark, job.base).collect()))
    job.process(spark.createDataFrame(batches[1], EVENTS), 1)  # again, in its place
    assert sorted(map(str, late.first_deliveries(spark, job.base).collect())) == before


def test_late_rows_without_a_time_or_of_an_empty_batch(spark, tmp_path):
    job = late.LateAwareDedup(str(tmp_path))
    job.process(spark.createDataFrame([event(1, 0)], EVENTS), 0)
    job.process(spark.createDataFrame([], EVENTS), 1)
    job.process(spark.createDataFrame([("E9", "A", None, None), ("E9", "A", None, None)], EVENTS), 2)
    assert sorted((r.event_id, r.late) for r in late.first_deliveries(spark, job.base).collect()) == [("E1", False), ("E9", False)]
    assert late.batch_record(spark, job.base).agg(F.sum("input")).first()[0] == 3


def test_late_counts_add_up_to_the_batch_result(spark, tmp_path):
    rng = random.Random(1)
    rows = [event(i, rng.randrange(100) + rng.random(), rng.choice("AB")) for i in range(80)]
    job = late.LateAwareCounts(str(tmp_path))
    for k in range(4):
        job.process(spark.createDataFrame(rows[20 * k : 20 * k + 20], EVENTS), k)
    got = {(r.customer_id, r.window_start): (r.events, r.late_events) for r in late.total_counts(spark, job.base).collect()}
    whole = online.sliding_counts(spark.createDataFrame(rows, EVENTS)).collect()
    assert {k: v[0] for k, v in got.items()} == {(r.customer_id, r.window_start): r.events for r in whole}
    assert 0 < sum(v[1] for v in got.values()) < sum(v[0] for v in got.values())


def test_late_counts_are_written_once_per_slide_not_once_per_window(spark, tmp_path):
    job = late.LateAwareCounts(str(tmp_path))
    for k, hour in enumerate((30, 1)):
        job.process(spark.createDataFrame([event(10 * k + i, hour + i / 60, "A") for i in range(10)], EVENTS), k)
    parts = spark.read.parquet(job.path("counts"))
    assert sorted((str(r.slot)[11:16], r.events, r.late) for r in parts.collect()) == [
        ("01:00", 5, "true"), ("01:05", 5, "true"), ("06:00", 5, "false"), ("06:05", 5, "false")]
    assert late.total_counts(spark, job.base).agg(F.sum("events"), F.sum("late_events")).first()[:] == (240, 120)


def test_late_job_on_a_stream_takes_each_file_once(spark, tmp_path):
    source, job = str(tmp_path / "in"), late.LateAwareDedup(str(tmp_path / "out"))
    for k, rows in enumerate([[event(1, 0)], [event(2, 90)], [event(3, 1), event(1, 0)]]):
        spark.createDataFrame(rows, EVENTS).write.mode("append").parquet(source)
        job.start(spark.readStream.schema(EVENTS).parquet(source)).awaitTermination()
    assert sorted((r.event_id, r.late) for r in late.first_deliveries(spark, job.base).collect()) == [("E1", False), ("E2", False), ("E3", True)]


# ---------------------------------------------------------------- keyed state


def run_state(spark, tmp_path, parts, **options):
    source, out, query = str(tmp_path / "in"), str(tmp_path / "out"), None
    for rows in parts:
        spark.createDataFrame(rows, EVENTS).write.mode("append").parquet(source)
        stream = spark.readStream.schema(EVENTS).parquet(source)
        query = state.run(spark, state.stateful_velocity(stream, {"v5": 300, "v1h": 3600}, **options), out)
    return {r.event_id: (r.v5, r.v1h) for r in spark.read.parquet(out).collect()}, query


@pytest.mark.parametrize("slice_seconds", [3600, 900])
def test_state_counts_like_the_batch_result(spark, tmp_path, slice_seconds):
    rng, t, rows = random.Random(3), 0.0, []
    for i in range(90):
        t += rng.choice([0, 0.01, 0.05, 0.4, 1.5])
        rows.append(event(i, t, "HOT" if rng.random() < 0.6 else rng.choice(["A", None])))
    cut = [0, 25, 60, 90]
    parts = [[r for r in rows if rows[a][2] <= r[2] and (b == 90 or r[2] < rows[b][2])] for a, b in zip(cut, cut[1:])]
    got, _ = run_state(spark, tmp_path, parts, slice_seconds=slice_seconds)
    want = history.velocity_live(spark.createDataFrame(rows, EVENTS), {"v5": 300, "v1h": 3600})
    assert got == {r.event_id: (r.v5, r.v1h) for r in want.collect()}


def test_state_is_gone_two_hours_later(spark, tmp_path):
    crowd = [event(i, 0.01 * i, f"C{i}") for i in range(60)]
    later = [[event(100 + k, 4 + 3 * k, "Z")] for k in range(3)]
    _, first = run_state(spark, tmp_path / "a", [crowd])
    _, last = run_state(spark, tmp_path / "b", [crowd, *later])
    rows = lambda q: max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"])
    assert rows(first) >= 120  # own slice and the next
    final = [p["stateOperators"][0]["numRowsTotal"] for p in last.recentProgress if p["stateOperators"]][-1]
    assert final <= 12


def test_state_has_as_many_keys_as_buckets_not_as_customers(spark, tmp_path):
    crowd = [event(i, 0.001 * (i // 2), f"C{i % 400}") for i in range(800)]
    got, query = run_state(spark, tmp_path, [crowd], buckets=4)
    want = history.velocity_live(spark.createDataFrame(crowd, EVENTS), {"v5": 300, "v1h": 3600})
    assert got == {r.event_id: (r.v5, r.v1h) for r in want.collect()}
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) < 60


# ---------------------------------------------------------------- event store

STORE = "event_id string, day date, score int, version int"


def files_below(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_store_rewrites_only_the_days_it_touches(spark, tmp_path):
    kept = EventStore(str(tmp_path))
    day = lambda k: date(2024, 1, 1 + k)
    first = [(f"E{i}", day(i % 10), i, 0) for i in range(200)]
    assert kept.upsert(spark.createDataFrame(first, STORE), 0, version="version").count() == 0
    before = files_below(tmp_path / "data")
    second = [("E3", day(3), 1000, 1), ("E14", day(7), 2000, 1), ("N1", day(12), 5, 1), ("E3", day(3), 999, 0)]
    replaced = kept.upsert(spark.createDataFrame(second, STORE), 1, version="version").collect()
    assert sorted((r.event_id, r.day, r.score) for r in replaced) == [("E14", day(4), 14), ("E3", day(3), 3)]
    after = files_below(tmp_path / "data")
    assert {k: v for k, v in after.items() if "batch_id=0" in k} == before
    written = {k.split("/")[1] for k in after if "batch_id=1" in k}
    assert {f"day=2024-01-{d:02d}" for d in (4, 5, 8, 13)} == written  # its own days, and the one that 14 left
    schema = spark.createDataFrame([], STORE).schema
    want = {f"E{i}": (day(i % 10), i) for i in range(200)} | {"E3": (day(3), 1000), "E14": (day(7), 2000), "N1": (day(12), 5)}
    assert {r.event_id: (r.day, r.score) for r in kept.current(spark, schema).collect()} == want
    # The batch again: the same content. Then expiry, with a batch that has nothing for the days that go.
    kept.upsert(spark.createDataFrame(second, STORE), 1, version="version")
    assert {r.event_id: (r.day, r.score) for r in kept.current(spark, schema).collect()} == want
    kept.upsert(spark.createDataFrame([("N2", day(12), 6, 2), ("N3", day(0), 7, 2)], STORE), 2, "2024-01-06", "version")
    want = {k: v for k, v in want.items() if v[0] >= date(2024, 1, 6)} | {"N2": (day(12), 6)}
    assert {r.event_id: (r.day, r.score) for r in kept.current(spark, schema).collect()} == want
    assert kept.vacuum(spark) > 0
    assert {r.event_id: (r.day, r.score) for r in kept.current(spark, schema).collect()} == want
    with pytest.raises(ValueError):
        kept.upsert(spark.createDataFrame([("N4", None, 1, 3)], STORE), 3, version="version")


def test_store_bitmaps_name_every_day_that_holds_an_id(spark, tmp_path):
    kept = EventStore(str(tmp_path))
    rows = [(f"E{i}", date(2024, 1, 1 + i % 3), i, 0) for i in range(3000)]
    kept.upsert(spark.createDataFrame(rows, STORE), 0, version="version")
    asked = kept.may_hold(spark.createDataFrame(rows, STORE).select("event_id"), kept.manifest(spark)).collect()
    named = {(r.event_id, r.day) for r in asked}
    assert named >= {(i, d) for i, d, *_ in rows} and len(named) < 3100
    assert kept.manifest(spark).where(f"bucket >= {BUCKETS} or octet_length(bits) <> {BITS // 8}").count() == 0


# ---------------------------------------------------------------- Gold from partial sums


def silver_rows(rng, n, first=0):
    out = []
    for i in range(first, first + n):
        risk = rng.choice([None, round(rng.random(), 3)])
        out.append((
            f"EVT-{i:06d}", rng.choice(["C1", "C2", "C3", None]), rng.choice(["Family", None]), "US", rng.choice(["M1", "M2", None]),
            rng.choice(["Food", None]), rng.choice(["LOW", "HIGH"]), T0 + timedelta(minutes=rng.randrange(9000)), "Normal", rng.randrange(2),
            round(rng.uniform(1, 500), 2), round(rng.uniform(1, 900), 2), risk, rng.randrange(2), rng.randrange(2), rng.randrange(2), 0,
            rng.randrange(9), rng.randrange(50), rng.choice([None, rng.randrange(8)]),
        ))
    return out


SILVER = (
    "event_id string, customer_id string, customer_segment string, customer_country string, merchant_id string, merchant_category string, "
    "merchant_risk_tier string, event_time timestamp_ntz, traffic_period string, balance_mismatch_flag int, amount double, lifetime_spend double, "
    "merchant_risk_score double, is_fraud int, geo_anomaly_flag int, new_device_flag int, duplicate_event_flag int, rule_signal_score int, "
    "lifetime_tx_count bigint, velocity_5min int"
)


def test_gold_from_parts_equals_gold_from_all_rows(spark, tmp_path):
    rng = random.Random(8)
    kept, current = gold_parts.GoldParts(str(tmp_path)), {}
    loads = [silver_rows(rng, 120), silver_rows(rng, 60, 90), silver_rows(rng, 40, 20)]  # each corrects events of the one before
    for k, rows in enumerate(loads):
        kept.load(spark.createDataFrame(rows, SILVER), k)
        current |= {r[0]: r for r in rows}
    kept.load(spark.createDataFrame(loads[2], SILVER), 2)  # a load that runs again
    silver = spark.createDataFrame(list(current.values()), SILVER)
    frames = lake.gold_frames(silver, "now", "here", "risk")
    for name, want in frames.items():
        got = kept.table(spark, name, "now", "here", "risk")
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
    assert G.HIGH_RISK and kept.maxima(spark).count() > 0


# ---------------------------------------------------------------- ordered release and scores on a stream


def test_released_rows_have_the_features_of_the_batch_job(spark, tmp_path):
    rng = random.Random(5)
    rows = sorted((event(i, rng.randrange(60) * 0.04, rng.choice("AB")) for i in range(80)), key=lambda r: r[2])
    shuffled = sorted(rows, key=lambda r: (r[2] + timedelta(minutes=rng.randrange(60)), r[0]))
    job = ordered.OrderedRelease(str(tmp_path), {"v5": 300, "v1h": 3600}, 3600)
    for k in range(4):
        job.process(spark.createDataFrame(shuffled[20 * k : 20 * k + 20], EVENTS), k)
    before = ordered.released(spark, job.base).count()
    assert 0 < before < 80
    late_row = event(900, -5)
    job.process(spark.createDataFrame([late_row, ("E901", "A", None, None)], EVENTS), 4)
    job.process(spark.createDataFrame([], EVENTS), 5, flush=True)
    job.process(spark.createDataFrame([], EVENTS), 5, flush=True)  # again, in its place
    got = {r.event_id: (r.v5, r.v1h) for r in ordered.released(spark, job.base).collect()}
    want = history.velocity_live(spark.createDataFrame(rows, EVENTS), {"v5": 300, "v1h": 3600})
    assert got == {r.event_id: (r.v5, r.v1h) for r in want.collect()}
    assert sorted(r.event_id for r in ordered.late_rows(spark, job.base).collect()) == ["E900", "E901"]


# ---------------------------------------------------------------- sketches


def test_sketches_merge_over_ranges(spark):
    rng, rows = random.Random(6), []
    for i in range(4000):
        t = T0 + timedelta(days=rng.randrange(20), seconds=rng.randrange(80000))
        customer = f"C{rng.randrange(300) + (150 if t >= T0 + timedelta(days=10) else 0)}"
        rows.append((t, t + timedelta(seconds=rng.expovariate(1 / 60)), customer, "M1" if rng.random() < 0.4 else f"M{rng.randrange(2, 5000)}"))
    silver = spark.createDataFrame(rows, "event_time timestamp_ntz, arrival_time timestamp_ntz, customer_id string, merchant_id string")
    ranges = {"all": ("2024-01-01", "2024-01-31"), "early": ("2024-01-01", "2024-01-10"), "late": ("2024-01-11", "2024-01-31")}
    days = sketches.day_sketches(silver)
    assert days.count() == 20
    checks = sketches.rank_checks(sketches.latency_by_range(days, ranges), silver, ranges).collect()
    assert len(checks) == 3 and all(r.p50_right and r.p95_right and r.p99_right and r.events == r.counted for r in checks)
    one = sketches.returning_customers(days, ranges["early"], ranges["late"]).first()
    early, late_ = ({r[2] for r in rows if (r[0] < T0 + timedelta(days=10)) == first} for first in (True, False))
    assert (one.returning, one.new, one.lost, one.any) == (len(early & late_), len(late_ - early), len(early - late_), len(early | late_))
    heavy = {r.merchant_id: r.n for r in sketches.heavy_keys(silver, "merchant_id").collect()}
    assert heavy == {"M1": sum(r[3] == "M1" for r in rows)}
    nulls = spark.createDataFrame([(None,)] * 50 + [("",)] * 30 + [(f"k{i}",) for i in range(900)], "k string")
    assert {r.k: r.n for r in sketches.heavy_keys(nulls, "k", 0.02).collect()} == {None: 50, "": 30}
    with pytest.raises(ValueError):
        sketches.heavy_keys(nulls, "k", 0.0001)


def test_only_heavy_keys_are_salted(spark, monkeypatch):
    fact = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(600)] + [(601, None)], "n long, k string")
    dim = spark.createDataFrame([("hot", "H"), *[(f"k{i}", f"v{i}") for i in range(0, 500)]], "k string, v string")
    want = sorted(map(str, fact.join(dim, "k", "left").select("n", "k", "v").collect()))
    plain = sketches.join_dimension_by_weight(fact, dim, "k", F.col("n"))
    assert "Broadcast" in plain._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(sketches, "BROADCAST_BYTES", 0)
    salted = sketches.join_dimension_by_weight(fact, dim, "k", F.col("n"))
    assert sorted(map(str, salted.select("n", "k", "v").collect())) == want and salted.columns == ["k", "n", "v"]
    sliced = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in sliced


# ---------------------------------------------------------------- chargebacks


def test_filed_chargebacks_use_what_was_observed(spark):
    rows = [
        ("a", "C", "S", T0, 5.0, 1, "Filed", "7"), ("b", "C", "S", T0, 2.5, 0, "Filed", "30.5"), ("c", "C", "S", T0, 1.0, 0, "Filed", "-1"),
        ("d", "C", None, T0, None, 1, "Filed", "soon"), ("e", "C", "S", T0, 1.0, 1, "None", "3"), ("f", "C", "S", None, 1.0, 1, "Filed", "NaN"),
    ]
    ddl = "event_id string, customer_id string, customer_segment string, event_time timestamp_ntz, amount double, is_fraud int, chargeback_status string, chargeback_delay_days string"
    filed = dims.filed_chargebacks(spark.createDataFrame(rows, ddl))
    got = {r.transaction_id: (r.days_to_dispute, str(r.filed_on), r.is_friendly) for r in filed.collect()}
    assert got == {"a": (7.0, "2024-01-08", 0), "b": (30.5, "2024-01-31", 1), "c": (None, "None", 1), "d": (None, "None", 0), "f": (None, "None", 0)}
    report = {(r.customer_segment, r.delay_class): (r.chargebacks, r.friendly, r.amount) for r in dims.chargeback_report(filed).collect()}
    assert report == {("S", "week"): (1, 0, 5.0), ("S", "quarter"): (1, 1, 2.5), ("S", "unknown"): (2, 1, 2.0), (None, "unknown"): (1, 0, None)}


def test_store_compares_ids_without_shuffling_rows(spark, tmp_path, monkeypatch):
    """kept_* (F8): whole rows of the store were shuffled and sorted by id to find the replaced ones."""
    kept, seen = EventStore(str(tmp_path)), []
    monkeypatch.setattr(store, "by_partition", lambda df, by: seen.append(df) or df)
    rows = lambda k, ids: spark.createDataFrame([(f"e{i}", date(2024, 1, 1 + i % 3), k, i) for i in ids], "event_id string, day date, processed_at int, v int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept.upsert(rows(0, range(30)), 0)
        replaced = kept.upsert(rows(1, [3, 4, 4, 40]), 1)
        assert sorted(r.event_id for r in replaced.collect()) == ["e3", "e4"]
        assert "Exchange hashpartitioning" not in seen[-1]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    got = {r.event_id: r.processed_at for r in kept.current(spark, rows(0, [0]).schema).collect()}
    assert got == {f"e{i}": int(i in (3, 4)) for i in range(30)} | {"e40": 1}
