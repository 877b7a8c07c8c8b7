"""Streams against their batch twins, in one and in many micro-batches."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from txnrisk.operators import envelope, history, rules
from txnrisk.sources import files
from txnrisk.streaming import online

T0 = datetime(2024, 1, 1)


def body(i, customer, t, risk=0.1):
    meta = {"event_id": f"E{i:03d}", "event_time": t.isoformat(), "arrival_time": t.isoformat(), "schema_version": "v1"}
    pay = {"type": "PAYMENT", "amount": 5.0, "nameOrig": customer, "merchant_risk_score": risk, "isFraud": 0}
    return json.dumps({"metadata": meta, "payload": pay})


@pytest.fixture(scope="module")
def bodies():
    rng, t, out = random.Random(4), T0, []
    for i in range(60):
        t += timedelta(seconds=rng.choice([0, 20, 40, 400]))
        out.append(body(i, "HOT" if rng.random() < 0.6 else rng.choice("AB"), t, 0.9 if i % 9 == 0 else 0.1))
    return out


def write(path, parts):
    path.mkdir(parents=True)
    for i, lines in enumerate(parts):
        f = path / f"part-{i:03d}.txt"
        f.write_text("\n".join(lines) + "\n")
        stamp = 1_700_000_000 + i  # files are taken in the order of their times
        import os

        os.utime(f, (stamp, stamp))
    return str(path)


def job(spark, source, base, per_batch, now="2024-01-02 00:00:00"):
    stream = online.read_stream(spark, source, max_files=per_batch)
    online.OnlineJob(base, now=now).start(stream).awaitTermination()


def result(spark, base):
    rows = online.scored_events(spark, base).collect()
    return {r.event_id: (r.velocity_5min_live, r.velocity_1hour_live, tuple(r.triggered_rules), r.risk_score) for r in rows}


def test_online_job_equals_batch_in_one_and_in_many(spark, tmp_path, bodies):
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    rows = envelope.parse_envelope(df, fallback=F.lit(None).cast("timestamp_ntz"))
    scored = rules.apply_rules(history.velocity_live(rows, online.VELOCITY_WINDOWS))
    want = {
        r.event_id: (r.velocity_5min_live, r.velocity_1hour_live, tuple(r.triggered_rules), r.risk_score)
        for r in scored.collect()
    }
    assert max(v[0] for v in want.values()) >= 5
    extra = ["{broken", json.dumps({"metadata": {"event_id": ""}, "payload": {}}), bodies[3]]
    parts = [bodies[:20], bodies[20:40], bodies[40:] + extra]
    source = write(tmp_path / "in", parts)
    job(spark, source, str(tmp_path / "one"), 100)
    job(spark, source, str(tmp_path / "many"), 1)
    assert result(spark, str(tmp_path / "one")) == want
    assert result(spark, str(tmp_path / "many")) == want
    stats = spark.read.json(str(tmp_path / "many/stats")).agg(
        *[F.sum(c).alias(c) for c in ("messages", "processed", "skipped", "errors", "flagged")]).first()
    assert tuple(stats) == (63, 60, 2, 1, sum(1 for v in want.values() if v[2]))
    run = online.run_statistics(spark, str(tmp_path / "many")).first()
    assert (run.batches, run.messages, run.flagged) == (3, 63, stats.flagged) and run.messages_per_second > 0
    base = tmp_path / "many"
    assert spark.read.text(str(base / "dead_letters")).select("value").collect()[0].value == "{broken"
    assert spark.read.option("recursiveFileLookup", "true").text(str(base / "bronze")).count() == 60
    assert spark.read.json(str(base / "alerts")).count() == sum(1 for v in want.values() if v[2])
    # a batch that runs again writes the same
    again = online.OnlineJob(str(base), now="2024-01-02 00:00:00")
    again.process(spark.createDataFrame([(b,) for b in bodies[20:40]], "body string"), 1)
    assert result(spark, str(base)) == want
    assert spark.read.parquet(str(base / "ledger")).count() == 60
    again.expire(spark, "2024-01-02", "2024-01-02", "2024-01-03")
    assert not list((base / "times").glob("*/event_date=*")) and not list((base / "ledger").glob("*/processed_date=*"))


def test_a_batch_that_runs_again_after_midnight_keeps_its_places(spark, tmp_path, bodies):
    df, base = spark.createDataFrame([(b,) for b in bodies[:5]], "body string"), str(tmp_path)
    online.OnlineJob(base, now="2024-01-02 23:59:59").process(df, 0)
    online.OnlineJob(base, now="2024-01-03 00:00:09").process(df, 0)
    assert spark.read.parquet(f"{base}/ledger").count() == spark.read.parquet(f"{base}/events").count() == 5
    assert spark.read.option("recursiveFileLookup", "true").text(f"{base}/bronze").count() == 5
    assert files.promote_bronze(spark, f"{base}/bronze", f"{base}/promoted") == {"uploaded": 5, "skipped": 0, "errors": 0}


def test_bodies_are_stored_without_going_through_the_history(spark, tmp_path, bodies, monkeypatch):
    """the history's shuffles get no bodies, and those of fresh events are stored all the same."""
    seen, real = [], online.OnlineJob._score
    monkeypatch.setattr(online.OnlineJob, "_score", lambda self, fresh, k: seen.append(fresh.columns) or real(self, fresh, k))
    work = online.OnlineJob(str(tmp_path), now="2024-01-02 00:00:00")
    for k, part in enumerate((bodies[:12], bodies[8:20] + bodies[15:17])):
        work.process(spark.createDataFrame([(b,) for b in part], "body string"), k)
    assert len(seen) == 2 and all("body" not in columns and "event_id" in columns for columns in seen)
    kept = spark.read.option("recursiveFileLookup", "true").text(str(tmp_path / "bronze"))
    assert sorted(r.value for r in kept.collect()) == sorted(bodies[:20]) and len(result(spark, str(tmp_path))) == 20


def test_a_far_off_event_time_does_not_open_the_store(spark, tmp_path, bodies):
    base = str(tmp_path)
    far = body(900, "HOT", T0 - timedelta(days=9000))
    online.OnlineJob(base, now="2024-01-02 00:00:00").process(spark.createDataFrame([(b,) for b in bodies[:30]], "body string"), 0)
    online.OnlineJob(base, now="2024-01-02 00:00:00").process(spark.createDataFrame([(b,) for b in [*bodies[30:], far]], "body string"), 1)
    got = result(spark, base)
    assert len(got) == 61 and got["E900"][0] == 1
    days = online.days_of(spark.sql("SELECT DATE'2024-01-01' AS d UNION ALL SELECT DATE'1999-05-12' UNION ALL SELECT NULL"), "d")
    assert len(days) == 2 and online.days_of(spark.sql("SELECT date_add(DATE'2024-01-01', cast(id as int)) AS d FROM range(9)"), "d", 8) is None


def test_consumer_profile_uses_the_given_velocity(spark, tmp_path):
    fast = json.loads(body(1, "X", T0))
    fast["payload"]["transaction_velocity_5min"] = 6
    lines = [json.dumps(fast), body(2, "X", T0), json.dumps({"metadata": {}, "payload": {}})]
    source, base = write(tmp_path / "in", [lines]), str(tmp_path / "out")
    online.OnlineJob(base, "consumer", "2024-01-02 00:00:00").start(online.read_stream(spark, source)).awaitTermination()
    got = {r.event_id: r.triggered_rules for r in online.scored_events(spark, base).collect()}
    assert got == {"E001": ["HIGH_VELOCITY_5MIN"], "E002": []}
    alert = spark.read.json(f"{base}/alerts").collect()
    assert len(alert) == 1 and alert[0].type == "PAYMENT" and alert[0].velocity_5min == 6
    assert spark.read.text(f"{base}/dead_letters").count() == 1


def test_out_of_order_events_see_what_has_arrived(spark, tmp_path):
    late, early = body(1, "X", T0), body(2, "X", T0 + timedelta(seconds=60))
    source = write(tmp_path / "in", [[early], [late]])
    job(spark, source, str(tmp_path / "out"), 1)
    got = {k: v[0] for k, v in result(spark, str(tmp_path / "out")).items()}
    assert got == {"E002": 1, "E001": 1}


def test_dedup_and_sliding_counts_on_a_stream(spark, tmp_path, bodies):
    source = write(tmp_path / "in", [bodies[:30], bodies[25:]])
    stream = online.parse_stream(online.read_stream(spark, source, max_files=1))
    online.run_to_table(online.dedup_stream(stream).select("event_id"), str(tmp_path / "d")).awaitTermination()
    ids = [r.event_id for r in spark.read.parquet(str(tmp_path / "d")).collect()]
    assert len(ids) == 60 == len(set(ids))
    counts = online.sliding_counts(online.with_lateness(stream))
    online.updates_to_table(counts, str(tmp_path / "s")).awaitTermination()
    done = online.newest_rows(spark, str(tmp_path / "s"), ["customer_id", "window_start"])
    batch = online.sliding_counts(
        online.parse_stream(spark.createDataFrame([(b,) for b in bodies[:30] + bodies[25:]], "body string"))
    )
    key = lambda df: {(r.customer_id, str(r.window_start)): r.events for r in df.collect()}
    assert key(done) == key(batch)


def test_incremental_silver_loses_no_message(spark, tmp_path, bodies):
    odd = ["{broken", json.dumps({"metadata": {"event_id": ""}, "payload": {}}), json.dumps({"metadata": {}, "payload": {"amount": 1}})]
    source = write(tmp_path / "in", [bodies[:10] + odd, bodies[5:12] + odd[:1]])
    work = online.IncrementalSilver(str(tmp_path / "inc"), "t")
    work.start(online.read_stream(spark, source, max_files=1)).awaitTermination()
    base = tmp_path / "inc"
    assert spark.read.parquet(str(base / "silver")).count() == 12
    bad = spark.read.json(str(base / "quarantine"))
    assert bad.count() == 2 and all("missing_event_id" in r.reasons for r in bad.collect())
    assert spark.read.text(str(base / "dead_letters")).count() == 2
    sums = spark.read.json(str(base / "counts")).agg(*[F.sum(c).alias(c) for c in ("input", "output", "repeated", "corrupted", "dead_letter")]).first()
    assert tuple(sums) == (21, 12, 5, 2, 2)


def test_incremental_silver_takes_new_files_once(spark, tmp_path, bodies):
    source = write(tmp_path / "in", [bodies[:30]])
    work = online.IncrementalSilver(str(tmp_path / "inc"), "t")
    work.start(online.read_stream(spark, source)).awaitTermination()
    (tmp_path / "in/part-900.txt").write_text("\n".join(bodies[20:]) + "\n")
    work.start(online.read_stream(spark, source)).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "inc/silver"))
    assert out.count() == 60 and out.select("event_id").distinct().count() == 60
    work.start(online.read_stream(spark, source)).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "inc/silver")).count() == 60


def test_stream_static_enrichment(spark, tmp_path, bodies):
    source = write(tmp_path / "in", [bodies])
    customers = spark.createDataFrame([("HOT", "US", "High")], "customer_id string, home_country string, risk_profile string")
    merchants = spark.createDataFrame([("M", "Food")], "merchant_id string, merchant_category string")
    rows = online.parse_stream(online.read_stream(spark, source)).select("event_id", "customer_id", "merchant_id")
    online.run_to_table(online.enrich_with_dims(rows, customers, merchants), str(tmp_path / "e")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "e"))
    assert got.count() == 60 and got.where("home_country = 'US'").count() == got.where("customer_id = 'HOT'").count() > 0


def test_incremental_silver_compares_ids_without_shuffling_rows(spark, tmp_path, bodies, monkeypatch):
    """conservation (F9): whole Silver rows were shuffled and sorted to be told from those of earlier loads."""
    work, seen, write_batch = online.IncrementalSilver(str(tmp_path / "inc"), "t"), [], online.write_batch
    monkeypatch.setattr(online, "write_batch", lambda df, path, *more: (seen.append(df) if path.endswith("/silver") else None, write_batch(df, path, *more)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for k, part in enumerate((bodies[:10], bodies[5:12])):
            work.process(spark.createDataFrame([(b,) for b in part], "body string"), k)
        assert "SortMergeJoin" not in seen[-1]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    ids = [r.event_id for r in spark.read.parquet(str(tmp_path / "inc/silver")).collect()]
    assert len(ids) == len(set(ids)) == 12
