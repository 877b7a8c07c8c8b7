"""The batch run on files, sources and sinks, and every query next to its twin."""

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import compare

from txnrisk.operators import dims, ml
from txnrisk.plans import lake, oracle, queries
from txnrisk.schema import GOLD_TABLES
from txnrisk.sources import files, sample_tables
from txnrisk.streaming import online

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="sample tables not present")


@pytest.fixture(scope="module")
def tx(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tx") / "t")
    sample_tables.transactions(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


@needs_tables
def test_run_conserves_rows_and_is_repeatable(spark, tx, tmp_path):
    bronze, out = str(tmp_path / "bronze"), str(tmp_path / "out")
    files.write_bronze(sample_tables.messages(tx), bronze, F.to_date("arrival_time"))
    assert len(list(Path(bronze).glob("run_id=*/year=*/month=*/day=*"))) > 20
    first = lake.run(spark, bronze, out, "2024-02-01T00:00:00", "r1")
    c = first.counts
    assert c["input"] == c["valid"] + c["corrupted"] + c["dead_letter"] == 1030
    assert c["output"] + c["duplicates_removed"] == c["valid"]
    assert spark.read.json(f"{out}/quarantine").count() == c["corrupted"]
    assert spark.read.text(f"{out}/dead_letters").count() == c["dead_letter"] == 2
    second = lake.run(spark, bronze, out, "2024-02-01T00:00:00", "r1")
    assert second == first and spark.read.json(f"{out}/quarantine").count() == c["corrupted"]
    assert all(lake.verify_gold(spark, f"{out}/gold").values())
    assert first.gold_rows["pipeline_run_summary"] == 1 and set(first.gold_rows) == set(GOLD_TABLES)
    assert lake.saved_query(spark, "peak_hours").count() == 5
    assert spark.table("silver_transactions").count() == c["output"]

    january = files.read_silver(spark, f"{out}/silver", "2024-01-03", "2024-01-05")
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan and 0 < january.count() < c["output"]
    # an increment replaces only its own days
    files.write_silver(january.where("day = 4").limit(1), f"{out}/silver", dynamic=True)
    days = {r.day: r["count"] for r in files.read_silver(spark, f"{out}/silver").groupBy("day").count().collect()}
    assert days[4] == 1 and len(days) > 20


@needs_tables
def test_catalog_tables(spark, tx, tmp_path):
    bronze, out = str(tmp_path / "bronze"), str(tmp_path / "out")
    files.write_bronze(sample_tables.messages(tx), bronze, F.to_date("arrival_time"))
    lake.run(spark, bronze, out, "2024-02-01T00:00:00")
    spark.sql("CREATE DATABASE IF NOT EXISTS risk_db")
    try:
        names = files.register_tables(spark, f"{out}/silver", f"{out}/gold", "risk_db")
        assert len(names) == 6
        total = spark.table("risk_db.silver_transactions").count()
        assert spark.table("risk_db.gold_pipeline_run_summary").first().silver_records_read == total > 0
    finally:
        spark.sql("DROP DATABASE risk_db CASCADE")


def test_empty_input_stops(spark, tmp_path):
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError):
        lake.bronze_to_silver(spark, str(tmp_path / "none"), str(tmp_path / "o"), "t", "r")


def test_raw_log_promotion_and_exports(spark, tmp_path):
    raw = tmp_path / "log.csv"
    raw.write_text(
        "step,type,amount,nameOrig,oldbalanceOrg,newbalanceOrig,nameDest,oldbalanceDest,newbalanceDest,isFraud,isFlaggedFraud\n"
        "1,PAYMENT,9839.64,C1,170136.0,160296.36,M1,0.0,0.0,0,0\n"
    )
    row = files.read_transactions_csv(spark, str(raw)).first()
    assert row.amount == 9839.64 and row.isFraud == 0

    src = tmp_path / "src/year=2024/month=01/day=05"
    src.mkdir(parents=True)
    (src / "a.txt").write_text('{"a": 1}\n{"a": \n')
    counts = files.promote_bronze(spark, str(tmp_path / "src"), str(tmp_path / "dst"))
    assert counts == {"uploaded": 1, "skipped": 1, "errors": 0}
    assert files.read_bronze(spark, str(tmp_path / "dst")).first().body == '{"a": 1}'
    assert list((tmp_path / "dst").glob("run_id=promoted/year=2024/month=01/day=05"))
    # Another source with days as plain folders adds its own; a run that repeats replaces its own.
    more = tmp_path / "other/2024/02/11/batch_id=3"
    more.mkdir(parents=True)
    (more / "b.txt").write_text('{"b": 2}\n')
    for _ in range(2):
        files.promote_bronze(spark, str(tmp_path / "other"), str(tmp_path / "dst"), "second")
    assert {r.body for r in files.read_bronze(spark, str(tmp_path / "dst")).collect()} == {'{"a": 1}', '{"b": 2}'}
    assert files.read_bronze(spark, str(tmp_path / "dst")).count() == 2
    assert files.sample_stream(files.read_bronze(spark, str(tmp_path / "src")), 1).count() == 1
    files.write_dims({"x": spark.range(3)}, str(tmp_path / "dims"), "csv")
    assert spark.read.csv(str(tmp_path / "dims/x"), header=True).count() == 3


@needs_tables
def test_training_export_has_label_first(spark, tx, tmp_path):
    split = ml.stratified_split(ml.feature_frame(tx))
    files.export_training(split, str(tmp_path / "x"))
    parts = [spark.read.csv(str(tmp_path / "x" / p)) for p in ("train", "validation")]
    assert sum(p.count() for p in parts) == 1000 and len(parts[0].columns) == 9
    assert {r._c0 for r in parts[1].select("_c0").distinct().collect()} == {"0", "1"}
    files.write_dims({"customers": dims.customers_dim(tx)}, str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "d/customers")).count() == 15


@needs_tables
def test_every_query_equals_its_twin(spark):
    con, twins = compare.connect(SF), oracle.all_twins()
    every = queries.all_queries()
    assert set(twins) <= set(every)
    wrong = {n: compare.differences(every[n](spark, SF), con, sql) for n, sql in twins.items()}
    assert {n: w for n, w in wrong.items() if w} == {}


def test_a_query_writes_the_tables_it_needs_only(spark, monkeypatch):
    """raw messages are read without Silver being written, transactions without messages."""
    done = []
    for name in ("transactions", "bronze", "silver"):
        monkeypatch.setattr(queries, f"build_{name}", lambda *args, name=name: done.append(name))
    monkeypatch.setattr(queries, "_WORKSPACES", {})
    first = queries.workspace(spark, "/nowhere", "tx")
    assert done == ["transactions"]
    assert queries.workspace(spark, "/nowhere", "bronze") is first and done == ["transactions", "bronze"]
    assert queries.workspace(spark, "/nowhere") is first and done == ["transactions", "bronze", "silver"]
    queries.workspace(spark, "/nowhere", "tx")
    queries.workspace(spark, "/elsewhere")
    assert done == ["transactions", "bronze", "silver"] * 2


@needs_tables
def test_transactions_shuffle_what_they_are_made_of(spark):
    """derived texts don't go through the history's shuffles, and dimensions are sent out once."""
    plan = sample_tables.transactions(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    before = plan[plan.index("Window ["):]  # what the shuffles of the history get
    assert "device_id" not in before and "ip_address" not in before and "c_custkey" not in plan


def test_messages_are_kept_compressed_and_read_alike(spark, tmp_path):
    path, line = str(tmp_path / "bronze"), '{"metadata": {"event_id": "E%04d"}, "payload": {"amount": 1.5, "type": "PAYMENT"}}'
    bodies = [line % i for i in range(3000)]
    files.write_bronze(spark.createDataFrame([(b,) for b in bodies], "body string"), path, F.lit("2024-01-02").cast("date"))
    size = sum(p.stat().st_size for p in (tmp_path / "bronze").rglob("part-*"))
    assert size < sum(map(len, bodies)) / 3
    assert sorted(r.body for r in files.read_bronze(spark, path).collect()) == bodies
    target, other = str(tmp_path / "promoted"), str(tmp_path / "seen")
    assert files.promote_bronze(spark, path, target)["uploaded"] == len(bodies)
    assert sorted(r.body for r in files.read_bronze(spark, target).collect()) == bodies
    online.run_to_table(online.read_stream(spark, path), other).awaitTermination()
    assert sorted(r.body for r in spark.read.parquet(other).select("body").collect()) == bodies
