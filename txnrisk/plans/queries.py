"""The registered queries: every operator on the sample tables.

Three tables are written once per application and source folder, when a query first
needs them, and read back by the queries that start there, as the jobs of a lake do:
enhanced transactions, raw messages, and Silver with its quarantine. Queries about a
feature itself compute it from the given tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.functions import columns as C
from txnrisk.operators import dims, envelope, gold_parts, history, ledger, ml, quality, rules, sessions, silver, sketches, store
from txnrisk.plans import features, lake, training
from txnrisk.schema import LABEL, NULLABLE_COLUMNS, SILVER_FIELDS
from txnrisk.sources import files, sample_tables
from txnrisk.storage import new_path
from txnrisk.streaming import late, online, ordered, scoring, state

RUN_TS = "2024-02-01T00:00:00"
LEDGER_NOW = "2024-01-16 00:00:00"
STORE_NOW = "2024-01-20 00:00:00"
UPSERT_FROM = "2024-01-15 00:00:00"
SMALL_AMOUNT = 10.0
DAY = 86400
OVERSIZE_LIMIT = 4096

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Workspace:
    tx: str
    bronze: str
    out: str
    written: set[str] = field(default_factory=set)


_WORKSPACES: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str, last: str = "silver") -> Workspace:
    """Paths of the written tables; each is made from the one before. Those up to ``last``
    (``tx``, ``bronze``, ``silver``) are written on first use in an application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WORKSPACES:
        base = new_path(spark, "sample-" + hashlib.md5(sf_dir.encode()).hexdigest()[:8])
        _WORKSPACES[key] = Workspace(f"{base}/tx", f"{base}/bronze", f"{base}/lake")
    space = _WORKSPACES[key]
    builds = {
        "tx": lambda: build_transactions(spark, sf_dir, space), "bronze": lambda: build_bronze(spark, space),
        "silver": lambda: build_silver(spark, space),
    }
    for name, build in builds.items():
        if name not in space.written:
            build()
            space.written.add(name)
        if name == last:
            break
    return space


def build_transactions(spark: SparkSession, sf_dir: str, space: Workspace) -> None:
    sample_tables.transactions(spark, sf_dir).write.mode("overwrite").parquet(space.tx)


def build_bronze(spark: SparkSession, space: Workspace) -> None:
    bodies = sample_tables.messages(spark.read.parquet(space.tx))
    files.write_bronze(bodies, space.bronze, F.to_date("arrival_time"))


def build_silver(spark: SparkSession, space: Workspace) -> None:
    lake.bronze_to_silver(spark, space.bronze, space.out, RUN_TS, "sample")


def tx_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(workspace(spark, sf_dir, "tx").tx)


def bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_bronze(spark, workspace(spark, sf_dir, "bronze").bronze)


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_silver(spark, workspace(spark, sf_dir).out + "/silver")


def parsed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.parse_envelope(bronze_table(spark, sf_dir))


def ntz(text: str):
    return F.expr(f"timestamp_ntz'{text}'")


def joined(names: str):
    return F.array_join(names, ",")


# ---------------------------------------------------------------- gold and saved queries


def gold_query(name: str) -> Query:
    def run(spark, sf_dir):
        frames = lake.gold_frames(silver_table(spark, sf_dir), RUN_TS, "lake", "risk")
        return frames[name]

    return run


def saved(name: str) -> Query:
    def run(spark, sf_dir):
        frames = lake.gold_frames(silver_table(spark, sf_dir), RUN_TS, "lake", "risk")
        return lake.saved_query(spark, name, frames)

    return run


# ---------------------------------------------------------------- envelope and silver


#: All Silver columns but the one that is rounded below.
SILVER_CHECKED = [name.removesuffix("_text") for name, *_ in SILVER_FIELDS] + [
    "year", "month", "day", "balance_mismatch_flag", "merchant_risk_tier", "rule_signal_score", "processed_at",
]


def silver_rows(spark, sf_dir):
    delta = F.round("balance_delta", 2).alias("balance_delta")
    return silver_table(spark, sf_dir).select(*SILVER_CHECKED, delta)


def quarantine_reasons(spark, sf_dir):
    rows = silver.classified_rows(bronze_table(spark, sf_dir)).where("outcome <> 'dead_letter'")
    found = silver.quarantine_reasons(rows)
    return found.where(F.size("reasons") > 0).select("event_id", joined("reasons").alias("reasons"))


def dedup_events(spark, sf_dir):
    good, _ = silver.split_valid(parsed_rows(spark, sf_dir))
    return silver.dedup_events(good).select("event_id", "arrival_time", "customer_id", "amount")


def dead_letters(spark, sf_dir):
    status = envelope.message_status(bronze_table(spark, sf_dir))
    return status.groupBy("status").agg(F.count("*").alias("messages"))


def routing_attributes(spark, sf_dir):
    good, _ = envelope.split_dead_letter(bronze_table(spark, sf_dir))
    attrs = envelope.routing_attributes(good)
    return attrs.select(*[F.col(f"attr_{n}").alias(n) for n in ("event_id", "schema_version", "is_fraud", "customer_id")])


def online_times(spark, sf_dir):
    rows = envelope.parse_envelope(bronze_table(spark, sf_dir), fallback=ntz(LEDGER_NOW))
    return rows.select("event_id", "event_time", "arrival_time")


def oversize_split(spark, sf_dir):
    docs = sample_tables.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"))
    fits, rejects = envelope.split_oversize(docs, OVERSIZE_LIMIT)
    ok = fits.select("doc_id", F.octet_length("body").alias("body_bytes"), F.lit("ok").alias("outcome"))
    return ok.unionByName(rejects.select("doc_id", "body_bytes", F.lit("rejected").alias("outcome")))


def promote_bronze(spark, sf_dir):
    """Bodies by day in the lake that valid messages were promoted to."""
    target = new_path(spark, "promoted")
    files.promote_bronze(spark, workspace(spark, sf_dir, "bronze").bronze, target)
    found = spark.read.option("basePath", target).option("recursiveFileLookup", "false").text(target)
    day = F.concat_ws("-", F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0"), F.lpad(F.col("day").cast("string"), 2, "0"))
    event = F.get_json_object("value", "$.metadata.event_id")
    return found.groupBy(day.alias("day")).agg(F.count("*").alias("records"), F.count_distinct(event).alias("ids"))


def etl_counters(spark, sf_dir):
    return quality.etl_counters(bronze_table(spark, sf_dir), lake.typed_rows)


def envelopes(spark, sf_dir):
    return sample_tables.messages(tx_table(spark, sf_dir))


# ---------------------------------------------------------------- history features


def base(spark, sf_dir):
    return sample_tables.base_transactions(spark, sf_dir)


def velocity_prior(spark, sf_dir):
    out = history.velocity_prior(sample_tables.keyed_events(spark, sf_dir), {"v5": 300, "v1h": 3600})
    return out.select("event_id", "v5", "v1h")


def velocity_day(spark, sf_dir):
    return history.velocity_prior(sample_tables.keyed_events(spark, sf_dir), {"v_day": DAY}).select("event_id", "v_day")


def velocity_live(spark, sf_dir):
    out = history.velocity_live(sample_tables.keyed_events(spark, sf_dir), {"v5": 300, "v1h": 3600, "v_day": DAY})
    return out.select("event_id", "v5", "v1h", "v_day")


def lifetime(spark, sf_dir):
    out = history.lifetime(sample_tables.keyed_events(spark, sf_dir))
    return out.select("event_id", "lifetime_tx_count", "lifetime_spend")


def days_since_last(spark, sf_dir):
    return history.days_since_last(sample_tables.keyed_events(spark, sf_dir)).select("event_id", "days_since_last_tx")


def geo_anomaly(spark, sf_dir):
    out = history.flag_geo_anomaly(base(spark, sf_dir), 30)
    return out.select("event_id", "geo_anomaly_flag")


def season_tags(spark, sf_dir):
    rows = base(spark, sf_dir).select(
        "event_id", "step", C.traffic_period(F.col("step")).alias("traffic_period"),
        C.schema_version(F.col("step")).alias("schema_version"),
        C.step_time(F.col("step")).alias("step_time"),
    )
    return rows


def device_ids(spark, sf_dir):
    return base(spark, sf_dir).select("event_id", "device_id", "device_type", "new_device_flag")


def assign_stable(spark, sf_dir):
    key = F.col("c_name")
    return sample_tables.table(spark, sf_dir, "customer").select(
        "c_custkey", C.assign_stable(key, C.SEGMENTS, "segment").alias("segment"),
        C.assign_stable(key, C.RISK_PROFILES, "risk").alias("risk_profile"),
        C.stable_int(key, 30, 1824, "account").alias("account_days"),
    )


# ---------------------------------------------------------------- rules and alerts


def with_live(spark, sf_dir, seconds: int) -> DataFrame:
    return history.velocity_live(silver_table(spark, sf_dir), {"velocity_5min_live": seconds})


def rule_columns(df: DataFrame, *extra: str) -> DataFrame:
    return df.select("event_id", joined("triggered_rules").alias("rules"), "is_flagged", *extra)


def rules_online(spark, sf_dir):
    return rule_columns(rules.apply_rules(with_live(spark, sf_dir, 300)), "risk_score")


def rules_online_day(spark, sf_dir):
    scored = rules.apply_rules(with_live(spark, sf_dir, DAY))
    return rule_columns(scored, "risk_score", "velocity_5min_live")


def rules_consumer(spark, sf_dir):
    return rule_columns(rules.apply_rules(silver_table(spark, sf_dir), "consumer"))


def alerts(spark, sf_dir):
    records = rules.alert_records(rules.apply_rules(with_live(spark, sf_dir, DAY)), alerted_at=RUN_TS)
    return records.withColumn("triggered_rules", joined("triggered_rules"))


def alerts_consumer(spark, sf_dir):
    scored = rules.apply_rules(silver_table(spark, sf_dir), "consumer")
    records = rules.alert_records(scored, "consumer", RUN_TS)
    return records.withColumn("triggered_rules", joined("triggered_rules"))


def pattern_tags(spark, sf_dir):
    tagged = rules.pattern_tags(silver_table(spark, sf_dir), SMALL_AMOUNT)
    return tagged.where(F.size("patterns") > 0).select("event_id", joined("patterns").alias("patterns"))


def session_patterns(spark, sf_dir):
    """Sessions with a pattern that shows only over several events; a day's pause ends a session."""
    found = sessions.session_patterns(silver_table(spark, sf_dir), DAY, SMALL_AMOUNT * 2)
    return found.where(F.size("patterns") > 0).withColumn("patterns", joined("patterns"))


def processing_stats(spark, sf_dir):
    scored = rules.apply_rules(silver_table(spark, sf_dir), "consumer")
    done = scored.select("is_flagged", F.lit("processed").alias("status"))
    status = envelope.message_status(bronze_table(spark, sf_dir))
    unread = status.where("status <> 'parsed'").select(F.lit(False).alias("is_flagged"), "status")
    return quality.processing_stats(done.unionByName(unread))


# ---------------------------------------------------------------- quality reports


def late_arrivals(spark, sf_dir):
    out = quality.flag_late(silver_table(spark, sf_dir))
    return out.where("is_late = 1").select("event_id", "is_late", "delay_minutes")


def out_of_order(spark, sf_dir):
    out = history.flag_out_of_order(silver_table(spark, sf_dir))
    return out.select("event_id", "out_of_order", "newest_seen")


def content_duplicates(spark, sf_dir):
    out = quality.flag_content_duplicates(silver_table(spark, sf_dir))
    return out.select("event_id", "content_duplicate")


def null_profile(spark, sf_dir):
    return quality.null_profile(silver_table(spark, sf_dir), NULLABLE_COLUMNS)


def validation_report(spark, sf_dir):
    return quality.validation_report(parsed_rows(spark, sf_dir))


def key_skew(spark, sf_dir):
    return quality.key_skew(parsed_rows(spark, sf_dir), "customer_id")


def label_check(spark, sf_dir):
    return quality.label_check(tx_table(spark, sf_dir), silver_table(spark, sf_dir))


def drift(spark, sf_dir):
    return quality.drift_report(silver_table(spark, sf_dir), 360)


def latency(spark, sf_dir):
    return quality.latency_profile(silver_table(spark, sf_dir))


def reconcile(spark, sf_dir):
    clean = silver_table(spark, sf_dir)
    bronze = bronze_table(spark, sf_dir)
    flagged = rules.apply_rules(clean, "consumer").where("is_flagged")
    _, dead = envelope.split_dead_letter(bronze)
    done = ledger.mark_processed(clean, F.col("arrival_time"))
    return ledger.reconcile(done, bronze, flagged, dead)


# ---------------------------------------------------------------- dimensions, ledger, store


def customers_dim(spark, sf_dir):
    created = F.col("account_creation_date").cast("string")
    return dims.customers_dim(tx_table(spark, sf_dir)).withColumn("account_creation_date", created)


def merchants_dim(spark, sf_dir):
    created = F.col("merchant_creation_date").cast("string")
    return dims.merchants_dim(tx_table(spark, sf_dir)).withColumn("merchant_creation_date", created)


def devices_dim(spark, sf_dir):
    return dims.devices_dim(tx_table(spark, sf_dir))


def chargebacks(spark, sf_dir):
    return dims.chargebacks(tx_table(spark, sf_dir))


def chargebacks_documented(spark, sf_dir):
    return dims.chargebacks(tx_table(spark, sf_dir), "documented")


def observed_delays(spark, sf_dir) -> DataFrame:
    """Transactions with the delay that one of the producers sends along, as text; some of it unusable."""
    days = F.when(F.col("n") % 41 == 0, "soon").when(F.col("n") % 43 == 0, "-1").otherwise((F.col("n") % 241 / 2).cast("string"))
    return tx_table(spark, sf_dir).withColumn("chargeback_delay_days", F.when(F.col("n") % 37 != 0, days))


def filed_chargebacks(spark, sf_dir):
    return dims.filed_chargebacks(observed_delays(spark, sf_dir))


def chargeback_report(spark, sf_dir):
    return dims.chargeback_report(dims.filed_chargebacks(observed_delays(spark, sf_dir)))


def replay(spark, sf_dir):
    rows = dims.replay(tx_table(spark, sf_dir).select("event_id", "customer_id", "amount"), 10)
    return rows.select("event_id", "replay_round", "customer_id", "amount")


def enriched_with_dims(spark, sf_dir):
    clean = silver_table(spark, sf_dir).select("event_id", "customer_id", "merchant_id")
    tx = tx_table(spark, sf_dir)
    out = online.enrich_with_dims(clean, dims.customers_dim(tx), dims.merchants_dim(tx))
    return out.select("event_id", "home_country", "risk_profile", "dim_merchant_category")


def idempotent_skip(spark, sf_dir):
    now = ntz(LEDGER_NOW)
    clean = silver_table(spark, sf_dir)
    done = ledger.mark_processed(clean, F.col("arrival_time")).where(F.col("processed_at") <= now)
    return ledger.filter_processed(parsed_rows(spark, sf_dir), done, now).select("event_id", "arrival_time")


def event_upsert(spark, sf_dir):
    columns = ["event_id", "rule_signal_score", "processed_at"]
    store = silver_table(spark, sf_dir).withColumn("processed_at", F.col("arrival_time"))
    batch = store.where(F.col("event_time") >= ntz(UPSERT_FROM)).select(
        "event_id", (F.col("rule_signal_score") + 100).alias("rule_signal_score"),
        C.plus_seconds(F.col("processed_at"), 3600).alias("processed_at"),
    )
    return ledger.upsert_events(store.select(*columns), batch)


def ttl_expiry(spark, sf_dir):
    store = silver_table(spark, sf_dir)
    kept = ledger.retained_events(store, ntz(STORE_NOW), at="arrival_time")
    return kept.select("event_id", "arrival_time")


def ordered_events(spark, sf_dir):
    rows = silver_table(spark, sf_dir).select("event_id", "event_time", "amount")
    return rows.orderBy("event_time", "event_id")


def stream_sample(spark, sf_dir):
    rows = parsed_rows(spark, sf_dir).select("event_id", "arrival_time")
    return files.sample_stream(rows, 100, [F.col("arrival_time").asc_nulls_last(), F.col("event_id")])


# ---------------------------------------------------------------- model


def feature_frame(spark, sf_dir):
    return ml.feature_frame(silver_table(spark, sf_dir), "managed")


def split(spark, sf_dir):
    rows = ml.stratified_split(ml.feature_frame(silver_table(spark, sf_dir)))
    return rows.select("event_id", LABEL, "is_validation")


def class_weights(spark, sf_dir):
    weights = ml.class_weights(ml.feature_frame(silver_table(spark, sf_dir)))
    return weights.withColumn("positive_weight", F.round("positive_weight", 4))


def evaluate(spark, sf_dir):
    rows = ml.feature_frame(silver_table(spark, sf_dir))
    scored = rows.withColumn("fraud_score", F.col("rule_signal_score") / 6)
    metrics = ml.evaluate(scored)
    return metrics.select(
        "tp", "fp", "tn", "fn", *[F.round(m, 6).alias(m) for m in ("precision", "recall", "f1")]
    )


def trained(spark, sf_dir):
    rows = ml.stratified_split(ml.feature_frame(silver_table(spark, sf_dir)))
    weighted = ml.with_weights(rows).cache()
    model = ml.train(weighted)
    return model, rows, weighted


def gbt_scores(spark, sf_dir):
    model, rows, weighted = trained(spark, sf_dir)
    weighted.unpersist()
    return ml.score(rows, model).select("event_id", "fraud_score", "predicted_fraud", LABEL)


# ---------------------------------------------------------------- streams


def sliding_counts(spark, sf_dir):
    counts = online.sliding_counts(sample_tables.keyed_events(spark, sf_dir))
    return counts.select("customer_id", "window_start", "events")


def stream_scored(spark, sf_dir):
    """All messages through the online job, in micro-batches, to a stop."""
    out = new_path(spark, "online")
    source = workspace(spark, sf_dir, "bronze").bronze
    stream = online.read_stream(spark, source, max_files=10)
    online.OnlineJob(out).start(stream).awaitTermination()
    # Velocity hangs on the order of files; the rest of the score doesn't.
    by_velocity = F.when(F.col("velocity_5min_live") >= 5, 4).otherwise(0)
    return online.scored_events(spark, out).select("event_id", (F.col("risk_score") - by_velocity).alias("base_score"))


ONLINE_NOW = "2024-02-01 00:00:00"


def stream_scored_in_order(spark, sf_dir):
    """The online job over messages that land in the order of their event times: velocity and the whole score."""
    sent = sample_tables.messages(tx_table(spark, sf_dir)).select("body")
    at = F.coalesce(*(F.get_json_object("body", f"$.metadata.{c}").try_cast("timestamp_ntz") for c in ("event_time", "arrival_time")))
    base, path = new_path(spark, "online"), new_path(spark, "time-order")
    job = online.OnlineJob(base, now=ONLINE_NOW)
    in_parts(
        len(STATE_DAYS) + 1, sent.withColumn("at", at).withColumn("part", part_of("at", STATE_DAYS)).drop("at"), path,
        lambda found: job.start(found).awaitTermination(), lambda: online.read_stream(spark, path),
    )
    return online.scored_events(spark, base).select("event_id", "risk_score", "velocity_5min_live", "velocity_1hour_live")


STATE_DAYS = ("2024-01-09", "2024-01-17", "2024-01-25")


#: Messages land in four parts by arrival; every 97th event of the first three lands with the last.
LANDING = ("2024-01-08", "2024-01-16", "2024-01-24")
LATE_EVERY = 97


def part_of(column, days: tuple[str, ...]):
    part = F.lit(len(days))
    for k, day in reversed(list(enumerate(days))):
        part = F.when(F.col(column) < F.lit(day).cast("timestamp_ntz"), k).otherwise(part)
    return part


def in_parts(parts: int, rows: DataFrame, path: str, run: Callable[[DataFrame], None], read: Callable[[], DataFrame]) -> None:
    """Let the parts of ``rows`` (column ``part``) land one after the other, each followed by a run over the new files."""
    for k in range(parts):
        own = rows.where(F.col("part") == k).drop("part")
        writer = own.write.mode("append")
        writer.text(path, files.TEXT_CODEC) if own.columns == ["body"] else writer.parquet(path)
        run(read())


def with_late_messages(spark, sf_dir, job: late.LateAware) -> None:
    """The job over all messages in four micro-batches, the last of which holds late ones."""
    sent = sample_tables.messages(tx_table(spark, sf_dir)).withColumn("at", F.col("arrival_time").cast("timestamp_ntz"))
    part = F.when(F.col("n") % LATE_EVERY == 0, len(LANDING)).otherwise(part_of("at", LANDING))
    path = new_path(spark, "landing")
    in_parts(
        len(LANDING) + 1, sent.select("body", part.alias("part")), path, lambda rows: job.start(rows).awaitTermination(),
        lambda: online.parse_stream(online.read_stream(spark, path)),
    )


def late_dedup(spark, sf_dir):
    """First deliveries of a stream whose last batch brings events from weeks ago, and which of them were late."""
    job = late.LateAwareDedup(new_path(spark, "late-dedup"))
    with_late_messages(spark, sf_dir, job)
    return late.first_deliveries(spark, job.base).select("event_id", "late")


def stream_dedup(spark, sf_dir):
    return late_dedup(spark, sf_dir).select("event_id")


def late_sliding(spark, sf_dir):
    """Sliding counts of the same stream, with the share that came late."""
    job = late.LateAwareCounts(new_path(spark, "late-sliding"))
    with_late_messages(spark, sf_dir, job)
    return late.total_counts(spark, job.base)


def stream_sliding(spark, sf_dir):
    return late_sliding(spark, sf_dir).drop("late_events")


def stateful_velocity(spark, sf_dir):
    """Live velocity from keyed state, over four micro-batches in the order of time."""
    rows = sample_tables.keyed_events(spark, sf_dir).select("event_id", "event_time", "customer_id")
    path, out = new_path(spark, "in-order"), new_path(spark, "velocity")

    def read():
        stream = spark.readStream.schema("event_id string, event_time timestamp_ntz, customer_id string").parquet(path)
        return state.stateful_velocity(stream, {"v5": 300, "v1h": 3600})

    in_parts(len(STATE_DAYS) + 1, rows.withColumn("part", part_of("event_time", STATE_DAYS)), path, lambda found: state.run(spark, found, out), read)
    return spark.read.parquet(out).select("event_id", "v5", "v1h")


JITTER = 6 * 3600


def ordered_release(spark, sf_dir):
    """Velocity of a stream whose events arrive up to six hours out of order, held and released by time."""
    number = F.substring("event_id", 5, 16).cast("bigint")
    rows = sample_tables.keyed_events(spark, sf_dir).select("event_id", "event_time", "customer_id")
    rows = rows.withColumn("at", C.plus_seconds(F.col("event_time"), (number * 7919 % JITTER).cast("int"))).withColumn("part", part_of("at", STATE_DAYS))
    job, path = ordered.OrderedRelease(new_path(spark, "ordered"), {"v5": 300, "v1h": 3600}, JITTER), new_path(spark, "out-of-order")
    schema = "event_id string, event_time timestamp_ntz, customer_id string"
    in_parts(
        len(STATE_DAYS) + 1, rows.drop("at"), path, lambda found: job.start(found).awaitTermination(),
        lambda: spark.readStream.schema(schema).parquet(path),
    )
    job.process(spark.createDataFrame([], schema), len(STATE_DAYS) + 1, flush=True)
    return ordered.released(spark, job.base).select("event_id", "v5", "v1h")


# ---------------------------------------------------------------- sketches by day

RANGES = {"first": ("2024-01-01", "2024-01-15"), "second": ("2024-01-16", "2024-01-31"), "month": ("2024-01-01", "2024-01-31")}


def written_sketches(spark, sf_dir) -> DataFrame:
    path = new_path(spark, "sketches")
    sketches.day_sketches(silver_table(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


def latency_by_range(spark, sf_dir):
    """Delay quantiles of ranges of days from the days' sketches, and whether their exact ranks are within the bound."""
    found = sketches.latency_by_range(written_sketches(spark, sf_dir), RANGES)
    return sketches.rank_checks(found, silver_table(spark, sf_dir), RANGES)


def returning_customers(spark, sf_dir):
    """Customers by their presence in two ranges: exact counts, and whether the sketches' are within the bound."""
    found = sketches.returning_customers(written_sketches(spark, sf_dir), RANGES["first"], RANGES["second"])
    day = F.to_date("event_time").cast("string")
    seen = silver_table(spark, sf_dir).where("customer_id is not null").groupBy("customer_id").agg(
        *(F.max(day.between(*RANGES[n])).alias(n) for n in ("first", "second"))
    )
    tests = {"returning": "first and second", "new": "second and not first", "lost": "first and not second", "any": "first or second"}
    exact = seen.agg(*(F.count_if(F.expr(t)).alias(f"n_{n}") for n, t in tests.items()))
    lines = [
        F.struct(F.lit(n).alias("kind"), F.col(f"n_{n}").alias("exact"), (F.abs(F.col(n) - F.col(f"n_{n}")) <= sketches.COUNT_ERROR * F.col("n_any")).alias("within"))
        for n in tests
    ]
    return exact.crossJoin(found).select(F.inline(F.array(*lines)))  # two rows of figures


def heavy_merchants(spark, sf_dir):
    """Merchants with a hundredth of all events or more, with exact counts."""
    return sketches.heavy_keys(silver_table(spark, sf_dir), "merchant_id", 0.01)


# ---------------------------------------------------------------- stores that follow loads

LOAD_DAYS = ("2024-01-12", "2024-01-22")
STORE_FROM = "2024-01-04"


def numbered(rows: DataFrame) -> DataFrame:
    """Silver rows with their load, and a number that tells which of them are corrected later."""
    number = F.substring("event_id", -6, 6).cast("bigint")
    return rows.select("*", part_of("event_time", LOAD_DAYS).alias("part"), number.alias("number"))


def event_store(spark, sf_dir):
    """The event store after three batches: corrections of scores, then of days, then expiry."""
    rows = numbered(silver_table(spark, sf_dir)).select("event_id", F.to_date("event_time").alias("day"), "amount", "rule_signal_score", "part", "number")
    kept = store.EventStore(new_path(spark, "store"))
    names = ["event_id", "day", "amount", "rule_signal_score", "version"]
    for k in range(len(LOAD_DAYS) + 1):
        own = rows.where(F.col("part") == k)
        if k == 1:
            own = own.unionByName(rows.where("part = 0 and number % 13 = 0").withColumn("rule_signal_score", F.col("rule_signal_score") + 100))
        if k == 2:
            moved = rows.where("part < 2 and number % 17 = 0").withColumn("day", F.date_add("day", 1))
            own = own.unionByName(moved.withColumn("rule_signal_score", F.col("rule_signal_score") + 1000))
        own = own.withColumn("version", F.lit(k)).select(*names)
        kept.upsert(own, k, STORE_FROM if k == 2 else None, "version")
    return kept.current(spark, own.schema).select(*names)


_KEPT: dict[tuple[str, str], gold_parts.GoldParts] = {}


def kept_gold(spark, sf_dir) -> gold_parts.GoldParts:
    """Partial Gold sums after three loads, of which the later two correct events of the earlier ones."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _KEPT:
        kept, rows = gold_parts.GoldParts(new_path(spark, "gold-parts")), numbered(silver_table(spark, sf_dir))
        first = rows.where("part = 0 and number % 13 = 0").withColumns({"amount": F.col("amount") * 2, "velocity_5min": F.lit(0)})
        second = rows.where("part < 2 and number % 17 = 0").withColumns(
            {"is_fraud": 1 - F.col("is_fraud"), "merchant_risk_tier": F.lit("HIGH"), "event_time": C.plus_seconds(F.col("event_time"), DAY)}
        )
        for k, more in enumerate((None, first, second)):
            own = rows.where(F.col("part") == k)
            kept.load(own.unionByName(more) if more is not None else own, k)
        _KEPT[key] = kept
    return _KEPT[key]


def kept_query(table: str) -> Query:
    def run(spark, sf_dir):
        return kept_gold(spark, sf_dir).table(spark, table, RUN_TS, "lake", "risk")

    return run


def conservation(spark, sf_dir):
    """Where all messages went, counted in what the batch and the incremental job wrote."""
    space, base = workspace(spark, sf_dir), new_path(spark, "incremental")
    stream = online.read_stream(spark, space.bronze, max_files=10)
    online.IncrementalSilver(base, RUN_TS).start(stream).awaitTermination()
    bronze = bronze_table(spark, sf_dir)
    valid = silver.classified_rows(bronze).where("outcome = 'valid'")
    found = None
    for path, out in (("batch", space.out), ("incremental", base)):
        parts = {
            "input": bronze, "silver": spark.read.parquet(f"{out}/silver"), "quarantine": spark.read.json(f"{out}/quarantine"),
            "dead_letters": spark.read.text(f"{out}/dead_letters"), "valid": valid,
        }
        counts = {name: df.agg(F.count("*")).scalar() for name, df in parts.items()}
        row = spark.range(1).select(F.lit(path).alias("path"), *(c.alias(n) for n, c in counts.items()))
        row = row.withColumn("duplicates", F.col("valid") - F.col("silver")).drop("valid")
        found = row if found is None else found.unionByName(row)
    return found


def enhanced_from_raw(spark, sf_dir):
    """The raw log as files, then the feature job over it, with countries from the dimensions."""
    rows, out = base(spark, sf_dir), new_path(spark, "raw")
    log = rows.select(
        "n", "step", F.col("transaction_type").alias("type"), "amount", F.col("customer_id").alias("nameOrig"),
        F.col("balance_before").alias("oldbalanceOrg"), F.col("balance_after").alias("newbalanceOrig"),
        F.col("merchant_id").alias("nameDest"), F.col("dest_balance_before").alias("oldbalanceDest"),
        F.col("dest_balance_after").alias("newbalanceDest"), F.col("is_fraud").alias("isFraud"),
        F.col("is_flagged_fraud").alias("isFlaggedFraud"),
    )
    log.repartitionByRange("n").sortWithinPartitions("n").drop("n").write.csv(f"{out}/log", header=True)
    countries = [rows.select(k, c).distinct() for k, c in (("customer_id", "customer_country"), ("merchant_id", "merchant_country"))]
    found = features.run(spark, f"{out}/log", out, *countries)
    return found.select(
        "customer_id", "merchant_id", "step", "event_time", "amount", "schema_version", "traffic_period", "velocity_5min", "velocity_1hour",
        "lifetime_tx_count", "lifetime_spend", "days_since_last_tx", "geo_anomaly_flag",
    )


_TRAINED: dict[tuple[str, str], str] = {}


def trained_job(spark, sf_dir) -> str:
    """Where the training job left its model and scores; it runs on first use in an application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        path = new_path(spark, "model")
        training.run(spark, silver_table(spark, sf_dir), path)
        _TRAINED[key] = path
    return _TRAINED[key]


def model_report(spark, sf_dir):
    return training.part_counts(spark.read.parquet(f"{trained_job(spark, sf_dir)}/scores"))


def stream_model_scores(spark, sf_dir):
    """The saved model inside a stream: does each score equal the batch score of the same model?"""
    job, out, clean = trained_job(spark, sf_dir), new_path(spark, "live-scores"), silver_table(spark, sf_dir)
    stream = spark.readStream.schema(clean.schema).option("maxFilesPerTrigger", 10).parquet(workspace(spark, sf_dir).out + "/silver")
    scoring.run(scoring.scored_stream(stream, f"{job}/model", "v1"), out).awaitTermination()
    return scoring.compared(spark.read.parquet(out), spark.read.parquet(f"{job}/scores"))


GOLD = {
    "gold_fraud_by_merchant": "fraud_by_merchant", "gold_fraud_by_segment": "fraud_by_segment",
    "gold_fraud_by_hour": "fraud_by_hour", "gold_high_risk_customers": "high_risk_customers",
    "gold_run_summary": "pipeline_run_summary",
}
KEPT = {f"kept_{name.removeprefix('gold_')}": table for name, table in GOLD.items()}
SAVED = {f"q_{n}": n for n in lake.SAVED_QUERIES}
OTHERS = [
    silver_rows, quarantine_reasons, dedup_events, dead_letters, routing_attributes, online_times,
    oversize_split, promote_bronze, etl_counters, envelopes, velocity_prior, velocity_day,
    velocity_live, lifetime, days_since_last, geo_anomaly, season_tags, device_ids, assign_stable,
    rules_online, rules_online_day, rules_consumer, alerts, alerts_consumer, pattern_tags,
    processing_stats, late_arrivals, out_of_order, content_duplicates, null_profile,
    validation_report, key_skew, label_check, drift, latency, reconcile, customers_dim,
    merchants_dim, devices_dim, chargebacks, chargebacks_documented, replay, enriched_with_dims,
    idempotent_skip, event_upsert, ttl_expiry, ordered_events, stream_sample, feature_frame, split,
    class_weights, evaluate, gbt_scores, sliding_counts, stream_scored, stream_dedup, stream_sliding,
    conservation, enhanced_from_raw, model_report, late_dedup, late_sliding, stateful_velocity, event_store,
    filed_chargebacks, chargeback_report, session_patterns, stream_scored_in_order,    ordered_release, latency_by_range, returning_customers, heavy_merchants, stream_model_scores,
]


def all_queries() -> dict[str, Query]:
    named = {name: gold_query(table) for name, table in GOLD.items()}
    named |= {name: kept_query(table) for name, table in KEPT.items()}
    named |= {name: saved(query) for name, query in SAVED.items()}
    return named | {q.__name__: q for q in OTHERS}
