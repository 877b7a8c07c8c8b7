"""History features against a plain loop, on random data with ties and a hot key."""

import random
from datetime import datetime, timedelta

import pytest

from txnrisk.operators import history as H

DDL = (
    "event_id string, customer_id string, event_time timestamp_ntz, arrival_time timestamp_ntz, "
    "amount double, customer_country string, merchant_country string"
)
T0 = datetime(2024, 1, 1)


def make(n, seed, span, tie=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        cust = "HOT" if rng.random() < 0.4 else rng.choice(["A", "B", "C", None])
        t = T0 + timedelta(seconds=rng.randrange(0, span, tie))
        rows.append(
            (f"E{i:04d}", cust, t, t + timedelta(seconds=rng.choice([0, 5, 700])),
             round(rng.uniform(1, 99), 2), rng.choice(["US", "CA"]), rng.choice(["US", "CA"]))
        )
    return rows


def loop(rows, widths):
    out, past = {}, {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        eid, cust, t, _, amt, cc, mc = r
        before = past.setdefault(cust, [])
        res = {}
        for w in widths:
            res[f"p{w}"] = sum(1 for b in before if b[0] >= t - timedelta(seconds=w))
            res[f"l{w}"] = len({b[0] for b in before if b[0] >= t - timedelta(seconds=w)} | {t})
        res["n"] = len(before) + 1
        res["spend"] = round(sum(b[1] for b in before) + amt, 2)
        gap = (t - before[-1][0]).total_seconds() if before else None
        res["days"] = None if gap is None else gap / 86400
        res["geo"] = int(gap is not None and cc != mc and gap < 1800)
        before.append((t, amt))
        out[eid] = res
    return out


@pytest.mark.parametrize("span,tie", [(3 * 86400, 1), (86400, 3600), (7200, 60), (10, 10)])
def test_matches_loop(spark, span, tie):
    rows = make(250, span + tie, span, tie)
    want = loop(rows, [300, 3600, 86400])
    df = spark.createDataFrame(rows, DDL)
    got = H.with_history(
        df, key="customer_id", ts="event_time", seq="event_id", amount="amount",
        widths=(300, 3600, 86400),
    ).collect()
    assert len(got) == len(rows)
    for r in got:
        w = want[r.event_id]
        for s in (300, 3600, 86400):
            assert r[f"h_w{s}"] == w[f"p{s}"], (r, w)
            assert r[f"h_t{s}"] == w[f"l{s}"], (r, w)
        assert r.h_n + 1 == w["n"]
        assert round(float(r.h_sum) + r.amount, 2) == w["spend"]
    feats = {r.event_id: r for r in H.customer_features(df).collect()}
    for eid, w in want.items():
        r = feats[eid]
        assert (r.velocity_5min, r.velocity_1hour) == (w["p300"], w["p3600"])
        assert r.lifetime_tx_count == w["n"] and r.lifetime_spend == w["spend"]
        assert r.geo_anomaly_flag == w["geo"]
        if w["days"] is None:
            assert r.days_since_last_tx is None
        else:
            assert abs(r.days_since_last_tx - w["days"]) <= 0.0051


@pytest.mark.parametrize("limit", [10**6, 60, 7, 1])
def test_stretches_do_not_matter(spark, monkeypatch, limit):
    """However finely customers are cut by time, also where a third of all rows is one customer's six hours."""
    rows = make(200, 5, 40 * 86400) + [
        (f"F{i:04d}", "HOT", T0 + timedelta(seconds=86400 + i, microseconds=i * 37 % 1000), T0, 1.5, "US", "CA") for i in range(150)
    ]
    widths = [300, 3600, 30 * 86400]
    want = loop(rows, widths)
    monkeypatch.setattr(H, "LIMIT", limit)
    df = spark.createDataFrame(rows, DDL)
    got = H.with_history(df, key="customer_id", ts="event_time", seq="event_id", amount="amount", latest="arrival_time", widths=tuple(widths)).collect()
    assert len(got) == len(rows)
    newest, gaps = {}, {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        newest[r[0]], gaps[r[0]] = gaps.get(r[1]), None
        gaps[r[1]] = max(gaps.get(r[1]) or r[3], r[3])
    for r in got:
        w = want[r.event_id]
        assert [r[f"h_w{s}"] for s in widths] == [w[f"p{s}"] for s in widths]
        assert [r[f"h_t{s}"] for s in widths] == [w[f"l{s}"] for s in widths]
        assert r.h_n + 1 == w["n"] and round(float(r.h_sum) + r.amount, 2) == w["spend"]
        top = newest[r.event_id]
        assert r.h_max_us == (None if top is None else round((top - datetime(1970, 1, 1)) / timedelta(microseconds=1)))


def test_no_stretch_exceeds_its_limit(spark, monkeypatch):
    monkeypatch.setattr(H, "LIMIT", 40)
    rows = [("HOT", i * 1_000_000) for i in range(900)] + [("HOT", 5_000_000_000_000 + i) for i in range(300)] + [("A", i) for i in range(30)]
    points = spark.createDataFrame(rows, "h_key string, h_us bigint")
    full = H.full_stretches(points)
    assert len(full) > 3
    sizes = H.with_stretch(points, full, "h_key", "h_us").groupBy("h_key", "stretch").count().collect()
    assert max(r["count"] for r in sizes) <= 40 and sum(r["count"] for r in sizes) == len(rows)
    assert [r for r in sizes if r.h_key == "A"] == [("A", H.WHOLE, 30)]
    monkeypatch.setattr(H, "LIMIT", 10**6)
    assert H.full_stretches(points) == []


def test_range_bounds_need_no_shuffle(spark):
    df = spark.createDataFrame([(f"E{i}",) for i in range(300)] + [("E7",)] * 500, "seq string")
    found = df.withColumn("slot", H._ranges(df, "seq")).groupBy("slot").agg(H.F.count_distinct("seq").alias("n")).collect()
    assert 20 < len(found) <= H.RANGES and sum(r.n for r in found) == 300


def test_out_of_order_matches_loop(spark):
    rows = make(200, 9, 6000)
    newest, want = {}, {}
    for r in sorted(rows, key=lambda r: (r[3], r[0])):
        top = newest.get(r[1])
        want[r[0]] = int(top is not None and r[2] < top)
        newest[r[1]] = r[2] if top is None else max(top, r[2])
    got = H.flag_out_of_order(spark.createDataFrame(rows, DDL)).collect()
    assert {r.event_id: r.out_of_order for r in got} == want
    assert sum(want.values()) > 0


def test_window_edges_and_ties(spark):
    def at(eid, sec, mc="CA"):
        t = T0 + timedelta(seconds=sec)
        return (eid, "X", t, t, 1.0, "US", mc)

    rows = [at("a", 0), at("b", 300), at("c", 601), at("d", 601 + 1799), at("e", 601 + 1799 + 1800),
            at("f", 10000), at("g", 10000), at("h", 10000)]
    df = spark.createDataFrame(rows, DDL)
    v = {r.event_id: r.v for r in H.velocity_prior(df, {"v": 300}).collect()}
    assert v["b"] == 1 and v["c"] == 0
    assert sorted(v[x] for x in "fgh") == [0, 1, 2]
    live = {r.event_id: r.v for r in H.velocity_live(df, {"v": 300}).collect()}
    assert [live[x] for x in "fgh"] == [1, 1, 1] and live["b"] == 2
    geo = {r.event_id: r.geo_anomaly_flag for r in H.flag_geo_anomaly(df).collect()}
    assert geo["a"] == 0 and geo["d"] == 1 and geo["e"] == 0


def test_rows_without_time(spark):
    rows = make(20, 3, 600)
    rows.append(("Z1", "HOT", None, None, 5.0, "US", "CA"))
    df = spark.createDataFrame(rows, DDL)
    got = {r.event_id: r for r in H.customer_features(df).collect()}
    assert len(got) == 21
    assert got["Z1"].velocity_5min is None and got["Z1"].lifetime_tx_count is None
    want = loop(rows[:-1], [300])
    assert all(got[e].velocity_5min == w["p300"] for e, w in want.items())


@pytest.mark.parametrize("limit", [10**6, 5])
def test_sessions_match_a_loop(spark, monkeypatch, limit):
    from txnrisk.operators import sessions

    monkeypatch.setattr(H, "LIMIT", limit)
    rows = make(120, 11, 20000, 50) + [("Z1", "HOT", None, None, 5.0, "US", "CA")]
    want, last, number = {"Z1": None}, {}, {}
    for eid, cust, t, *_ in sorted(rows[:-1], key=lambda r: (r[2], r[0])):
        if cust not in last or t - last[cust] > timedelta(seconds=300):
            number[cust] = number.get(cust, 0) + 1
        last[cust], want[eid] = t, number[cust]
    df = spark.createDataFrame(rows, DDL)
    assert {r.event_id: r.session for r in sessions.with_sessions(df, 300).collect()} == want
    assert max(v or 0 for v in want.values()) > 3
    flagged = df.withColumns({"new_device_flag": H.F.lit(1), "geo_anomaly_flag": (H.F.col("amount") > 50).cast("int")})
    found = sessions.session_patterns(flagged, 300, 60.0).collect()
    assert sum(r.events for r in found) == 120 and {p for r in found for p in r.patterns} == {"card_testing", "account_takeover"}
    assert all(("card_testing" in r.patterns) == (r.small_events >= 3) for r in found)
