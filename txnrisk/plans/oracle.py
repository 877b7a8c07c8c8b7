"""SQL twins of the registered queries, over the same given tables.

They are written independently of the Spark code: no messages, no lake, plain
windows. The engines round a double differently (Spark rounds its decimal text
half up), so twins round that text, cut to ten decimals, as a decimal.
"""

from __future__ import annotations

from txnrisk.plans import queries as Q


def rnd(x: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


DEVICE_TYPES = {"iPhone": 35, "Android": 35, "Web": 20, "Tablet": 10}
SEGMENTS = {"Student": 20, "Traveler": 15, "Business": 25, "High Spender": 15, "Family": 25}
RISK_PROFILES = {"Low": 65, "Medium": 25, "High": 10}
DISPUTE_OUTCOMES = {"Approved": 70, "Denied": 20, "Under Review": 10}
OPERATING_SYSTEMS = {
    "iPhone": {"iOS 16": 1, "iOS 17": 1},
    "Android": {"Android 13": 1, "Android 14": 1},
    "Web": {"Chrome/Windows": 1, "Safari/macOS": 1, "Firefox/Linux": 1},
    "Tablet": {"iPadOS 16": 1, "Android 13": 1},
}
FEATURES = (
    "merchant_risk_score", "velocity_5min", "velocity_1hour", "geo_anomaly_flag", "new_device_flag",
    "balance_mismatch_flag", "amount", "rule_signal_score",
)
NULLABLE_COLUMNS = (
    "merchant_category", "ip_address", "device_age_days", "days_since_last_tx", "merchant_risk_score",
    "customer_segment", "device_type", "ip_risk_score",
)


def pick(key: str, weights: dict[str, float], salt: str) -> str:
    """The value whose share of 2**32 the first eight hex digits of the key's hash fall into."""
    part = f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{salt}'), 1, 8) AS BIGINT)"
    cases, reached, names = "", 0, list(weights)
    for name in names[:-1]:
        reached += weights[name]
        cases += f" WHEN {part} < {2**32 * reached // sum(weights.values())} THEN '{name}'"
    return f"CASE{cases} ELSE '{names[-1]}' END" if cases else f"'{names[-1]}'"


def stable_int(key: str, low: int, high: int, salt: str) -> str:
    number = f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{salt}'), 1, 8) AS BIGINT)"
    return f"CAST({number} % {high - low + 1} + {low} AS INTEGER)"


TIE = "event_id"

BASE = f"""
ev AS (
  SELECT event_id AS n, user_id, value, ts,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         CASE event_type WHEN 'purchase' THEN 'PAYMENT' WHEN 'click' THEN 'CASH_OUT'
           WHEN 'view' THEN 'DEBIT' WHEN 'signup' THEN 'CASH_IN' WHEN 'error' THEN 'TRANSFER' END AS transaction_type
  FROM events),
base AS (
  SELECT n, k, 'EVT-' || lpad(CAST(n AS VARCHAR), 16, '0') AS event_id,
    date_trunc('second', ts) AS event_time,
    date_trunc('second', ts) + to_seconds(CASE WHEN n % 50 = 0 THEN 300 + 60 * (n % 355) ELSE n % 30 END) AS arrival_time,
    CAST(date_diff('hour', TIMESTAMP '2024-01-01', ts) + 1 AS INTEGER) AS step,
    CASE WHEN date_diff('hour', TIMESTAMP '2024-01-01', ts) + 1 >= 400 THEN 'v2' ELSE 'v1' END AS schema_version,
    transaction_type, value AS amount, 'C' || user_id AS customer_id, 'M' || k AS merchant_id,
    c_acctbal AS balance_before,
    CASE WHEN transaction_type = 'TRANSFER' AND n % 3 = 0 THEN c_acctbal ELSE {rnd('c_acctbal - value', 2)} END AS balance_after,
    s_acctbal AS dest_balance_before, {rnd('s_acctbal + value', 2)} AS dest_balance_after,
    CASE WHEN transaction_type = 'TRANSFER' AND k >= 75 THEN 1 ELSE 0 END AS is_fraud,
    CASE WHEN transaction_type = 'TRANSFER' AND k >= 75 AND value > 100 THEN 1 ELSE 0 END AS is_flagged_fraud,
    c_mktsegment AS customer_segment, cn.n_name AS customer_country, sn.n_name AS merchant_country,
    p_type AS merchant_category, CAST(user_id % 3 AS INTEGER) AS device_slot,
    'DEV-' || upper(substr(md5('C' || user_id || ':slot' || (user_id % 3)), 1, 12)) AS device_id,
    {pick("'C' || user_id", DEVICE_TYPES, 'device')} AS device_type,
    CAST(n % 50 AS INTEGER) AS device_age_days, CASE WHEN n % 50 < 2 THEN 1 ELSE 0 END AS new_device_flag,
    CASE WHEN n % 33 <> 0 THEN k / 100.0::DOUBLE END AS risk,
    CASE WHEN n % 40 <> 5 THEN '10.' || (user_id // 65536 % 256) || '.' || (user_id // 256 % 256) || '.' || (user_id % 256) END AS ip_address,
    CASE WHEN date_diff('hour', TIMESTAMP '2024-01-01', ts) + 1 >= 400 THEN (n % 101) / 100.0::DOUBLE END AS ip_risk_score,
    CASE WHEN (transaction_type = 'TRANSFER' AND k >= 75 AND n % 20 < 17)
           OR (NOT (transaction_type = 'TRANSFER' AND k >= 75) AND n % 50 = 3) THEN 'Filed' ELSE 'None' END AS chargeback_status,
    CASE WHEN n % 50 = 0 THEN 1 ELSE 0 END AS late_arrival_flag,
    CASE WHEN n % 25 = 24 THEN 1 ELSE 0 END AS out_of_order_flag
  FROM ev LEFT JOIN customer ON c_custkey = user_id LEFT JOIN nation cn ON cn.n_nationkey = c_nationkey
    LEFT JOIN supplier ON s_suppkey = k % 10 LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey
    LEFT JOIN part ON p_partkey = k),
tagged AS (
  SELECT *, CASE WHEN step BETWEEN 168 AND 192 THEN 'Payday' WHEN step BETWEEN 336 AND 360 THEN 'Holiday' ELSE 'Normal' END AS traffic_period
  FROM base),
hist AS (
  SELECT *,
    row_number() OVER (PARTITION BY customer_id, event_time ORDER BY {TIE})
      - count(*) OVER (PARTITION BY customer_id, event_time) - 1 AS among_ties,
    count(*) OVER (PARTITION BY customer_id ORDER BY event_time RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND CURRENT ROW) AS in_5m,
    count(*) OVER (PARTITION BY customer_id ORDER BY event_time RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS in_1h,
    count(*) OVER (PARTITION BY customer_id ORDER BY event_time RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS in_1d,
    lag(event_time) OVER (PARTITION BY customer_id ORDER BY event_time, {TIE}) AS prev_time,
    count(*) OVER (PARTITION BY customer_id ORDER BY event_time, {TIE} ROWS UNBOUNDED PRECEDING) AS lifetime_tx_count,
    CAST(sum(CAST(amount AS DECIMAL(18,2))) OVER (PARTITION BY customer_id ORDER BY event_time, {TIE} ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS lifetime_spend
  FROM tagged),
tx AS (
  SELECT * EXCLUDE (risk),
    CASE WHEN is_fraud = 1 AND step > 360 THEN least(risk * 1.4::DOUBLE, 1.0::DOUBLE) ELSE risk END AS merchant_risk_score,
    CAST(in_5m + among_ties AS INTEGER) AS velocity_5min, CAST(in_1h + among_ties AS INTEGER) AS velocity_1hour,
    CAST(in_1d + among_ties AS INTEGER) AS velocity_day,
    {rnd("(epoch_us(event_time) - epoch_us(prev_time))::DOUBLE / 86400000000.0::DOUBLE", 2)} AS days_since_last_tx,
    CASE WHEN merchant_country <> customer_country AND event_time - prev_time < INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS geo_anomaly_flag
  FROM hist)"""

LAKE = BASE + """,
deliveries AS (
  SELECT *, 0 AS extra, 0 AS duplicate_event_flag FROM tx
  UNION ALL SELECT *, 60, 0 FROM tx WHERE n % 67 = 0
  UNION ALL SELECT * REPLACE ('EVT-D' || lpad(CAST(n AS VARCHAR), 15, '0') AS event_id), 120, 1 FROM tx WHERE n % 71 = 0),
received AS (
  SELECT * REPLACE (
      CASE WHEN n % 200 = 29 THEN '' WHEN n % 200 <> 23 THEN event_id END AS event_id,
      CASE WHEN n % 200 <> 31 THEN transaction_type END AS transaction_type,
      CASE WHEN n % 200 = 43 THEN 2147483647 ELSE geo_anomaly_flag END AS geo_anomaly_flag,
      CASE WHEN n % 200 = 7 THEN -amount WHEN n % 200 = 37 THEN 1e17::DOUBLE WHEN n % 200 <> 11 THEN amount END AS amount,
      CASE WHEN n % 200 <> 13 THEN event_time END AS event_time,
      CASE WHEN n % 200 = 17 THEN 99.9::DOUBLE WHEN n % 200 = 41 THEN 1e13::DOUBLE ELSE merchant_risk_score END AS merchant_risk_score,
      arrival_time + to_seconds(extra) AS arrival_time),
    n % 500 = 499 AS unreadable
  FROM deliveries),
readable AS (SELECT *, strftime(arrival_time, '%Y-%m-%dT%H:%M:%S') AS produced_at, 'paysim-enhanced-v1' AS source FROM received WHERE NOT unreadable),
parsed AS (SELECT * FROM readable WHERE event_id <> ''),
valid AS (SELECT * FROM parsed WHERE event_time IS NOT NULL AND amount > 0 AND amount < 1e15 AND transaction_type IS NOT NULL
  AND coalesce(merchant_risk_score < 1e9, TRUE) AND geo_anomaly_flag IN (0, 1)),
silver AS (
  SELECT *, year(event_time)::INTEGER AS year, month(event_time)::INTEGER AS month, day(event_time)::INTEGER AS day,
    CASE WHEN transaction_type = 'TRANSFER' AND balance_after = balance_before THEN 1 ELSE 0 END AS balance_mismatch_flag,
    CASE WHEN merchant_risk_score >= 0.75 THEN 'HIGH' WHEN merchant_risk_score >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS merchant_risk_tier,
    3 * geo_anomaly_flag + 2 * new_device_flag + duplicate_event_flag + CASE WHEN velocity_5min >= 5 THEN 4 ELSE 0 END
      + CASE WHEN merchant_risk_score >= 0.75 THEN 3 ELSE 0 END AS rule_signal_score,
    '""" + Q.RUN_TS + """' AS processed_at
  FROM valid QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY arrival_time) = 1)"""


def mean(total: str, n: str, digits: int) -> str:
    return rnd(f"({total})::DOUBLE / ({n})::DOUBLE", digits)


RATE = rnd("sum(is_fraud)::DOUBLE / count(*)::DOUBLE * 100", 2)
COUNTS = f"count(*) AS total_transactions, sum(is_fraud)::BIGINT AS fraud_transactions, {RATE} AS fraud_rate_pct"
STAMP = f"'{Q.RUN_TS}' AS computed_at"
CENTS = "CAST({0} AS DECIMAL(18,2))"


def mean_money(col: str) -> str:
    return mean(f"sum({CENTS.format(col)})", f"count({col})", 2)


MEAN_RISK = mean("sum(CAST(merchant_risk_score AS DECIMAL(18,6)))", "count(merchant_risk_score)", 4)
VOLUME = f"sum({CENTS.format('amount')})::DOUBLE"

GOLD = {
    "gold_fraud_by_merchant": f"""SELECT merchant_category, merchant_risk_tier, {COUNTS},
        {mean_money('amount')} AS avg_transaction_amount, {VOLUME} AS total_volume,
        {MEAN_RISK} AS avg_merchant_risk_score,
        {mean('sum(rule_signal_score)', 'count(rule_signal_score)', 2)} AS avg_signal_score, {STAMP}
        FROM silver GROUP BY merchant_category, merchant_risk_tier""",
    "gold_fraud_by_segment": f"""SELECT customer_segment, {COUNTS},
        {mean_money('amount')} AS avg_transaction_amount,
        {mean('sum(lifetime_tx_count)', 'count(lifetime_tx_count)', 1)} AS avg_lifetime_transactions,
        {mean_money('lifetime_spend')} AS avg_lifetime_spend,
        sum(geo_anomaly_flag)::BIGINT AS geo_anomaly_count, sum(new_device_flag)::BIGINT AS new_device_count, {STAMP}
        FROM silver GROUP BY customer_segment""",
    "gold_fraud_by_hour": f"""SELECT hour(event_time)::INTEGER AS hour_of_day, traffic_period, {COUNTS},
        {mean_money('amount')} AS avg_amount,
        {mean('sum(velocity_5min)', 'count(velocity_5min)', 2)} AS avg_velocity_5min, {STAMP}
        FROM silver GROUP BY ALL""",
    "gold_high_risk_customers": f"""SELECT customer_id, customer_segment, customer_country, count(*) AS total_transactions,
        sum(is_fraud)::BIGINT AS confirmed_fraud_count, sum(geo_anomaly_flag)::BIGINT AS geo_anomaly_count,
        sum(new_device_flag)::BIGINT AS new_device_count, sum(duplicate_event_flag)::BIGINT AS duplicate_event_count,
        max(velocity_5min) AS max_velocity_5min, max(rule_signal_score) AS max_signal_score,
        {VOLUME} AS total_transaction_volume, {MEAN_RISK} AS avg_merchant_risk,
        max(event_time) AS last_transaction_time, {STAMP}
        FROM silver GROUP BY customer_id, customer_segment, customer_country
        HAVING sum(is_fraud) > 0 OR (sum(geo_anomaly_flag) > 0 AND sum(new_device_flag) > 0)
          OR max(velocity_5min) >= 5 OR max(rule_signal_score) >= 5""",
    "gold_run_summary": f"""SELECT '{Q.RUN_TS}' AS run_date, count(*) AS silver_records_read,
        count(*) FILTER (is_fraud = 1) AS fraud_transactions,
        {rnd('count(*) FILTER (is_fraud = 1)::DOUBLE / greatest(count(*), 1)::DOUBLE * 100', 2)} AS fraud_rate_pct,
        count(DISTINCT customer_id) AS unique_customers, count(DISTINCT merchant_id) AS unique_merchants,
        count(*) FILTER (geo_anomaly_flag = 1) AS geo_anomaly_count, count(*) FILTER (new_device_flag = 1) AS new_device_count,
        count(*) FILTER (merchant_risk_tier = 'HIGH') AS high_risk_merchant_count,
        count(*) FILTER (balance_mismatch_flag = 1) AS balance_mismatch_count, 'lake' AS location, 'risk' AS database
        FROM silver""",
}


def over_gold(table: str, rest: str) -> str:
    return f"SELECT {rest.format(t=f'({GOLD[table]})')}"


SAVED = {
    "q_rate_by_category": over_gold("gold_fraud_by_merchant",
        "merchant_category, merchant_risk_tier, fraud_rate_pct, total_transactions FROM {t}"),
    "q_rate_by_segment": over_gold("gold_fraud_by_segment",
        "customer_segment, fraud_rate_pct, total_transactions FROM {t}"),
    "q_peak_hours": over_gold("gold_fraud_by_hour",
        "hour_of_day, traffic_period, fraud_rate_pct, total_transactions FROM {t} "
        "ORDER BY fraud_rate_pct DESC, hour_of_day, traffic_period LIMIT 5"),
    "q_top_customers": over_gold("gold_high_risk_customers",
        "customer_id, confirmed_fraud_count, max_signal_score, total_transaction_volume FROM {t} "
        "ORDER BY max_signal_score DESC NULLS LAST, customer_id LIMIT 10"),
    "q_run_summary": over_gold("gold_run_summary", "* FROM {t}"),
}


def texts(cases: dict[str, str]) -> str:
    """Comma-joined names of the conditions that hold, in order."""
    parts = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in cases.items())
    return f"concat_ws(',', {parts})"


# Rules, thresholds and weights stand here once more, so that a slip in the code under test shows.
MISMATCH = "transaction_type = 'TRANSFER' AND balance_before > 0 AND balance_after = balance_before AND amount > 0"
WEIGHTS = {
    "HIGH_VELOCITY_5MIN": 4, "HIGH_RISK_MERCHANT": 3, "GEO_ANOMALY_NEW_DEVICE": 5, "BALANCE_MISMATCH_TRANSFER": 4,
    "PAYSIM_FRAUD_LABEL": 2,
}


def rule_cases(profile: str, velocity: str) -> dict[str, str]:
    cases = {
        "HIGH_VELOCITY_5MIN": f"{velocity} >= 5", "HIGH_RISK_MERCHANT": "merchant_risk_score >= 0.75",
        "GEO_ANOMALY_NEW_DEVICE": "geo_anomaly_flag = 1 AND new_device_flag = 1", "BALANCE_MISMATCH_TRANSFER": MISMATCH,
        "PAYSIM_FRAUD_LABEL": "is_fraud = 1",
    }
    return {n: t for n, t in cases.items() if profile == "online" or n != "BALANCE_MISMATCH_TRANSFER"}


def any_of(cases: dict[str, str]) -> str:
    return " OR ".join(f"coalesce({test}, FALSE)" for test in cases.values())


def total_score(velocity: str) -> str:
    return " + ".join(f"CASE WHEN {test} THEN {WEIGHTS[name]} ELSE 0 END" for name, test in rule_cases("online", velocity).items())


def live(source: str, **widths: str) -> str:
    """Distinct earlier-or-equal times of the customer within each width."""
    columns = ", ".join(
        f"CAST((SELECT count(DISTINCT o.event_time) FROM {source} o WHERE o.customer_id = s.customer_id "
        f"AND o.event_time BETWEEN s.event_time - {width} AND s.event_time) AS INTEGER) AS {name}"
        for name, width in widths.items()
    )
    return f"SELECT s.*, {columns} FROM {source} s"


LIVE_5M = f", live AS ({live('silver', v='INTERVAL 5 MINUTE')})"
LIVE_1D = f", live AS ({live('silver', v='INTERVAL 1 DAY')})"
ONLINE = rule_cases("online", "v")
CONSUMER = rule_cases("consumer", "velocity_5min")
ALERT_SUBJECT = (
    f"'[FRAUD ALERT] Risk Score ' || ({total_score('v')}) || ' — ' || transaction_type || ' $' || format('{{:.2f}}', amount)"
)
PATTERN_CASES = {
    "card_testing": "velocity_5min > 5 AND amount <= 10", "account_takeover": "new_device_flag = 1 AND geo_anomaly_flag = 1",
    "impossible_travel": "geo_anomaly_flag = 1 AND days_since_last_tx < 0.02",
    "merchant_abuse": "merchant_risk_score > 0.70 AND transaction_type = 'CASH_OUT'",
    "friendly_fraud": "is_fraud = 0 AND chargeback_status = 'Filed'",
}
REASONS = {
    "missing_event_id": "coalesce(event_id, '') = ''", "malformed_event_time": "event_time IS NULL",
    "missing_type": "transaction_type IS NULL", "null_amount": "amount IS NULL", "non_positive_amount": "amount <= 0",
    "unrepresentable_value": "amount >= 1e15 OR merchant_risk_score >= 1e9", "flag_out_of_range": "geo_anomaly_flag > 1",
    "risk_out_of_range": "merchant_risk_score > 1",
}
PER_REPORT = "CAST(count(*) AS BIGINT)"


def psi() -> str:
    terms = []
    for b in range(10):
        shares = [
            f"greatest(count(*) FILTER (later = {h} AND bin = {b})::DOUBLE / greatest(count(*) FILTER (later = {h}), 1), 0.0001)"
            for h in ("FALSE", "TRUE")
        ]
        terms.append(f"({shares[1]} - {shares[0]}) * ln({shares[1]} / {shares[0]})")
    return rnd(" + ".join(terms), 4)


def half_mean(later: str) -> str:
    where = f"FILTER (later = {later})"
    return f"(sum(CAST(merchant_risk_score AS DECIMAL(18,6))) {where})::DOUBLE / (count(*) {where})::DOUBLE"


def _validation() -> str:
    flags = {
        "fraud": "is_fraud = 1", "duplicate": "duplicate_event_flag = 1", "late": "late_arrival_flag = 1",
        "out_of_order": "out_of_order_flag = 1",
        "v2_with_ip_risk": "schema_version = 'v2' AND ip_risk_score IS NOT NULL",
    }
    parts = [
        "SELECT 'schema_version' AS section, schema_version AS item, count(*) AS records FROM parsed GROUP BY schema_version",
        "SELECT 'transaction_type', transaction_type, count(*) FROM parsed GROUP BY transaction_type",
        "SELECT 'records', 'all', count(*) FROM parsed",
        *[f"SELECT 'flag', '{n}', count(*) FILTER ({t}) FROM parsed" for n, t in flags.items()],
    ]
    pct = rnd("records * 100::DOUBLE / (SELECT count(*) FROM parsed)", 2)
    return f"SELECT section, item, records, {pct} AS pct FROM ({' UNION ALL '.join(parts)})"


def _nulls() -> str:
    # 'nan' addresses and the text None count as documented
    parts = [
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, count(*) AS row_count, "
        f"{rnd(f'count(*) FILTER ({c} IS NULL) * 100 / count(*)::DOUBLE', 2)} AS null_pct FROM silver"
        for c in NULLABLE_COLUMNS
    ]
    return " UNION ALL ".join(parts)


def first_seen(key: str, columns: str) -> str:
    order = ", ".join(f"{c.strip()} NULLS FIRST" for c in columns.split(","))
    return f"first AS (SELECT {key}, {columns} FROM tx QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY event_time, {order}) = 1)"


def created(key: str, low: int, high: int, salt: str) -> str:
    return f"CAST(CAST(DATE '2023-01-01' - {stable_int(key, low, high, salt)} AS DATE) AS VARCHAR)"


def dispute(where: str) -> str:
    return f"""SELECT 'CB-' || upper(substr(md5(event_id || '|cb'), 1, 10)) AS chargeback_id, event_id AS transaction_id,
        customer_id, {stable_int('event_id', 7, 90, 'days')} AS days_to_dispute,
        {pick('event_id', DISPUTE_OUTCOMES, 'outcome')} AS resolution_status FROM tx WHERE {where}"""


def operating_system() -> str:
    cases = " ".join(
        f"WHEN '{kind}' THEN {pick('device_id', names, 'os')}" for kind, names in OPERATING_SYSTEMS.items()
    )
    return f"CASE device_type {cases} END"


def feature(name: str, fills: dict[str, float]) -> str:
    return f"coalesce({name}::DOUBLE, {fills.get(name, 0.0)}) AS {name}"


HASH = "md5(event_id || '|42')"
HITS = "rule_signal_score / 6.0 >= 0.5"


def _evaluate() -> str:
    cells = f"""SELECT count(*) FILTER ({HITS} AND is_fraud = 1) AS tp, count(*) FILTER ({HITS} AND is_fraud = 0) AS fp,
        count(*) FILTER (NOT {HITS} AND is_fraud = 0) AS tn, count(*) FILTER (NOT {HITS} AND is_fraud = 1) AS fn FROM silver"""
    p, r = "tp::DOUBLE / greatest(tp + fp, 1)", "tp::DOUBLE / greatest(tp + fn, 1)"
    return f"""SELECT tp, fp, tn, fn, {rnd(p, 6)} AS precision, {rnd(r, 6)} AS recall,
        {rnd(f'2 * ({p}) * ({r}) / greatest(({p}) + ({r}), 0.001)', 6)} AS f1 FROM ({cells})"""


SILVER_SELECT = f"SELECT {', '.join(Q.SILVER_CHECKED)}, {rnd('balance_after - balance_before', 2)} AS balance_delta FROM silver"

#: query -> (CTE prelude, SELECT)
#: Landing parts, watermarks and loads stand here once more.
LANDED = """, landed AS (
  SELECT *, CASE WHEN n % 97 = 0 THEN 3 WHEN arrival_time < TIMESTAMP '2024-01-08' THEN 0 WHEN arrival_time < TIMESTAMP '2024-01-16' THEN 1
    WHEN arrival_time < TIMESTAMP '2024-01-24' THEN 2 ELSE 3 END AS part FROM parsed),
seen AS (SELECT part, max(arrival_time) AS arrived, max(coalesce(event_time, arrival_time)) AS happened FROM landed GROUP BY part),
marks AS (SELECT part, max(arrived) OVER w - INTERVAL 1 DAY AS arrival_mark, max(happened) OVER w - INTERVAL 6 HOUR AS event_mark
  FROM seen WINDOW w AS (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, coalesce(arrival_time < arrival_mark, FALSE) AS late_arrival, coalesce(coalesce(event_time, arrival_time) < event_mark, FALSE) AS late_event
  FROM landed JOIN marks USING (part))"""
FILED = """, filed AS (
  SELECT event_id AS transaction_id, customer_id, customer_segment, amount, days_to_dispute,
    CAST(event_time + to_seconds(CAST(floor(days_to_dispute * 86400) AS BIGINT)) AS DATE) AS filed_on, CAST(1 - is_fraud AS INTEGER) AS is_friendly
  FROM (SELECT *, CASE WHEN n % 37 <> 0 AND n % 41 <> 0 AND n % 43 <> 0 THEN (n % 241) / 2.0::DOUBLE END AS days_to_dispute FROM tx WHERE chargeback_status = 'Filed'))"""
NUMBERED = """, numbered AS (
  SELECT *, CASE WHEN event_time < TIMESTAMP '2024-01-12' THEN 0 WHEN event_time < TIMESTAMP '2024-01-22' THEN 1 ELSE 2 END AS part,
    CAST(right(event_id, 6) AS BIGINT) AS number FROM silver),
kinds AS (SELECT *, CASE WHEN part < 2 AND number % 17 = 0 THEN 2 WHEN part = 0 AND number % 13 = 0 THEN 1 ELSE 0 END AS corrected FROM numbered)"""
MENDED = NUMBERED + """, mended AS (
  SELECT * REPLACE (
    CASE WHEN corrected = 1 THEN amount * 2 ELSE amount END AS amount, CASE WHEN corrected = 1 THEN 0 ELSE velocity_5min END AS velocity_5min,
    CAST(CASE WHEN corrected = 2 THEN 1 - is_fraud ELSE is_fraud END AS INTEGER) AS is_fraud,
    CASE WHEN corrected = 2 THEN 'HIGH' ELSE merchant_risk_tier END AS merchant_risk_tier,
    CASE WHEN corrected = 2 THEN event_time + INTERVAL 1 DAY ELSE event_time END AS event_time)
  FROM kinds)"""

TWINS = {
    **{f"kept_{name.removeprefix('gold_')}": (LAKE + MENDED, sql.replace("FROM silver", "FROM mended")) for name, sql in GOLD.items()},
    "late_dedup": (LAKE + LANDED, """SELECT event_id, late_arrival AS late FROM marked
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY part, arrival_time) = 1"""),
    "late_sliding": (LAKE + LANDED, """SELECT customer_id, window_start, count(*) AS events, count(*) FILTER (late_event) AS late_events FROM (
        SELECT customer_id, late_event, time_bucket(INTERVAL 5 MINUTE, coalesce(event_time, arrival_time)) - to_minutes(5 * i) AS window_start FROM marked, range(12) t(i))
        GROUP BY customer_id, window_start"""),
    "stateful_velocity": (BASE + f", counted AS ({live('base', v5='INTERVAL 5 MINUTE', v1h='INTERVAL 1 HOUR')})", "SELECT event_id, v5, v1h FROM counted"),
    "ordered_release": (BASE + f", counted AS ({live('base', v5='INTERVAL 5 MINUTE', v1h='INTERVAL 1 HOUR')})", "SELECT event_id, v5, v1h FROM counted"),
    "latency_by_range": (LAKE, """SELECT name AS range, count(*) AS events, count(*) AS counted, TRUE AS p50_right, TRUE AS p95_right, TRUE AS p99_right
        FROM silver JOIN (VALUES ('first', DATE '2024-01-01', DATE '2024-01-15'), ('second', DATE '2024-01-16', DATE '2024-01-31'),
          ('month', DATE '2024-01-01', DATE '2024-01-31')) r(name, low, high) ON CAST(event_time AS DATE) BETWEEN low AND high GROUP BY name"""),
    "returning_customers": (LAKE, """SELECT kind, count(*) FILTER (CASE kind WHEN 'returning' THEN a AND b WHEN 'new' THEN b AND NOT a WHEN 'lost' THEN a AND NOT b ELSE a OR b END) AS exact, TRUE AS within
        FROM (SELECT bool_or(CAST(event_time AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-15') AS a,
          bool_or(CAST(event_time AS DATE) BETWEEN DATE '2024-01-16' AND DATE '2024-01-31') AS b
          FROM silver WHERE customer_id IS NOT NULL GROUP BY customer_id), (VALUES ('returning'), ('new'), ('lost'), ('any')) k(kind) GROUP BY kind"""),
    "heavy_merchants": (LAKE, "SELECT merchant_id, count(*) AS n FROM silver GROUP BY merchant_id HAVING 100 * count(*) >= (SELECT count(*) FROM silver)"),
    "stream_model_scores": (LAKE, "SELECT event_id, TRUE AS same, 'v1' AS model_version FROM silver"),
    "filed_chargebacks": (BASE + FILED, "SELECT transaction_id, customer_id, customer_segment, amount, days_to_dispute, filed_on, is_friendly FROM filed"),
    "chargeback_report": (BASE + FILED, f"""SELECT customer_segment, CASE WHEN days_to_dispute IS NULL THEN 'unknown' WHEN days_to_dispute <= 7 THEN 'week'
          WHEN days_to_dispute <= 30 THEN 'month' WHEN days_to_dispute <= 90 THEN 'quarter' ELSE 'later' END AS delay_class,
        count(*) AS chargebacks, sum(is_friendly)::BIGINT AS friendly, sum({CENTS.format('amount')})::DOUBLE AS amount FROM filed GROUP BY ALL"""),
    "session_patterns": (LAKE + """, started AS (
          SELECT *, CASE WHEN lag(event_time) OVER w IS NULL OR event_time - lag(event_time) OVER w > INTERVAL 1 DAY THEN 1 ELSE 0 END AS first_one
          FROM silver WINDOW w AS (PARTITION BY customer_id ORDER BY event_time, event_id)),
        counted AS (SELECT *, CAST(sum(first_one) OVER (PARTITION BY customer_id ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM started)""",
        f"""SELECT customer_id, session, min(event_time) AS first_time, max(event_time) AS last_time, count(*) AS events, count(*) FILTER (amount <= 20) AS small_events,
          count(*) FILTER (new_device_flag = 1) AS new_device_events, count(*) FILTER (geo_anomaly_flag = 1) AS geo_anomaly_events, {VOLUME} AS amount,
          concat_ws(',', CASE WHEN count(*) FILTER (amount <= 20) >= 3 THEN 'card_testing' END,
            CASE WHEN count(*) FILTER (new_device_flag = 1) > 0 AND count(*) FILTER (geo_anomaly_flag = 1) > 0 THEN 'account_takeover' END) AS patterns
        FROM counted GROUP BY customer_id, session HAVING patterns <> ''"""),
    "stream_scored_in_order": (LAKE + f""", arrived AS (SELECT * REPLACE (coalesce(event_time, arrival_time) AS event_time) FROM parsed
          QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY arrival_time) = 1),
        counted AS ({live('arrived', v5='INTERVAL 5 MINUTE', v1h='INTERVAL 1 HOUR')})""",
        f"SELECT event_id, {total_score('v5')} AS risk_score, v5 AS velocity_5min_live, v1h AS velocity_1hour_live FROM counted"),
    "event_store": (LAKE + NUMBERED, """SELECT event_id, day, amount, rule_signal_score, version FROM (
        SELECT event_id, CAST(event_time AS DATE) + CASE WHEN corrected = 2 THEN 1 ELSE 0 END AS day, amount,
          CAST(rule_signal_score + CASE corrected WHEN 2 THEN 1000 WHEN 1 THEN 100 ELSE 0 END AS INTEGER) AS rule_signal_score,
          CAST(CASE WHEN corrected > 0 THEN corrected ELSE part END AS INTEGER) AS version FROM kinds)
        WHERE day >= DATE '2024-01-04'"""),
    **{name: (LAKE, sql) for name, sql in GOLD.items()},
    **{name: (LAKE, sql) for name, sql in SAVED.items()},
    "silver_rows": (LAKE, SILVER_SELECT),
    "quarantine_reasons": (LAKE, f"SELECT event_id, {texts(REASONS)} AS reasons FROM readable WHERE {any_of(REASONS)}"),
    "dedup_events": (LAKE, "SELECT event_id, arrival_time, customer_id, amount FROM silver"),
    "dead_letters": (LAKE, "SELECT CASE WHEN unreadable THEN 'dead_letter' WHEN coalesce(event_id, '') = '' THEN 'skipped' ELSE 'parsed' END AS status, count(*) AS messages FROM received GROUP BY 1"),
    "routing_attributes": (LAKE, "SELECT event_id, schema_version, CAST(is_fraud AS VARCHAR) AS is_fraud, customer_id FROM readable"),
    "online_times": (LAKE, "SELECT event_id, coalesce(event_time, arrival_time) AS event_time, arrival_time FROM parsed"),
    "oversize_split": ("", f"""SELECT doc_id, CAST(strlen(text) AS INTEGER) AS body_bytes,
        CASE WHEN strlen(text) > {Q.OVERSIZE_LIMIT} THEN 'rejected' ELSE 'ok' END AS outcome FROM documents"""),
    "promote_bronze": (LAKE, """SELECT strftime(arrival_time, '%Y-%m-%d') AS day, count(*) AS records,
        count(DISTINCT event_id) AS ids FROM readable GROUP BY 1"""),
    "enhanced_from_raw": (BASE + """,
log AS (SELECT *, TIMESTAMP '2023-01-01' + to_hours(step) AS t FROM tagged),
past AS (SELECT *, lag(t) OVER w AS prev, row_number() OVER (PARTITION BY customer_id, t ORDER BY n) - count(*) OVER (PARTITION BY customer_id, t) - 1 AS after,
    count(*) OVER (PARTITION BY customer_id ORDER BY t RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND CURRENT ROW) AS w5,
    count(*) OVER (PARTITION BY customer_id ORDER BY t RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS w60,
    row_number() OVER w AS nth, sum(CAST(amount AS DECIMAL(18,2))) OVER (PARTITION BY customer_id ORDER BY t, n ROWS UNBOUNDED PRECEDING) AS spend
  FROM log WINDOW w AS (PARTITION BY customer_id ORDER BY t, n))""",
        f"""SELECT customer_id, merchant_id, step, t AS event_time, amount, schema_version, traffic_period, CAST(w5 + after AS INTEGER) AS velocity_5min,
        CAST(w60 + after AS INTEGER) AS velocity_1hour, nth AS lifetime_tx_count, spend::DOUBLE AS lifetime_spend,
        {rnd("(epoch_us(t) - epoch_us(prev))::DOUBLE / 86400000000.0::DOUBLE", 2)} AS days_since_last_tx,
        CASE WHEN merchant_country <> customer_country AND t - prev < INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS geo_anomaly_flag FROM past"""),
    "model_report": (LAKE, f"""SELECT CASE WHEN held THEN 'validation' ELSE 'training' END AS part, is_fraud, count(*) AS records, count(*) AS scored FROM (
        SELECT is_fraud, substr({HASH}, 1, 8) < '33333333' OR (is_fraud = 1 AND {HASH} = (SELECT min({HASH}) FROM silver WHERE is_fraud = 1)) AS held
        FROM silver) GROUP BY 1, 2"""),
    "conservation": (LAKE, """SELECT path, (SELECT count(*) FROM received) AS input, (SELECT count(*) FROM silver) AS silver,
        (SELECT count(*) FROM readable) - (SELECT count(*) FROM valid) AS quarantine, (SELECT count(*) FROM received WHERE unreadable) AS dead_letters,
        (SELECT count(*) FROM valid) - (SELECT count(*) FROM silver) AS duplicates FROM (VALUES ('batch'), ('incremental')) p(path)"""),
    "stream_sample": (LAKE, "SELECT event_id, arrival_time FROM parsed ORDER BY arrival_time, event_id LIMIT 100"),
    "stream_dedup": (LAKE, "SELECT DISTINCT event_id FROM parsed"),
    "stream_scored": (LAKE, f"SELECT event_id, {total_score('0')} AS base_score FROM parsed QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY arrival_time) = 1"),
    "stream_sliding": (LAKE, """SELECT customer_id, window_start, count(*) AS events FROM (
        SELECT customer_id, time_bucket(INTERVAL 5 MINUTE, coalesce(event_time, arrival_time)) - to_minutes(5 * i) AS window_start FROM parsed, range(12) t(i))
        GROUP BY customer_id, window_start"""),
    "etl_counters": (LAKE, """SELECT (SELECT count(*) FROM received) AS input_records,
        (SELECT count(*) FROM received WHERE unreadable) AS dead_letters, (SELECT count(*) FROM readable WHERE coalesce(event_id, '') = '') AS skipped,
        (SELECT count(*) FROM valid) AS valid_records,
        (SELECT count(*) FROM parsed) - (SELECT count(*) FROM valid) AS corrupted_records,
        (SELECT count(*) FROM valid) - (SELECT count(*) FROM silver) AS duplicates_removed,
        (SELECT count(*) FROM silver) AS silver_records"""),
    "velocity_prior": (BASE, "SELECT event_id, velocity_5min AS v5, velocity_1hour AS v1h FROM tx"),
    "velocity_day": (BASE, "SELECT event_id, velocity_day AS v_day FROM tx"),
    "velocity_live": (BASE + f", counted AS ({live('base', v5='INTERVAL 5 MINUTE', v1h='INTERVAL 1 HOUR', v_day='INTERVAL 1 DAY')})",
        "SELECT event_id, v5, v1h, v_day FROM counted"),
    "lifetime": (BASE, "SELECT event_id, lifetime_tx_count, lifetime_spend FROM tx"),
    "days_since_last": (BASE, "SELECT event_id, days_since_last_tx FROM tx"),
    "geo_anomaly": (BASE, "SELECT event_id, geo_anomaly_flag FROM tx"),
    "season_tags": (BASE, "SELECT event_id, step, traffic_period, schema_version, TIMESTAMP '2023-01-01' + to_hours(step) AS step_time FROM tagged"),
    "device_ids": (BASE, "SELECT event_id, device_id, device_type, new_device_flag FROM base"),
    "assign_stable": ("", f"""SELECT c_custkey, {pick('c_name', SEGMENTS, 'segment')} AS segment,
        {pick('c_name', RISK_PROFILES, 'risk')} AS risk_profile, {stable_int('c_name', 30, 1824, 'account')} AS account_days FROM customer"""),
    "rules_online": (LAKE + LIVE_5M, f"SELECT event_id, {texts(ONLINE)} AS rules, {any_of(ONLINE)} AS is_flagged, {total_score('v')} AS risk_score FROM live"),
    "rules_online_day": (LAKE + LIVE_1D, f"SELECT event_id, {texts(ONLINE)} AS rules, {any_of(ONLINE)} AS is_flagged, {total_score('v')} AS risk_score, v AS velocity_5min_live FROM live"),
    "rules_consumer": (LAKE, f"SELECT event_id, {texts(CONSUMER)} AS rules, {any_of(CONSUMER)} AS is_flagged FROM silver"),
    "alerts": (LAKE + LIVE_1D, f"""SELECT 'FRAUD_DETECTED' AS alert_type, event_id, event_time, customer_id, amount,
        transaction_type AS tx_type, merchant_id, merchant_category, {texts(ONLINE)} AS triggered_rules,
        {total_score('v')} AS risk_score, v AS velocity_5min, geo_anomaly_flag AS geo_anomaly, new_device_flag AS new_device,
        is_fraud AS is_fraud_label, '{Q.RUN_TS}' AS alerted_at, {ALERT_SUBJECT} AS subject FROM live WHERE {any_of(ONLINE)}"""),
    "alerts_consumer": (LAKE, f"""SELECT event_id, event_time, customer_id, amount, transaction_type AS type,
        {texts(CONSUMER)} AS triggered_rules, merchant_risk_score AS merchant_risk, geo_anomaly_flag AS geo_anomaly,
        velocity_5min, is_fraud AS "isFraud_label", '{Q.RUN_TS}' AS alerted_at FROM silver WHERE {any_of(CONSUMER)}"""),
    "pattern_tags": (LAKE, f"SELECT event_id, {texts(PATTERN_CASES)} AS patterns FROM silver WHERE {any_of(PATTERN_CASES)}"),
    "processing_stats": (LAKE, f"""SELECT (SELECT count(*) FROM silver) AS processed, (SELECT count(*) FROM readable WHERE coalesce(event_id, '') = '') AS skipped,
        (SELECT count(*) FROM silver WHERE {any_of(CONSUMER)}) AS flagged, (SELECT count(*) FROM received WHERE unreadable) AS errors,
        {rnd(f'(SELECT count(*) FROM silver WHERE {any_of(CONSUMER)}) * 100 / (SELECT count(*) FROM silver)::DOUBLE', 1)} AS flag_rate_pct"""),
    "late_arrivals": (LAKE, f"""SELECT event_id, 1 AS is_late,
        {rnd('(epoch_us(arrival_time) - epoch_us(event_time))::DOUBLE / 1000000 / 60', 2)} AS delay_minutes
        FROM silver WHERE arrival_time > event_time + INTERVAL 5 MINUTE"""),
    "out_of_order": (LAKE, f"""SELECT event_id, CASE WHEN event_time < newest_seen THEN 1 ELSE 0 END AS out_of_order, newest_seen FROM (
        SELECT event_id, event_time, max(event_time) OVER (PARTITION BY customer_id ORDER BY arrival_time, {TIE}
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest_seen FROM silver)"""),
    "content_duplicates": (LAKE, """SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY step, event_time, transaction_type, amount,
        customer_id, merchant_id, balance_before, balance_after ORDER BY arrival_time, event_id) > 1 THEN 1 ELSE 0 END AS content_duplicate FROM silver"""),
    "null_profile": (LAKE, _nulls()),
    "validation_report": (LAKE, _validation()),
    "key_skew": (LAKE, """SELECT count(*) AS unique_keys, arg_min(customer_id, (-c, customer_id)) AS top_key, max(c) AS top_count,
        count(*) FILTER (c = 1) AS singleton_keys, sum(c)::BIGINT AS records
        FROM (SELECT customer_id, count(*) AS c FROM parsed GROUP BY customer_id)"""),
    "label_check": (LAKE, """SELECT count(*) FILTER (t.event_id IS NOT NULL AND s.event_id IS NOT NULL) AS compared,
        count(*) FILTER (s.event_id IS NULL) AS only_in_source, count(*) FILTER (t.event_id IS NULL) AS only_in_silver,
        count(*) FILTER (t.is_fraud <> s.is_fraud) AS is_fraud_mismatches,
        count(*) FILTER (t.is_flagged_fraud <> s.is_flagged_fraud) AS is_flagged_fraud_mismatches
        FROM tx t FULL JOIN silver s ON t.event_id = s.event_id"""),
    "drift": (LAKE, f"""SELECT count(*) FILTER (NOT later) AS n_first, count(*) FILTER (later) AS n_second, (SELECT count(*) FROM silver WHERE is_fraud = 1 AND NOT merchant_risk_score BETWEEN 0 AND 1) AS n_out_of_range,
        {rnd(half_mean('FALSE'), 4)} AS mean_first, {rnd(half_mean('TRUE'), 4)} AS mean_second,
        {rnd(f"({half_mean('TRUE')}) / ({half_mean('FALSE')})", 4)} AS mean_ratio, {psi()} AS psi
        FROM (SELECT merchant_risk_score, step > 360 AS later, least(floor(merchant_risk_score * 10), 9) AS bin
              FROM silver WHERE is_fraud = 1 AND merchant_risk_score BETWEEN 0 AND 1)"""),
    "latency": (LAKE, f"""SELECT count(*) AS events, {rnd('quantile_cont(d, 0.5)', 4)} AS p50_seconds, {rnd('quantile_cont(d, 0.95)', 4)} AS p95_seconds,
        {rnd('quantile_cont(d, 0.99)', 4)} AS p99_seconds, {rnd('count(*) FILTER (d > 300) * 100 / count(*)::DOUBLE', 2)} AS late_pct
        FROM (SELECT (epoch_us(arrival_time) - epoch_us(event_time))::DOUBLE / 1000000 AS d FROM silver)"""),
    "reconcile": (LAKE, f"""SELECT (SELECT count(*) FROM silver) AS ledger_ids, (SELECT count(*) FROM received) AS bronze_rows,
        (SELECT count(*) FROM silver WHERE {any_of(CONSUMER)}) AS alerts, (SELECT count(*) FROM received WHERE unreadable) AS dead_letters,
        CASE WHEN (SELECT count(*) FROM received WHERE unreadable) > 0 THEN 'dead_letters'
          WHEN (SELECT count(*) FROM silver) > 0 THEN 'healthy' ELSE 'nothing_processed' END AS status"""),
    "customers_dim": (BASE + ", " + first_seen("customer_id", "customer_segment, customer_country, device_slot"),
        f"""SELECT customer_id, customer_segment, customer_country AS home_country,
        {created('customer_id', 30, 1824, 'account')} AS account_creation_date,
        {pick('customer_id', RISK_PROFILES, 'risk')} AS risk_profile, device_slot AS preferred_device_type FROM first"""),
    "merchants_dim": (BASE + ", " + first_seen("merchant_id", "merchant_category, merchant_country, merchant_risk_score"),
        f"""SELECT merchant_id, merchant_category, merchant_country, {rnd('coalesce(merchant_risk_score, 0.1::DOUBLE)', 4)} AS merchant_risk_score,
        {created('merchant_id', 60, 3649, 'merchant')} AS merchant_creation_date FROM first"""),
    "devices_dim": (BASE + ", " + first_seen("device_id", "device_type, device_age_days"),
        f"SELECT device_id, device_type, device_age_days, {operating_system()} AS operating_system FROM first"),
    "chargebacks": (BASE, dispute("is_fraud = 1")),
    "chargebacks_documented": (BASE, dispute("chargeback_status = 'Filed'")),
    "replay": (BASE, """SELECT CASE WHEN r = 0 THEN event_id ELSE 'EVT-' || upper(substr(md5(event_id || '|' || r), 1, 16)) END AS event_id,
        CAST(r AS INTEGER) AS replay_round, customer_id, amount FROM tx, range(10) t(r)"""),
    "enriched_with_dims": (LAKE + ", " + first_seen("customer_id", "customer_country") + ", shop AS (SELECT merchant_id, merchant_category FROM tx QUALIFY row_number() OVER (PARTITION BY merchant_id ORDER BY event_time, merchant_category NULLS FIRST, merchant_country NULLS FIRST, merchant_risk_score NULLS FIRST) = 1)",
        f"""SELECT s.event_id, f.customer_country AS home_country, {pick('s.customer_id', RISK_PROFILES, 'risk')} AS risk_profile,
        m.merchant_category AS dim_merchant_category FROM silver s LEFT JOIN first f ON f.customer_id = s.customer_id
        LEFT JOIN shop m ON m.merchant_id = s.merchant_id"""),
    "idempotent_skip": (LAKE, f"""SELECT event_id, min(arrival_time) AS arrival_time FROM parsed WHERE event_id NOT IN (
        SELECT event_id FROM silver WHERE arrival_time <= TIMESTAMP '{Q.LEDGER_NOW}' AND arrival_time > TIMESTAMP '{Q.LEDGER_NOW}' - INTERVAL 24 HOUR)
        GROUP BY event_id"""),
    "event_upsert": (LAKE, f"""SELECT event_id, rule_signal_score + CASE WHEN event_time >= TIMESTAMP '{Q.UPSERT_FROM}' THEN 100 ELSE 0 END AS rule_signal_score,
        arrival_time + CASE WHEN event_time >= TIMESTAMP '{Q.UPSERT_FROM}' THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS processed_at FROM silver"""),
    "ttl_expiry": (LAKE, f"SELECT event_id, arrival_time FROM silver WHERE arrival_time > TIMESTAMP '{Q.STORE_NOW}' - INTERVAL 7 DAY"),
    "ordered_events": (LAKE, "SELECT event_id, event_time, amount FROM silver ORDER BY event_time, event_id"),
    "feature_frame": (LAKE, f"SELECT event_id, {', '.join(feature(n, {'merchant_risk_score': 0.1}) for n in FEATURES)}, is_fraud FROM silver"),
    "split": (LAKE, f"""SELECT event_id, is_fraud, substr({HASH}, 1, 8) < '33333333' OR (is_fraud = 1 AND {HASH} =
        (SELECT min({HASH}) FROM silver WHERE is_fraud = 1)) AS is_validation FROM silver"""),
    "class_weights": (LAKE, f"""SELECT count(*) FILTER (is_fraud = 1) AS fraud, count(*) FILTER (is_fraud = 0) AS legitimate,
        {rnd('count(*) FILTER (is_fraud = 0)::DOUBLE / greatest(count(*) FILTER (is_fraud = 1), 1)', 4)} AS positive_weight FROM silver"""),
    "evaluate": (LAKE, _evaluate()),
    "sliding_counts": (BASE, """SELECT customer_id, window_start, count(*) AS events FROM (
        SELECT customer_id, time_bucket(INTERVAL 5 MINUTE, event_time) - to_minutes(5 * i) AS window_start FROM base, range(12) t(i))
        GROUP BY customer_id, window_start"""),
}


def all_twins() -> dict[str, str]:
    return {
        name: f"WITH {prelude.strip()}\n{select}" if prelude else select
        for name, (prelude, select) in TWINS.items()
    }
