"""Independent SQL for the registered queries, for a second engine on the same tables.

Each text is built from shared common table expressions: ``txn`` (the derived
transaction table), ``parted`` (with the split) and so on.
"""

from __future__ import annotations

from riskspark.contract import CATEGORICAL_FEATURES, DEFAULT_CONTRACT, NUMERIC_FEATURES
from riskspark.plans.queries import FIXED_MODEL, LOW_CORRELATION

ORACLES: dict[str, str] = {}

# Reason codes, their texts and the steps of a trace, written out apart from the library's own.
REASON_CODES = {
    "amount": "AMOUNT_SIGNAL",
    "account_age_days": "ACCOUNT_AGE_SIGNAL",
    "transactions_last_24h": "RECENT_ACTIVITY_SIGNAL",
    "avg_amount_last_30d": "CUSTOMER_AVERAGE_AMOUNT_SIGNAL",
    "device_age_days": "DEVICE_AGE_SIGNAL",
    "distance_from_home_km": "DISTANCE_FROM_HOME_SIGNAL",
    "hour": "HOUR_SIGNAL",
    "currency": "CURRENCY_SIGNAL",
    "merchant_category": "MERCHANT_CATEGORY_SIGNAL",
    "country": "COUNTRY_SIGNAL",
    "transaction_type": "TRANSACTION_TYPE_SIGNAL",
    "channel": "CHANNEL_SIGNAL",
    "is_international": "INTERNATIONAL_SIGNAL",
}
DESCRIPTIONS = {
    "AMOUNT_SIGNAL": "Transaction amount contributed to the model risk score.",
    "ACCOUNT_AGE_SIGNAL": "Account age contributed to the model risk score.",
    "RECENT_ACTIVITY_SIGNAL": "Recent activity contributed to the model risk score.",
    "CUSTOMER_AVERAGE_AMOUNT_SIGNAL": "Customer average amount contributed to the model risk score.",
    "DEVICE_AGE_SIGNAL": "Device age contributed to the model risk score.",
    "DISTANCE_FROM_HOME_SIGNAL": "Distance from home contributed to the model risk score.",
    "HOUR_SIGNAL": "Transaction hour contributed to the model risk score.",
    "CURRENCY_SIGNAL": "Currency contributed to the model risk score.",
    "MERCHANT_CATEGORY_SIGNAL": "Merchant category contributed to the model risk score.",
    "COUNTRY_SIGNAL": "Country contributed to the model risk score.",
    "TRANSACTION_TYPE_SIGNAL": "Transaction type contributed to the model risk score.",
    "CHANNEL_SIGNAL": "Channel contributed to the model risk score.",
    "INTERNATIONAL_SIGNAL": "International status contributed to the model risk score.",
}
STEPS = ("validate", "score", "explain", "collect_evidence", "assess", "finalize")

TXN = """txn AS (
SELECT 'txn_' || e.event_id AS external_id, 'customer_' || e.user_id AS customer_id, e.value AS amount,
 CASE r.r_name WHEN 'AMERICA' THEN 'USD' WHEN 'EUROPE' THEN 'EUR' ELSE 'BRL' END AS currency,
 c.c_mktsegment AS merchant_category, chr(65 + n.n_nationkey) || chr(65 + n.n_regionkey) AS country,
 'device_' || (e.user_id * 3 + e.event_id % 3) AS device_id, e.ts AS occurred_at,
 CASE e.user_id % 3 WHEN 0 THEN 'purchase' WHEN 1 THEN 'transfer' ELSE 'withdrawal' END AS transaction_type,
 e.event_type AS channel, r.r_name <> 'AMERICA' AS is_international,
 CAST(date_diff('day', DATE '2022-01-01', CAST(e.ts AS DATE)) + e.user_id % 365 AS INTEGER) AS account_age_days,
 CAST(count(*) OVER (PARTITION BY e.user_id ORDER BY e.ts RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS INTEGER) AS transactions_last_24h,
 avg(e.value) OVER (PARTITION BY e.user_id ORDER BY e.ts RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW) AS avg_amount_last_30d,
 CAST(e.event_id % 700 + 1 AS INTEGER) AS device_age_days, abs(c.c_acctbal) / 100 AS distance_from_home_km,
 CAST(hour(e.ts) AS INTEGER) AS hour, CAST(CASE WHEN e.k >= 90 THEN 1 ELSE 0 END AS INTEGER) AS is_fraud, e.k,
 CAST(floor(0.5::DOUBLE * e.k + 2 * hour(e.ts)) AS DOUBLE) / 100 AS p,
 CAST(floor(e.k * 0.3::DOUBLE + e.value % 50) AS DOUBLE) / 100 AS p2
FROM (SELECT *, CAST(props->>'$.k' AS INTEGER) AS k FROM events) e
LEFT JOIN customer c ON e.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

PARTED = """ranked AS (SELECT *, row_number() OVER (ORDER BY occurred_at, external_id) AS rn, count(*) OVER () AS n FROM txn),
cuts AS (SELECT *, CAST(floor(n * 0.70::DOUBLE) AS BIGINT) AS train_end, CAST(floor(n * 0.15::DOUBLE) AS BIGINT) AS val_rows FROM ranked),
parted AS (SELECT *, CASE WHEN rn <= train_end THEN 'train' WHEN rn <= train_end + val_rows THEN 'validation' ELSE 'test' END AS split FROM cuts)"""

SCORES = "s AS (SELECT is_fraud AS y, p FROM txn)"
VALIDATION = "s AS (SELECT is_fraud AS y, p FROM parted WHERE split = 'validation')"

DIRTY = """dirty AS (SELECT * REPLACE (
 CASE k WHEN 1 THEN NULL WHEN 2 THEN -1.0 WHEN 3 THEN 'NaN'::DOUBLE WHEN 4 THEN 'Infinity'::DOUBLE ELSE amount END AS amount,
 CASE k WHEN 5 THEN 24 ELSE hour END AS hour,
 CASE k WHEN 6 THEN 'US' WHEN 11 THEN NULL ELSE currency END AS currency,
 CASE k WHEN 7 THEN 'BRA' WHEN 12 THEN NULL ELSE country END AS country,
 CASE k WHEN 8 THEN '  ' || chr(9) || ' ' ELSE merchant_category END AS merchant_category,
 CASE k WHEN 9 THEN -1 ELSE transactions_last_24h END AS transactions_last_24h,
 CASE k WHEN 10 THEN '  click' || chr(10) ELSE channel END AS channel) FROM txn)"""

TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


def time(column: str) -> str:
    return TIME.format(column)


def r8(expression: str, name: str) -> str:
    return f"round({expression}, 8) + 0.0 AS {name}"


def oracle(name: str, select: str, *ctes: str) -> None:
    """Register SQL; ``txn`` comes first when any given expression needs it."""
    ORACLES[name] = f"WITH {', '.join(ctes)} {select}" if ctes else select


def listed(columns) -> str:
    return ", ".join(columns)


DOUBLES = ("amount", "avg_amount_last_30d", "distance_from_home_km")


def plain(columns) -> str:
    out = []
    for c in columns:
        out.append(r8(c, c) if c in DOUBLES else f"{time(c)} AS {c}" if c == "occurred_at" else c)
    return listed(out)


# -- sources and contract -----------------------------------------------------------

REQUIRED = DEFAULT_CONTRACT.required
oracle("txn_source", f"SELECT {plain(REQUIRED)} FROM txn", TXN)
oracle("csv_roundtrip", f"SELECT {plain(REQUIRED)}, amount > 0 AS accepted FROM txn", TXN)
oracle(
    "store_projection",
    "SELECT external_id, CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) AS amount, currency, merchant_category,"
    f" country, device_id, {time('occurred_at')} AS occurred_at FROM txn",
    TXN,
)
oracle(
    "store_admission",
    f"SELECT customer_id AS external_id, {time('occurred_at')} AS occurred_at, CAST(1 AS BIGINT) AS copies,"
    " CASE WHEN row_number() OVER (PARTITION BY customer_id ORDER BY occurred_at) = 1 THEN 'accepted' ELSE 'duplicate_id' END AS outcome"
    " FROM txn",
    TXN,
)

oracle(
    "store_append_twice",
    "SELECT external_id, CAST(1 AS BIGINT) AS copies, 'stored' AS outcome FROM txn"
    " UNION ALL SELECT external_id, CAST(1 AS BIGINT), 'already_stored' FROM txn WHERE k >= 40 AND k < 60",
    TXN,
)

# Whichever of the writers comes first, the ids of both parts are stored once and refused once.
ORACLES["store_two_writers"] = ORACLES["store_stream"] = ORACLES["store_append_twice"]

_missing = " + ".join(
    f"count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c in DOUBLES else ''})" for c in REQUIRED
)
_rules = [
    ("not_empty", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"),
    ("required_columns", "0"),
    ("no_leakage_columns", "0"),
    ("no_missing_values", _missing),
    ("unique_id", "count(*) - count(DISTINCT external_id)"),
    ("positive_amount", "count(*) FILTER (WHERE amount <= 0)"),
    ("allowed_currency", "count(*) FILTER (WHERE currency IS NULL OR currency NOT IN ('BRL', 'EUR', 'USD'))"),
    ("country_code", "count(*) FILTER (WHERE country IS NULL OR NOT regexp_full_match(country, '[A-Z]{2}'))"),
    ("valid_timestamp", "count(*) FILTER (WHERE occurred_at IS NULL)"),
    ("binary_label", "count(*) FILTER (WHERE is_fraud IS NULL OR is_fraud NOT IN (0, 1))"),
    ("both_classes", "2 - count(DISTINCT is_fraud)"),
]
oracle(
    "contract_rules",
    " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, {i} AS ordinal, CAST({v} AS BIGINT) AS violations, ({v}) = 0 AS passed FROM dirty HAVING count(*) >= 0"
        for i, (rule, v) in enumerate(_rules, 1)
    ),
    TXN,
    DIRTY,
)
oracle(
    "duplicate_ids",
    "SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_ids, CAST(sum(n - 1) AS BIGINT) AS duplicates"
    " FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)",
)

STRIPPED = r"""stripped AS (SELECT * REPLACE (
 regexp_replace(merchant_category, '^\s+|\s+$', '', 'g') AS merchant_category,
 regexp_replace(channel, '^\s+|\s+$', '', 'g') AS channel) FROM dirty)"""


def _request_cases() -> list[tuple[str, str]]:
    cases = []
    for c in NUMERIC_FEATURES:
        number = f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END" if c in DOUBLES else c
        cases.append((f"{c}:missing", f"{c} IS NULL"))
        if c in DOUBLES:
            cases.append((f"{c}:not_finite", f"isnan({c}) OR isinf({c})"))
        if c == "amount":
            cases.append((f"{c}:not_positive", f"({number}) <= 0"))
        elif c == "hour":
            cases.append((f"{c}:out_of_range", f"{c} NOT BETWEEN 0 AND 23"))
        else:
            cases.append((f"{c}:negative", f"({number}) < 0"))
    for c in CATEGORICAL_FEATURES:
        cases.append((f"{c}:missing", f"{c} IS NULL"))
        if c == "currency":
            cases.append((f"{c}:bad_length", f"length({c}) <> 3"))
        elif c == "country":
            cases.append((f"{c}:bad_length", f"length({c}) <> 2"))
        elif c != "is_international":
            cases.append((f"{c}:blank", f"length({c}) = 0"))
    return cases


VIOLATIONS = (
    "checked AS (SELECT *, concat_ws(',', "
    + ", ".join(f"CASE WHEN {rule} THEN '{code}' END" for code, rule in _request_cases())
    + ") AS violations FROM stripped)"
)
CHECKED = (TXN, DIRTY, STRIPPED, VIOLATIONS)
oracle("request_violations", "SELECT external_id, violations FROM checked", *CHECKED)
oracle("quarantine_split", "SELECT external_id, channel, violations = '' AS accepted FROM checked", *CHECKED)
oracle(
    "score_rules",
    "SELECT count(*) AS rows, count(*) FILTER (WHERE y NOT IN (0, 1)) AS bad_labels, count(*) FILTER (WHERE y = 1) AS positives,"
    " count(*) FILTER (WHERE y = 0) AS negatives, count(*) FILTER (WHERE NOT isfinite(p)) AS non_finite_scores,"
    " count(*) FILTER (WHERE p NOT BETWEEN 0 AND 1) AS scores_out_of_range FROM s",
    TXN,
    SCORES,
)
oracle("feature_frame", f"SELECT external_id, {plain(DEFAULT_CONTRACT.features)} FROM txn", TXN)

# -- profile ------------------------------------------------------------------------


def rates_of(columns, source="txn") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(is_fraud) AS count,"
        f" CAST(sum(is_fraud) AS BIGINT) AS fraud_count, {r8('avg(is_fraud)', 'fraud_rate')} FROM {source} GROUP BY {c}"
        for c in columns
    )


oracle("category_rates", rates_of(CATEGORICAL_FEATURES), TXN)
oracle(
    "category_rates_with_missing",
    rates_of(["channel"], "holes"),
    TXN,
    "holes AS (SELECT * REPLACE (nullif(channel, 'error') AS channel) FROM txn)",
)


def summary(c: str, extra: str = "", group: str = "") -> str:
    quants = listed(
        r8(f"quantile_cont(CAST({c} AS DOUBLE), {q})", n)
        for q, n in ((0.25, "p25"), (0.5, "median"), (0.75, "p75"), (0.95, "p95"), (0.99, "p99"))
    )
    return (
        f"SELECT {extra}'{c}' AS feature, {r8(f'avg({c})', 'mean')}, {r8(f'stddev_samp({c})', 'std')},"
        f" {r8(f'CAST(min({c}) AS DOUBLE)', 'minimum')}, {r8(f'CAST(max({c}) AS DOUBLE)', 'maximum')}, {quants} FROM txn{group}"
    )


oracle("numeric_profile", " UNION ALL ".join(summary(c) for c in NUMERIC_FEATURES), TXN)
oracle(
    "numeric_profile_by_class",
    " UNION ALL ".join(summary(c, "is_fraud, ", " GROUP BY is_fraud") for c in NUMERIC_FEATURES),
    TXN,
)
oracle(
    "quantiles_distributed",
    " UNION ALL ".join(
        f"SELECT is_fraud, '{c}' AS feature, "
        + listed(
            r8(f"quantile_cont(CAST({c} AS DOUBLE), {q})", n)
            for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.95, "p95"), (0.99, "p99"))
        )
        + " FROM txn GROUP BY is_fraud"
        for c in NUMERIC_FEATURES
    ),
    TXN,
)
oracle(
    "class_balance",
    f"SELECT f AS fraud_count, n - f AS non_fraud_count, {r8('f / n', 'fraud_rate')}, {r8('(n - f) / n', 'non_fraud_rate')},"
    f" {r8('(n - f) / f', 'imbalance_ratio')} FROM (SELECT count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS f FROM txn)",
    TXN,
)
oracle(
    "table_overview",
    f"SELECT count(*) AS row_count, {len(REQUIRED)} AS column_count, {time('min(occurred_at)')} AS start_time,"
    f" {time('max(occurred_at)')} AS end_time FROM txn",
    TXN,
)
oracle(
    "missing_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c in DOUBLES else ''}) AS missing FROM dirty"
        for c in REQUIRED
    ),
    TXN,
    DIRTY,
)
oracle(
    "cardinality",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) AS distinct_values FROM (SELECT DISTINCT {c} FROM dirty)"
        for c in CATEGORICAL_FEATURES
    ),
    TXN,
    DIRTY,
)
oracle(
    "entity_counts",
    "SELECT count(DISTINCT customer_id) AS customer_id, count(DISTINCT device_id) AS device_id FROM txn",
    TXN,
)
oracle(
    "iqr_outliers",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) FILTER (WHERE v < lo OR v > hi) AS count,"
        f" {r8('count(*) FILTER (WHERE v < lo OR v > hi) / count(*)', 'rate')}, {r8('min(lo)', 'lower_bound')}, {r8('min(hi)', 'upper_bound')}"
        f" FROM (SELECT v, q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM (SELECT CAST({c} AS DOUBLE) AS v FROM txn),"
        f" (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM txn))"
        for c in NUMERIC_FEATURES
    ),
    TXN,
)
_matrix = [*NUMERIC_FEATURES, "is_fraud"]
MATRIX = (
    "matrix AS ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", {'max(1.0::DOUBLE)' if a == b else f'corr({a}, {b})'} AS r FROM txn"
        for a in _matrix
        for b in _matrix
    )
    + ")"
)
oracle("correlations", f'SELECT "left", "right", {r8("r", "r")} FROM matrix', TXN, MATRIX)
oracle(
    "amount_average_correlation",
    f"SELECT 'amount' AS \"left\", 'avg_amount_last_30d' AS \"right\", {r8('corr(amount, avg_amount_last_30d)', 'r')} FROM txn",
    TXN,
)
_upper = " OR ".join(
    f"(\"left\" = '{a}' AND \"right\" = '{b}')"
    for i, a in enumerate(NUMERIC_FEATURES)
    for b in NUMERIC_FEATURES[i + 1 :]
)
HIGH = f"({_upper}) AND abs(r) >= {LOW_CORRELATION}"
ASSOCIATED = f"\"right\" = 'is_fraud' AND \"left\" <> 'is_fraud' AND abs(r) >= {LOW_CORRELATION}"
oracle("high_correlations", f'SELECT "left", "right", {r8("r", "r")} FROM matrix WHERE {HIGH}', TXN, MATRIX)
oracle(
    "target_associations",
    f'SELECT "left" AS feature, {r8("r", "r")} FROM matrix WHERE {ASSOCIATED}',
    TXN,
    MATRIX,
)


def separation(columns) -> str:
    def of(c, f, y):
        return f"{f}(CASE WHEN is_fraud = {y} THEN {c} END)"

    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, coalesce({of(c, 'max', 0)} < {of(c, 'min', 1)} OR {of(c, 'max', 1)} < {of(c, 'min', 0)}, false) AS separated FROM txn"
        for c in columns
    )


oracle("numeric_separation", separation([*NUMERIC_FEATURES, "k"]), TXN)
oracle(
    "suspicious_categories",
    f"SELECT * FROM ({rates_of(['band', 'channel'], 'banded')}) WHERE count >= 50 AND fraud_rate IN (0, 1)",
    TXN,
    "banded AS (SELECT *, CAST(CAST(floor(k / 30) AS BIGINT) AS VARCHAR) AS band FROM txn)",
)
_roles = [
    *[("identifier", c) for c in ("external_id", "customer_id", "device_id")],
    ("temporal", "occurred_at"),
    ("target", "is_fraud"),
    ("explicit_leakage", "risk_score"),
]
_nothing = "CAST(NULL AS VARCHAR) AS other, CAST(NULL AS DOUBLE) AS value"
oracle(
    "leakage_audit",
    " UNION ALL ".join(
        [
            *[f"SELECT '{a}' AS finding, '{b}' AS subject, {_nothing}" for a, b in _roles],
            f"SELECT 'numeric_separation', feature, {_nothing} FROM ({separation(NUMERIC_FEATURES)}) WHERE separated",
            f"SELECT DISTINCT 'categorical_separation', feature, {_nothing} FROM ({rates_of(CATEGORICAL_FEATURES)}) WHERE count >= 50 AND fraud_rate IN (0, 1)",
            f"SELECT 'feature_correlation', \"left\", \"right\", {r8('r', 'value')} FROM matrix WHERE {HIGH}",
            f"SELECT 'target_association', \"left\", CAST(NULL AS VARCHAR), {r8('r', 'value')} FROM matrix WHERE {ASSOCIATED}",
        ]
    ),
    TXN,
    MATRIX,
)
oracle(
    "temporal_halves",
    f"SELECT CASE WHEN rn <= n // 2 THEN 'first' ELSE 'second' END AS half, {r8('avg(is_fraud)', 'fraud_rate')},"
    f" {r8('avg(CAST(is_international AS INTEGER))', 'international_rate')}, {r8('avg(transactions_last_24h)', 'transactions_last_24h_mean')},"
    f" {r8('median(amount)', 'amount_median')} FROM ranked GROUP BY 1",
    TXN,
    PARTED,
)

# -- order and split ------------------------------------------------------------------

oracle("chronological_rank", "SELECT external_id, rn AS rank FROM ranked", TXN, PARTED)
oracle("temporal_split", "SELECT external_id, split FROM parted", TXN, PARTED)
oracle("temporal_split_narrowed", "SELECT external_id, split FROM parted", TXN, PARTED)
oracle(
    "split_invariants",
    "SELECT 'rows_preserved' AS invariant, (SELECT count(*) FROM parted) = (SELECT count(*) FROM txn) AS passed"
    " UNION ALL SELECT 'chronological_order', (SELECT max(occurred_at) FROM parted WHERE split = 'train') <= (SELECT min(occurred_at) FROM parted WHERE split = 'validation')"
    " AND (SELECT max(occurred_at) FROM parted WHERE split = 'validation') <= (SELECT min(occurred_at) FROM parted WHERE split = 'test')"
    " UNION ALL SELECT 'both_classes', (SELECT min(c) FROM (SELECT count(DISTINCT is_fraud) AS c FROM parted GROUP BY split)) = 2",
    TXN,
    PARTED,
)
oracle(
    "split_summary",
    f"SELECT split, count(*) AS rows, CAST(sum(is_fraud) AS BIGINT) AS fraud_count, {r8('avg(is_fraud)', 'fraud_rate')},"
    f" {time('min(occurred_at)')} AS start_time, {time('max(occurred_at)')} AS end_time FROM parted GROUP BY split",
    TXN,
    PARTED,
)
_velocity = (
    "SELECT event_id AS external_id, CAST(count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS INTEGER) AS transactions_last_24h,"
    + " round(avg(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW), 8) + 0.0 AS avg_amount_last_30d FROM events"
)
oracle("velocity_features", _velocity)
oracle("velocity_stream", _velocity)
_spoiled = (
    "(SELECT event_id, ts, CASE WHEN user_id % 3 = 0 THEN 0 WHEN user_id % 3 = 1 THEN user_id END AS user_id,"
    " CASE WHEN event_id % 211 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 199 = 0 THEN NULL WHEN event_id % 197 = 0 THEN 1e17::DOUBLE"
    " WHEN event_id % 193 = 0 THEN 'Infinity'::DOUBLE ELSE value END AS value FROM events)"
)
# The look-back average by its definition, as this engine's window refuses values that are not numbers.
oracle(
    "velocity_hot_customers",
    "SELECT event_id AS external_id, CAST(count(*) OVER day AS INTEGER) AS transactions_last_24h,"
    " CASE WHEN count(value) OVER month = 0 THEN NULL"
    " WHEN count(*) FILTER (isnan(value)) OVER month > 0 THEN 'NaN'::DOUBLE"
    " WHEN count(*) FILTER (isinf(value)) OVER month > 0 THEN 'Infinity'::DOUBLE"
    " ELSE round(sum(CASE WHEN isfinite(value) THEN value ELSE 0 END) OVER month / count(value) OVER month, 8) + 0.0 END AS avg_amount_last_30d"
    f" FROM {_spoiled} WINDOW day AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW),"
    " month AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW)",
)

# -- metrics --------------------------------------------------------------------------


def cells(threshold: str) -> str:
    return (
        f"count(*) FILTER (WHERE y = 0 AND p < {threshold}) AS true_negative, count(*) FILTER (WHERE y = 0 AND p >= {threshold}) AS false_positive,"
        f" count(*) FILTER (WHERE y = 1 AND p < {threshold}) AS false_negative, count(*) FILTER (WHERE y = 1 AND p >= {threshold}) AS true_positive"
    )


COUNTS = "true_negative, false_positive, false_negative, true_positive"
RATES = listed(
    [
        r8("CASE WHEN true_positive + false_positive = 0 THEN 0 ELSE true_positive / (true_positive + false_positive) END", "precision"),
        r8("CASE WHEN true_positive + false_negative = 0 THEN 0 ELSE true_positive / (true_positive + false_negative) END", "recall"),
        r8("CASE WHEN 2 * true_positive + false_positive + false_negative = 0 THEN 0 ELSE 2 * true_positive / (2 * true_positive + false_positive + false_negative) END", "f1"),
    ]
)
ACCURACY = r8("(true_positive + true_negative) / (true_positive + true_negative + false_positive + false_negative)", "accuracy")
ALERTS = listed(
    [
        "true_positive + false_positive AS predicted_positive_count",
        r8("(true_positive + false_positive) / (true_positive + true_negative + false_positive + false_negative)", "predicted_positive_rate"),
        r8("CASE WHEN true_positive > 0 THEN (true_positive + false_positive) / true_positive END", "alerts_per_true_positive"),
    ]
)
SPLIT_SCORES = "s AS (SELECT split, is_fraud AS y, p FROM parted)"


def ranking(by: str, source: str = "s") -> str:
    """Common table expression ``ranking`` with both ranking metrics per group, by a definition of pairs and steps."""
    part = f"PARTITION BY {by} " if by else ""
    keys = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return (
        f"points AS (SELECT {keys}p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM {source} GROUP BY {keys}p),"
        f" curve AS (SELECT *, CAST(sum(pos) OVER ({part}ORDER BY p DESC) AS BIGINT) AS tp, CAST(sum(neg) OVER ({part}ORDER BY p DESC) AS BIGINT) AS fp,"
        f" CAST(sum(pos) OVER ({part.strip()}) AS BIGINT) AS positives, CAST(sum(neg) OVER ({part.strip()}) AS BIGINT) AS negatives FROM points),"
        f" ranking AS (SELECT {keys}CASE WHEN min(positives) > 0 AND min(negatives) > 0 THEN sum(neg * (tp - pos / 2)) / (min(positives) * min(negatives)) END AS roc_auc,"
        f" CASE WHEN min(positives) > 0 AND min(negatives) > 0 THEN sum(pos * (tp / (tp + fp))) / min(positives) END AS average_precision FROM curve{group})"
    )


oracle("confusion", f"SELECT split, {cells('0.5')} FROM s GROUP BY split", TXN, PARTED, SPLIT_SCORES)
_ranked = f"{r8('roc_auc', 'roc_auc')}, {r8('average_precision', 'average_precision')}"


def compared(by: str) -> str:
    return (
        f"SELECT {by}, {COUNTS}, {RATES}, {ACCURACY}, {_ranked}"
        f" FROM (SELECT {by}, {cells('0.5')} FROM s GROUP BY {by}) JOIN ranking USING ({by})"
    )


oracle("split_metrics", compared("split"), TXN, PARTED, SPLIT_SCORES, ranking("split"))
oracle("roc_auc", f"SELECT {r8('roc_auc', 'roc_auc')} FROM ranking", TXN, SCORES, ranking(""))
oracle(
    "ranking_continuous",
    f"SELECT {_ranked} FROM ranking",
    TXN,
    "s AS (SELECT is_fraud AS y, CAST((CAST(substr(external_id, 5) AS BIGINT) * 7919) % 1000003 AS DOUBLE) / 1000003.0::DOUBLE AS p FROM txn)",
    ranking(""),
)
oracle(
    "average_precision",
    f"SELECT {r8('average_precision', 'average_precision')} FROM ranking",
    TXN,
    SCORES,
    ranking(""),
)
oracle(
    "threshold_metrics",
    f"SELECT split, 0.55::DOUBLE AS threshold, {COUNTS}, {RATES}, {ACCURACY}, {ALERTS} FROM (SELECT split, {cells('0.55')} FROM s GROUP BY split)",
    TXN,
    PARTED,
    SPLIT_SCORES,
)
oracle(
    "relative_cost",
    f"SELECT split, false_positive + 10 * false_negative AS cost_1_10, false_positive + 25 * false_negative AS cost_1_25 FROM (SELECT split, {cells('0.55')} FROM s GROUP BY split)",
    TXN,
    PARTED,
    SPLIT_SCORES,
)
oracle(
    "pr_curve",
    f"SELECT {r8('p', 'threshold')}, {r8('tp / (tp + fp)', 'precision')}, {r8('tp / positives', 'recall')} FROM curve UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE",
    TXN,
    SCORES,
    ranking(""),
)
oracle(
    "roc_curve",
    f"SELECT {r8('p', 'threshold')}, {r8('fp / negatives', 'false_positive_rate')}, {r8('tp / positives', 'true_positive_rate')}"
    " FROM (SELECT *, lag(tp) OVER w AS ptp, lag(fp) OVER w AS pfp, lead(tp) OVER w AS ntp, lead(fp) OVER w AS nfp FROM curve WINDOW w AS (ORDER BY p DESC))"
    " WHERE ptp IS NULL OR ntp IS NULL OR ntp - 2 * tp + ptp <> 0 OR nfp - 2 * fp + pfp <> 0"
    " UNION ALL SELECT 'Infinity'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE",
    TXN,
    SCORES,
    ranking(""),
)
SWEPT = f"threshold, {COUNTS}, {RATES}, {ALERTS}"


def sweep(candidates: str) -> str:
    """Every candidate against every distinct score, by plain counting."""
    return (
        f"grid AS ({candidates}), byscore AS (SELECT p, y, count(*) AS n FROM s GROUP BY p, y),"
        " swept AS (SELECT threshold, CAST(coalesce(sum(n) FILTER (WHERE y = 0 AND p < threshold), 0) AS BIGINT) AS true_negative,"
        " CAST(coalesce(sum(n) FILTER (WHERE y = 0 AND p >= threshold), 0) AS BIGINT) AS false_positive,"
        " CAST(coalesce(sum(n) FILTER (WHERE y = 1 AND p < threshold), 0) AS BIGINT) AS false_negative,"
        " CAST(coalesce(sum(n) FILTER (WHERE y = 1 AND p >= threshold), 0) AS BIGINT) AS true_positive"
        " FROM grid, byscore GROUP BY threshold)"
    )


EVERY_SCORE = "SELECT DISTINCT p AS threshold FROM s"
oracle("threshold_sweep", f"SELECT {SWEPT} FROM swept", TXN, SCORES, sweep(EVERY_SCORE))
oracle(
    "threshold_sweep_grid",
    f"SELECT {SWEPT} FROM swept",
    TXN,
    SCORES,
    sweep("SELECT i / 20 AS threshold FROM range(21) t(i)"),
)


def chosen(target: float) -> str:
    """The selection policy as successive cuts over the swept candidates."""

    def tied(column: str, table: str) -> str:
        best = f"(SELECT max({column}) FROM {table})"
        return f"abs({column} - {best}) <= 1e-12 + 1e-5 * abs({best})"

    return (
        "rated AS (SELECT *, CASE WHEN true_positive + false_positive = 0 THEN 0 ELSE true_positive / (true_positive + false_positive) END AS prec,"
        " true_positive / (true_positive + false_negative) AS rec FROM swept),"
        f" pool AS (SELECT *, (SELECT count(*) > 0 FROM rated WHERE rec >= {target}) AS ok FROM rated),"
        f" eligible AS (SELECT *, CASE WHEN ok THEN prec ELSE rec END AS a, CASE WHEN ok THEN rec ELSE prec END AS b FROM pool WHERE NOT ok OR rec >= {target}),"
        f" first AS (SELECT * FROM eligible WHERE {tied('a', 'eligible')}), second AS (SELECT * FROM first WHERE {tied('b', 'first')}),"
        " best AS (SELECT * FROM second ORDER BY threshold DESC LIMIT 1)"
    )


def selected(target: float) -> str:
    return (
        f"SELECT {SWEPT}, ok AS constraint_satisfied, {target}::DOUBLE AS target_recall,"
        " 'maximize precision subject to recall >= target' AS selection_policy FROM best"
    )


oracle("select_threshold", selected(0.6), TXN, PARTED, VALIDATION, sweep(EVERY_SCORE), chosen(0.6))
oracle(
    "select_threshold_fallback",
    selected(1.0),
    TXN,
    PARTED,
    VALIDATION,
    sweep("SELECT unnest([0.8::DOUBLE, 0.85::DOUBLE, 0.9::DOUBLE]) AS threshold"),
    chosen(1.0),
)
_test_cells = "(SELECT is_fraud AS y, p FROM parted WHERE split = 'test')"
oracle(
    "frozen_threshold",
    f"SELECT threshold, 'selected' AS rule, {COUNTS}, {RATES}, {ACCURACY}, {ALERTS} FROM (SELECT t.threshold AS threshold, {cells('t.threshold')} FROM {_test_cells}, (SELECT threshold FROM best) t GROUP BY t.threshold)"
    f" UNION ALL SELECT 0.5::DOUBLE, 'default', {COUNTS}, {RATES}, {ACCURACY}, {ALERTS} FROM (SELECT {cells('0.5')} FROM {_test_cells})",
    TXN,
    PARTED,
    VALIDATION,
    sweep(EVERY_SCORE),
    chosen(0.6),
)
oracle(
    "trivial_baseline",
    f"SELECT split, {r8('avg(1 - y)', 'accuracy')}, 0.0::DOUBLE AS recall FROM s GROUP BY split",
    TXN,
    PARTED,
    SPLIT_SCORES,
)
TWO_MODELS = "s AS (SELECT 'p' AS model, split, is_fraud AS y, p FROM parted UNION ALL SELECT 'p2', split, is_fraud, p2 FROM parted)"


def _evaluated(model: str) -> str:
    """The evaluation of one score column, by the plain counting used for the single queries."""
    one = f"s AS (SELECT y, p FROM both_ WHERE model = '{model}' AND split = 'validation')"
    rows = " UNION ALL ".join(
        f"SELECT '{model}' AS model, split, '{rule}' AS rule, t.threshold AS threshold, {cells('t.threshold')}"
        f" FROM both_, {source} t WHERE model = '{model}' AND split IN ('validation', 'test') GROUP BY split, t.threshold"
        for rule, source in (("selected", "(SELECT threshold FROM best)"), ("default", "(SELECT 0.5::DOUBLE AS threshold)"))
    )
    return (
        f"SELECT * FROM (WITH {one}, {sweep(EVERY_SCORE)}, {chosen(0.6)}, cells_ AS ({rows})"
        f" SELECT model, split, rule, threshold, {COUNTS}, {RATES}, {ACCURACY}, {ALERTS},"
        + "".join(f" CAST(false_positive + {c} * false_negative AS BIGINT) AS cost_1_{c}," for c in (10, 25, 50))
        + " (SELECT ok FROM best) AS constraint_satisfied, 0.6::DOUBLE AS target_recall, (SELECT round(rec, 8) + 0.0 FROM best) AS recall_reached FROM cells_)"
    )


_BOTH = TWO_MODELS.replace("s AS (", "both_ AS (", 1)
oracle(
    "threshold_evaluation",
    f"SELECT e.*, {_ranked} FROM ({_evaluated('p')} UNION ALL {_evaluated('p2')}) e JOIN ranking USING (model, split)",
    TXN,
    PARTED,
    _BOTH,
    ranking("model, split", "both_"),
)
oracle(
    "threshold_curves",
    f"SELECT model, 'pr' AS curve, {r8('p', 'threshold')}, {r8('tp / positives', 'x_axis')}, {r8('tp / (tp + fp)', 'y_axis')} FROM curve WHERE split = 'validation'"
    " UNION ALL SELECT DISTINCT model, 'pr', CAST(NULL AS DOUBLE), 0.0::DOUBLE, 1.0::DOUBLE FROM curve WHERE split = 'validation'"
    f" UNION ALL SELECT model, 'roc', {r8('p', 'threshold')}, {r8('fp / negatives', 'x_axis')}, {r8('tp / positives', 'y_axis')}"
    " FROM (SELECT *, lag(tp) OVER w AS ptp, lag(fp) OVER w AS pfp, lead(tp) OVER w AS ntp, lead(fp) OVER w AS nfp FROM curve WHERE split = 'validation' WINDOW w AS (PARTITION BY model ORDER BY p DESC))"
    " WHERE ptp IS NULL OR ntp IS NULL OR ntp - 2 * tp + ptp <> 0 OR nfp - 2 * fp + pfp <> 0"
    " UNION ALL SELECT DISTINCT model, 'roc', 'Infinity'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM curve WHERE split = 'validation'",
    TXN,
    PARTED,
    _BOTH,
    ranking("model, split", "both_"),
)
oracle("model_comparison", compared("model, split"), TXN, PARTED, TWO_MODELS, ranking("model, split"))
oracle(
    "model_lookup",
    f"SELECT model, split, {r8('roc_auc', 'roc_auc')} FROM ranking WHERE model = 'p2'",
    TXN,
    PARTED,
    TWO_MODELS,
    ranking("model, split"),
)
oracle(
    "metric_deltas",
    f"SELECT a.model, a.split, {r8('a.roc_auc - b.roc_auc', 'roc_auc_delta')}, {r8('a.average_precision - b.average_precision', 'average_precision_delta')}"
    " FROM ranking a JOIN ranking b ON a.split = b.split AND b.model = 'p' WHERE a.model <> 'p'",
    TXN,
    PARTED,
    TWO_MODELS,
    ranking("model, split"),
)
oracle(
    "score_sanity",
    "SELECT model, bool_and(isfinite(p)) AS probabilities_finite, bool_and(isfinite(p) AND p BETWEEN 0 AND 1) AS probabilities_in_range FROM s GROUP BY model",
    TXN,
    PARTED,
    TWO_MODELS,
)
PREVALENCE = r8(
    "(true_positive + false_negative) / (true_positive + false_negative + true_negative + false_positive)", "prevalence"
)
_performance = (
    f"SELECT {COUNTS}, {RATES}, {ACCURACY}, {_ranked}, {ALERTS}, {PREVALENCE} FROM (SELECT {cells('0.55')} FROM s), ranking"
)
oracle("performance_report", _performance, TXN, PARTED, VALIDATION, ranking(""))
oracle(
    "performance_one_class",
    _performance,
    TXN,
    "s AS (SELECT is_fraud AS y, p FROM txn WHERE is_fraud = 0)",
    ranking(""),
)
oracle(
    "document_label_metrics",
    compared("lang"),
    "s AS (SELECT lang, quality AS y, n_chars / (n_chars + 1000) AS p FROM documents JOIN labels USING (doc_id))",
    ranking("lang"),
)

# -- models ---------------------------------------------------------------------------

oracle(
    "standard_scaled",
    "SELECT external_id, "
    + listed(r8(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END", f"{c}_scaled") for c in NUMERIC_FEATURES)
    + " FROM parted, (SELECT "
    + listed(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC_FEATURES)
    + " FROM parted WHERE split = 'train')",
    TXN,
    PARTED,
)
_levels = {
    "currency": ("BRL", "EUR", "USD"),
    "channel": ("click", "error", "purchase", "signup"),
    "is_international": ("false", "true"),
}
oracle(
    "one_hot",
    "SELECT external_id, "
    + listed(
        f"CASE WHEN CAST({c} AS VARCHAR) = '{x}' THEN 1 ELSE 0 END AS \"{c}_{x}\"" for c, xs in _levels.items() for x in xs
    )
    + " FROM txn",
    TXN,
)
oracle(
    "balanced_weights",
    f"SELECT is_fraud, count(*) AS rows, {r8('(sum(count(*)) OVER ()) / (2 * count(*))', 'weight')} FROM parted WHERE split = 'train' GROUP BY is_fraud",
    TXN,
    PARTED,
)

# -- explanation ------------------------------------------------------------------------


def term(feature: str) -> str:
    if feature in FIXED_MODEL.numeric:
        mean, std, coefficient = FIXED_MODEL.numeric[feature]
        return f"((CAST({feature} AS DOUBLE) - {mean}::DOUBLE) / {std}::DOUBLE * {coefficient}::DOUBLE)"
    cases = " ".join(f"WHEN '{x}' THEN {c}::DOUBLE" for x, c in FIXED_MODEL.categorical[feature].items())
    return f"(CASE CAST({feature} AS VARCHAR) {cases} ELSE 0.0::DOUBLE END)"


def direction(expression: str) -> str:
    return f"CASE WHEN {expression} > 1e-12 THEN 'increases_risk' WHEN {expression} < -1e-12 THEN 'decreases_risk' ELSE 'neutral' END"


def sigmoid(z: str) -> str:
    return f"CASE WHEN {z} >= 0 THEN 1 / (1 + exp(-{z})) ELSE exp({z}) / (1 + exp({z})) END"


LOGIT = f"({FIXED_MODEL.intercept}::DOUBLE + " + " + ".join(term(f) for f in FIXED_MODEL.features) + ")"


def scored(source: str) -> str:
    return (
        f"scored AS (SELECT *, {sigmoid('z')} AS probability FROM (SELECT *, {LOGIT} AS z FROM {source}))"
    )


_round_p = "round(probability, 8) + 0.0"
oracle(
    "score_batch",
    f"SELECT external_id, CASE WHEN ok THEN 'completed' ELSE 'failed' END AS status, CASE WHEN ok THEN {_round_p} END AS probability,"
    f" CASE WHEN ok THEN probability >= {FIXED_MODEL.threshold} END AS prediction, CASE WHEN ok THEN {FIXED_MODEL.threshold}::DOUBLE END AS threshold,"
    f" CASE WHEN ok THEN '{FIXED_MODEL.name}' END AS model_name, CASE WHEN ok THEN '{FIXED_MODEL.version}' END AS artifact_version"
    " FROM (SELECT *, amount > 0 AS ok FROM scored)",
    TXN,
    scored("txn"),
)


def terms_of(source: str, columns: str = "") -> str:
    return "terms AS (" + " UNION ALL ".join(
        f"SELECT external_id, '{f}' AS feature, {i} AS position, {term(f)} AS c, '{REASON_CODES[f]}' AS code,"
        f" {'CAST(' + f + ' AS DOUBLE)' if f in FIXED_MODEL.numeric else 'CAST(NULL AS DOUBLE)'} AS value_num,"
        f" {'CAST(NULL AS VARCHAR)' if f in FIXED_MODEL.numeric else 'CAST(' + f + ' AS VARCHAR)'} AS value_str{columns} FROM {source}"
        for i, f in enumerate(FIXED_MODEL.features)
    ) + ")"


_contribution = f"{r8('c', 'contribution')}, {direction('c')} AS direction"
oracle("contributions", f"SELECT external_id, feature, {_contribution} FROM terms", TXN, terms_of("txn"))
oracle(
    "encoded_contributions",
    f"SELECT external_id, encoded_feature, feature, {_contribution} FROM ("
    + " UNION ALL ".join(
        f"SELECT external_id, '{encoded}' AS encoded_feature, '{f}' AS feature, "
        + (
            term(f)
            if f in FIXED_MODEL.numeric
            else f"CASE WHEN CAST({f} AS VARCHAR) = '{encoded.removeprefix(f'categorical__{f}_')}' THEN {FIXED_MODEL.categorical[f][encoded.removeprefix(f'categorical__{f}_')]}::DOUBLE ELSE 0.0::DOUBLE END"
        )
        + " AS c FROM txn"
        for encoded, f in FIXED_MODEL.encoded_features
    )
    + ")",
    TXN,
)
REASONS = (
    f"directed AS (SELECT *, {direction('c')} AS direction FROM terms),"
    " reasons AS (SELECT *, row_number() OVER (PARTITION BY external_id, direction ORDER BY abs(c) DESC, position) AS rank FROM directed WHERE direction <> 'neutral')"
)


def reasons(top: int) -> str:
    return (
        f"SELECT external_id, CAST(rank AS INTEGER) AS rank, code, feature, {r8('value_num', 'value_num')}, value_str, direction, {r8('c', 'contribution')} FROM reasons WHERE rank <= {top}"
    )


oracle("top_reasons", reasons(5), TXN, terms_of("txn"), REASONS)
oracle("top_reasons_limited", reasons(2), TXN, terms_of("txn"), REASONS)
oracle(
    "sigmoid",
    f"SELECT external_id, {r8(sigmoid('z'), 'probability')} FROM (SELECT external_id, (k - 50) * amount / 7 AS z FROM txn)",
    TXN,
)
oracle(
    "unknown_category",
    "SELECT external_id, 'country' AS feature, 0.0::DOUBLE AS contribution, 'neutral' AS direction FROM txn",
    TXN,
)

oracle(
    "fit_checks",
    "SELECT model, split, count(*) AS rows, count(*) FILTER (WHERE is_fraud = 1) AS positives, count(*) FILTER (WHERE is_fraud = 0) AS negatives, count(*) AS scores_in_range"
    " FROM parted, (SELECT unnest(['Logistic Regression', 'Random Forest', 'Gradient Boosting']) AS model) GROUP BY model, split",
    TXN,
    PARTED,
)
# Balanced weights make the first score 0; slopes are rounded to the fixed point of the fit.
_categories = ("currency", "merchant_category", "country", "transaction_type", "channel", "is_international")
oracle(
    "boosting_first_gains",
    "SELECT feature, level, count(*) AS rows, round((sum(g) / sum(h) * sum(g) + CASE WHEN count(*) < any_value(n) THEN (any_value(all_g) - sum(g)) / (any_value(all_h) - sum(h)) * (any_value(all_g) - sum(g)) END"
    " - any_value(all_g) / any_value(all_h) * any_value(all_g)) / 16777216, 6) AS gain FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level, g, h, n, all_g, all_h FROM slopes" for c in _categories)
    + ") GROUP BY feature, level",
    TXN,
    PARTED,
    "weighed AS (SELECT * EXCLUDE (n), count(*) OVER () AS n, CAST(count(*) OVER () AS DOUBLE) / (2 * count(*) OVER (PARTITION BY is_fraud)) AS w FROM parted WHERE split = 'train')",
    "slopes AS (SELECT *, sum(g) OVER () AS all_g, sum(h) OVER () AS all_h FROM (SELECT *, round_even(w * (0.5 - is_fraud) * 16777216, 0) AS g, round_even(w * 0.25 * 16777216, 0) AS h FROM weighed))",
)
oracle("logistic_gradient", "SELECT true AS at_optimum")

# A sound explanation rebuilds every row, and a reloaded model scores every row alike.
oracle("reconstruction_check", "SELECT count(*) AS rows, count(*) AS reconstructed FROM txn", TXN)
oracle(
    "artifact_check",
    "SELECT count(*) AS rows, true AS probability_allclose, 0.0::DOUBLE AS max_absolute_probability_difference,"
    " CAST(0 AS BIGINT) AS classification_disagreements FROM parted WHERE split = 'validation'",
    TXN,
    PARTED,
)

# -- investigation ------------------------------------------------------------------------

VALID = "valid AS (SELECT * FROM checked WHERE violations = '')"
INVESTIGATED = (*CHECKED, VALID, terms_of("valid"), REASONS)
EVIDENCE = (
    "evidence AS (SELECT *, row_number() OVER (PARTITION BY external_id ORDER BY CASE direction WHEN 'increases_risk' THEN 0 ELSE 1 END, rank) AS seq FROM reasons WHERE rank <= 5)"
)
_texts = " ".join(f"WHEN '{code}' THEN '{text}'" for code, text in DESCRIPTIONS.items())
oracle(
    "evidence",
    "SELECT external_id, 'evidence-' || lpad(CAST(seq AS VARCHAR), 3, '0') AS evidence_id, 'reason_code' AS evidence_type, 'model_explanation' AS source,"
    f" feature, {r8('value_num', 'value_num')}, value_str, direction, {r8('c', 'contribution')}, CASE code {_texts} END AS description FROM evidence",
    *INVESTIGATED,
    EVIDENCE,
)
oracle(
    "review_decision",
    f"SELECT external_id, CASE WHEN violations = '' THEN CASE WHEN probability >= {FIXED_MODEL.threshold} THEN 'manual_review' ELSE 'no_review' END END AS decision FROM scored",
    *CHECKED,
    scored("checked"),
)
oracle(
    "score_consistency",
    f"SELECT external_id, {r8('probability', 'probability')}, CASE WHEN k = 3 THEN NULL WHEN k = 1 THEN round(probability * 0.5, 8) ELSE round(probability, 8) END AS explained_probability,"
    " k NOT IN (1, 2, 3) AS consistent FROM scored",
    TXN,
    scored("txn"),
)
_full_trace = ",".join(f"{i}:{s}:completed" for i, s in enumerate(STEPS, 1))
_flat = (
    "SELECT external_id, CASE WHEN violations = '' THEN 'completed' ELSE 'failed' END AS status,"
    f" CASE WHEN violations = '' THEN CASE WHEN probability >= {FIXED_MODEL.threshold} THEN 'manual_review' ELSE 'no_review' END END AS decision,"
    " CASE WHEN violations = '' THEN round(probability, 8) END AS probability,"
    f" CASE WHEN violations = '' THEN probability >= {FIXED_MODEL.threshold} END AS prediction,"
    " CAST(coalesce(e.n, 0) AS INTEGER) AS evidence_count, e.features AS evidence_features,"
    f" CASE WHEN violations = '' THEN '{_full_trace}' ELSE '1:validate:failed' END AS trace"
    " FROM scored LEFT JOIN (SELECT external_id, count(*) AS n, string_agg(feature, ',' ORDER BY seq) AS features FROM evidence GROUP BY external_id) e USING (external_id)"
)
oracle("investigation_report", _flat, *INVESTIGATED, EVIDENCE, scored("checked"))
oracle("investigation_stream", _flat, *INVESTIGATED, EVIDENCE, scored("checked"))
oracle(
    "score_stream",
    f"SELECT external_id, CASE WHEN violations = '' THEN round(probability, 8) END AS probability,"
    f" CASE WHEN violations = '' THEN probability >= {FIXED_MODEL.threshold} END AS prediction, CASE WHEN violations = '' THEN 'completed' ELSE 'failed' END AS status FROM scored",
    *CHECKED,
    scored("checked"),
)

# -- monitoring -----------------------------------------------------------------------------

REF = "ref AS (SELECT * FROM parted WHERE split = 'train'), cur AS (SELECT * FROM parted WHERE split = 'validation')"
SIDES = (TXN, PARTED, REF)


def number(c: str) -> str:
    return f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END" if c in DOUBLES else c


def quality(source: str) -> str:
    """Common table expression ``quality`` with the quality row of a table."""
    features = DEFAULT_CONTRACT.features
    missing = {c: f"count(*) FILTER (WHERE ({number(c)}) IS NULL)" for c in features}
    infinite = " + ".join(f"count(*) FILTER (WHERE isinf({c}))" for c in DOUBLES)
    negative = " + ".join(
        f"count(*) FILTER (WHERE ({number(c)}) {'<=' if c == 'amount' else '<'} 0)" for c in NUMERIC_FEATURES if c != "hour"
    )
    return (
        "quality AS (SELECT *, CASE WHEN infinite_numeric_values + negative_domain_values + invalid_hours > 0 THEN 'critical'"
        " WHEN missing_rate > 0 OR invalid_currency_codes > 0 OR invalid_country_codes > 0 THEN 'warning' ELSE 'ok' END AS status FROM (SELECT count(*) AS row_count, "
        + listed(f"{m} AS missing_{c}" for c, m in missing.items())
        + f", {infinite} AS infinite_numeric_values, {negative} AS negative_domain_values, count(*) FILTER (WHERE hour < 0 OR hour > 23) AS invalid_hours,"
        " count(*) FILTER (WHERE currency IS NULL OR length(currency) <> 3) AS invalid_currency_codes,"
        " count(*) FILTER (WHERE country IS NULL OR length(country) <> 2) AS invalid_country_codes,"
        f" ({' + '.join(missing.values())}) / (greatest(count(*), 1) * {len(features)}) AS missing_rate,"
        f" count(*) - count(DISTINCT external_id) AS duplicate_external_ids FROM {source}))"
    )


oracle(
    "data_quality",
    f"SELECT * REPLACE (round(missing_rate, 8) + 0.0 AS missing_rate) FROM quality",
    TXN,
    DIRTY,
    quality("dirty"),
)


def edges(columns=NUMERIC_FEATURES) -> str:
    return "edges AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, list_sort(list_distinct(quantile_cont(CAST({c} AS DOUBLE), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS e FROM ref"
        for c in columns
    ) + ")"


def bins(columns=NUMERIC_FEATURES, current: str = "cur") -> str:
    sides = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {side} AS current, CAST({c} AS DOUBLE) AS v FROM {table}"
        for c in columns
        for side, table in (("false", "ref"), ("true", current))
    )
    return (
        f"long AS ({sides}), binned AS (SELECT long.feature, current, CAST(len(list_filter(e, lambda x: x <= v)) AS INTEGER) AS bin FROM long JOIN edges USING (feature)),"
        " bins AS (SELECT feature, bin, count(*) FILTER (WHERE NOT current) AS reference_count, count(*) FILTER (WHERE current) AS current_count FROM binned GROUP BY feature, bin),"
        " shares AS (SELECT feature, reference_count / sum(reference_count) OVER (PARTITION BY feature) AS r, current_count / sum(current_count) OVER (PARTITION BY feature) AS c FROM bins),"
        " psi AS (SELECT feature, sum((c - r) * ln((c + 1e-6) / (r + 1e-6))) AS psi FROM shares GROUP BY feature)"
    )


def level(expression: str) -> str:
    return f"CASE WHEN {expression} < 0.10 THEN 'low' WHEN {expression} < 0.25 THEN 'moderate' ELSE 'high' END"


SHIFTED = "shifted AS (SELECT * REPLACE (amount * 2.5::DOUBLE AS amount, distance_from_home_km + 100 AS distance_from_home_km, 'synthetic_drift_channel' AS channel) FROM {0})"
oracle(
    "psi_edges",
    f"SELECT feature, CAST(i AS INTEGER) AS position, {r8('e[i]', 'edge')} FROM (SELECT feature, e, unnest(range(1, len(e) + 1)) AS i FROM edges)",
    *SIDES,
    edges(),
)
oracle("psi_bins", "SELECT * FROM bins", *SIDES, edges(), bins())
oracle("psi", f"SELECT feature, {r8('psi', 'psi')} FROM psi", *SIDES, edges(), bins())


def facts(current: str) -> str:
    return "facts AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, (SELECT avg({c}) FROM ref) AS rm, (SELECT avg({c}) FROM {current}) AS cm,"
        f" (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM ref) AS rmed, (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM {current}) AS cmed"
        for c in NUMERIC_FEATURES
    ) + ")"


oracle(
    "numeric_drift",
    f"SELECT feature, {r8('psi', 'psi')}, {r8('rm', 'reference_mean')}, {r8('cm', 'current_mean')}, {r8('rmed', 'reference_median')}, {r8('cmed', 'current_median')}, {level('psi')} AS level FROM psi JOIN facts USING (feature)",
    *SIDES,
    SHIFTED.format("cur"),
    edges(),
    bins(current="shifted"),
    facts("shifted"),
)
CHANGED = (
    "ref2 AS (SELECT * REPLACE (CASE WHEN k < 5 THEN 'old' ELSE channel END AS channel) FROM ref),"
    " cur2 AS (SELECT * REPLACE (CASE WHEN k < 5 THEN NULL WHEN k < 9 THEN 'new' ELSE channel END AS channel) FROM cur)"
)


def category(reference: str, current: str) -> str:
    sides = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, {side} AS current FROM {table}"
        for c in CATEGORICAL_FEATURES
        for side, table in (("false", reference), ("true", current))
    )
    return (
        f"values_ AS ({sides}), cats AS (SELECT feature, value, count(*) FILTER (WHERE NOT current) AS rc, count(*) FILTER (WHERE current) AS cc FROM values_ GROUP BY feature, value),"
        " tvd AS (SELECT feature, 0.5 * sum(abs(rs - cs)) AS tvd, count(value) FILTER (WHERE rc > 0) AS reference_unique, count(value) FILTER (WHERE cc > 0) AS current_unique,"
        " count(*) FILTER (WHERE rc = 0) AS new_categories, count(*) FILTER (WHERE cc = 0) AS missing_categories FROM"
        " (SELECT *, rc / sum(rc) OVER (PARTITION BY feature) AS rs, cc / sum(cc) OVER (PARTITION BY feature) AS cs FROM cats) GROUP BY feature)"
    )


CATEGORIES = (*SIDES, CHANGED, category("ref2", "cur2"))
oracle("tvd", f"SELECT feature, {r8('tvd', 'tvd')}, {level('tvd')} AS level FROM tvd", *CATEGORIES)
oracle(
    "categorical_drift",
    f"SELECT feature, {r8('tvd', 'tvd')}, reference_unique, current_unique, new_categories, missing_categories, {level('tvd')} AS level FROM tvd",
    *CATEGORIES,
)
oracle(
    "category_changes",
    "SELECT feature, CASE WHEN rc = 0 THEN 'new' ELSE 'missing' END AS change, value FROM cats WHERE rc = 0 OR cc = 0",
    *CATEGORIES,
)


def score_bins(current: str = "cur", score: str = "p") -> str:
    """PSI of a score column under names that do not clash with the feature ones."""
    return (
        f"sedges AS (SELECT list_sort(list_distinct(quantile_cont({score}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS e FROM ref),"
        f" sbinned AS (SELECT false AS current, len(list_filter(e, lambda x: x <= {score})) AS bin FROM ref, sedges UNION ALL SELECT true, len(list_filter(e, lambda x: x <= {score})) FROM {current}, sedges),"
        " sbins AS (SELECT bin, count(*) FILTER (WHERE NOT current) AS rc, count(*) FILTER (WHERE current) AS cc FROM sbinned GROUP BY bin),"
        " spsi AS (SELECT sum((c - r) * ln((c + 1e-6) / (r + 1e-6))) AS psi FROM (SELECT rc / sum(rc) OVER () AS r, cc / sum(cc) OVER () AS c FROM sbins))"
    )


oracle(
    "score_monitoring",
    f"SELECT {r8('rm', 'reference_mean')}, {r8('cm', 'current_mean')}, alert_count, {r8('ar', 'alert_rate')}, {r8('rr', 'reference_alert_rate')}, {r8('med', 'current_median')}, {r8('p95', 'current_p95')},"
    f" {r8('ar - rr', 'alert_rate_absolute_change')}, {r8('CASE WHEN rr <> 0 THEN (ar - rr) / rr END', 'alert_rate_relative_change')}, {r8('psi', 'score_psi')}, {level('psi')} AS score_drift_level"
    " FROM (SELECT avg(p) AS cm, count(*) FILTER (WHERE p >= 0.55) AS alert_count, count(*) FILTER (WHERE p >= 0.55) / count(*) AS ar, quantile_cont(p, 0.5) AS med, quantile_cont(p, 0.95) AS p95 FROM cur),"
    " (SELECT avg(p) AS rm, count(*) FILTER (WHERE p >= 0.55) / count(*) AS rr FROM ref), spsi",
    *SIDES,
    score_bins(),
)
_bounds = (
    "(SELECT CAST(min(occurred_at) AS VARCHAR) FROM ref) AS reference_start, (SELECT CAST(max(occurred_at) AS VARCHAR) FROM ref) AS reference_end,"
    " (SELECT CAST(min(occurred_at) AS VARCHAR) FROM cur) AS current_start, (SELECT CAST(max(occurred_at) AS VARCHAR) FROM cur) AS current_end"
)
oracle("monitoring_periods", f"SELECT {_bounds}", *SIDES)


def status(quality_table: str = "quality") -> str:
    worst = "(SELECT max(m) FROM (SELECT max(psi) AS m FROM psi UNION ALL SELECT max(tvd) FROM tvd UNION ALL SELECT psi FROM spsi))"
    return (
        f"CASE WHEN (SELECT status FROM quality) = 'critical' OR {worst} >= 0.25 THEN 'critical'"
        f" WHEN (SELECT status FROM quality) = 'warning' OR {worst} >= 0.10 THEN 'warning' ELSE 'healthy' END AS status"
    )


def with_score(table: str, name: str) -> str:
    return f"{name} AS (SELECT *, {sigmoid('z')} AS probability FROM (SELECT *, {LOGIT} AS z FROM {table}))"


def report_parts(current: str) -> tuple[str, ...]:
    """Everything the summary needs for one current table; names are local to the statement."""
    return (
        with_score(f"(SELECT * FROM parted WHERE split = 'train')", "ref"),
        with_score(current, "now"),
        quality("now"),
        edges(),
        bins(current="now"),
        category("ref", "now"),
        score_bins("now", "probability"),
    )


CUR = "cur AS (SELECT * FROM parted WHERE split = 'validation')"
oracle(
    "monitoring_report",
    f"SELECT {_bounds}, '{FIXED_MODEL.version}' AS artifact_version, '{FIXED_MODEL.name}' AS model_name, {FIXED_MODEL.threshold}::DOUBLE AS threshold,"
    " (SELECT count(*) FROM ref) AS reference_rows, (SELECT count(*) FROM cur) AS current_rows, (SELECT status FROM quality) AS quality_status,"
    f" (SELECT round(psi, 8) + 0.0 FROM spsi) AS score_psi, {status()}",
    TXN,
    PARTED,
    CUR,
    *report_parts("cur"),
)


def batch_status(name: str, current: str) -> str:
    parts = ", ".join((TXN, PARTED, "cur AS (SELECT * FROM parted WHERE split = 'validation')", SHIFTED.format("cur"), *report_parts(current)))
    return f"SELECT * FROM (WITH {parts} SELECT '{name}' AS batch, (SELECT status FROM quality) AS quality_status, (SELECT round(psi, 8) + 0.0 FROM spsi) AS score_psi, {status()})"


ORACLES["monitoring_status"] = f"{batch_status('plain', 'cur')} UNION ALL {batch_status('shifted', 'shifted')}"
oracle(
    "what_if_shift",
    f"SELECT external_id, {r8('amount * 2.5::DOUBLE', 'amount')}, {r8('distance_from_home_km + 100', 'distance_from_home_km')}, 'synthetic_drift_channel' AS channel FROM txn",
    TXN,
)
_sections = (
    f"SELECT 0 AS batch, 'numeric' AS section, feature, {r8('psi', 'value')}, {level('psi')} AS level FROM psi"
    f" UNION ALL SELECT 0, 'categorical', feature, {r8('tvd', 'value')}, {level('tvd')} FROM tvd"
    f" UNION ALL SELECT 0, 'scores', NULL, {r8('psi', 'value')}, {level('psi')} FROM spsi"
    " UNION ALL SELECT 0, 'quality', NULL, CAST(row_count AS DOUBLE), status FROM quality"
    f" UNION ALL SELECT 0, 'summary', NULL, NULL, {status().removesuffix(' AS status')}"
)
oracle(
    "monitoring_run",
    "SELECT batch, section, feature, CASE WHEN section IN ('scores', 'summary') THEN 1.0::DOUBLE ELSE value END AS value,"
    f" CASE WHEN section IN ('scores', 'summary') THEN 'known' ELSE level END AS level FROM ({_sections})",
    TXN,
    PARTED,
    CUR,
    *report_parts("cur"),
)
oracle("report_json", _sections, TXN, PARTED, CUR, *report_parts("cur"))
oracle(
    "monitor_stream",
    _sections
    + " UNION ALL SELECT 1, 'quality', NULL, CAST(row_count AS DOUBLE), status FROM spoiled_quality"
    " UNION ALL SELECT 1, 'refused', NULL, NULL, 'data quality prevents scoring: missing or infinite features' FROM spoiled_quality",
    TXN,
    PARTED,
    CUR,
    *report_parts("cur"),
    DIRTY.replace("FROM txn)", "FROM cur)"),
    quality("dirty").replace("quality AS (", "spoiled_quality AS (", 1),
)

# One reading gives what the separate passes give.
ORACLES["checked_rules"] = ORACLES["contract_rules"]
ORACLES["checked_quality"] = ORACLES["data_quality"]
ORACLES["checked_scores"] = ORACLES["score_stream"]

# -- categories of many levels --------------------------------------------------------------

_many = ("device_id", "customer_id", "country")
_long = " UNION ALL ".join(f"SELECT {{more}}{i} AS feature_place, {c} AS level FROM {{source}}" for i, c in enumerate(_many))


def _levels_of(source: str) -> str:
    return (
        f"dictionary AS (SELECT CAST(feature_place AS INTEGER) AS feature_place, level, row_number() OVER (ORDER BY feature_place, level) - 1 AS position,"
        f" row_number() OVER (PARTITION BY feature_place ORDER BY level) - 1 AS index FROM (SELECT DISTINCT * FROM ({_long.format(more='', source=source)})))"
    )


_met = f"met AS (SELECT * FROM ({_long.format(more='external_id, amount, ', source='cur')}) LEFT JOIN dictionary USING (feature_place, level))"
oracle("level_dictionary", "SELECT * FROM dictionary", TXN, _levels_of("txn"))
oracle(
    "level_positions",
    "SELECT external_id, coalesce(string_agg(CAST(position AS VARCHAR), ',' ORDER BY position), '') AS positions FROM met GROUP BY external_id",
    *SIDES,
    _levels_of("ref"),
    _met,
)
_effect = ", ".join(f"coalesce(max(position % 97) FILTER (feature_place = {i}), 0) / 100.0::DOUBLE AS {c}" for i, c in enumerate(_many))
oracle(
    "level_contributions",
    f"SELECT external_id, {r8('amount', 'amount')}, {', '.join(r8(c, c) for c in _many)}, {r8('amount + device_id + customer_id + country - 0.5', 'logit')}"
    f" FROM (SELECT external_id, (any_value(amount) - 50) / 40 * 0.8 AS amount, {_effect} FROM met GROUP BY external_id)",
    *SIDES,
    _levels_of("ref"),
    _met,
)

# -- rolling reference ----------------------------------------------------------------------

# The window after it has moved by five days, read in one pass.
_rolled = (
    "ref AS (SELECT * FROM (SELECT *, CAST(occurred_at AS DATE) AS day, min(CAST(occurred_at AS DATE)) OVER () AS first_day FROM txn)"
    " WHERE day BETWEEN first_day + 5 AND first_day + 24)"
)
oracle("rolling_edges", f"SELECT feature, CAST(i AS INTEGER) AS position, {r8('e[i]', 'edge')} FROM (SELECT feature, e, unnest(range(1, len(e) + 1)) AS i FROM edges)", TXN, _rolled, edges())
oracle(
    "rolling_summary",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) AS rows, {r8(f'avg({c})', 'mean')}, {r8(f'min({c}::DOUBLE)', 'min')}, {r8(f'quantile_cont({c}::DOUBLE, 0.5)', 'median')}, {r8(f'max({c}::DOUBLE)', 'max')} FROM ref"
        for c in NUMERIC_FEATURES
    ),
    TXN,
    _rolled,
)


# -- drift by day ---------------------------------------------------------------------------

_MEASURED = (*NUMERIC_FEATURES, "probability")
# A day is closed when the newest time lies a day past its end.
_day_parts = (
    "ref AS (SELECT *, p AS probability FROM parted WHERE split = 'train'),"
    " days AS (SELECT * FROM (SELECT *, p AS probability, CAST(occurred_at AS DATE) AS day, max(occurred_at) OVER () AS newest FROM parted WHERE split = 'validation')"
    " WHERE day < CAST(newest - INTERVAL 1 DAY AS DATE))"
)


def _day_values(columns, cast: str) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({day} AS DATE) AS day, '{c}' AS feature, CAST({c} AS {cast}) AS v FROM {source}"
        for c in columns
        for day, source in (("NULL", "ref"), ("day", "days"))
    )


def _day_shares(values: str, value: str, name: str) -> str:
    """Shares of every value of either side, for the reference (r) and each day (c)."""
    return (
        f"{name}_counts AS (SELECT day, feature, {value} AS value, count(*) AS n FROM {values} GROUP BY ALL),"
        f" {name}_shares AS (SELECT *, n / sum(n) OVER (PARTITION BY day, feature) AS share FROM {name}_counts),"
        f" {name}_grid AS (SELECT d.day, v.feature, v.value FROM (SELECT DISTINCT day FROM days) d, (SELECT DISTINCT feature, value FROM {name}_counts) v),"
        f" {name}_met AS (SELECT g.day, g.feature, g.value, coalesce(r.share, 0) AS r, coalesce(c.share, 0) AS c FROM {name}_grid g"
        f" LEFT JOIN {name}_shares r ON r.day IS NULL AND r.feature = g.feature AND r.value = g.value"
        f" LEFT JOIN {name}_shares c ON c.day = g.day AND c.feature = g.feature AND c.value = g.value)"
    )


_NO_LONG, _NO_DOUBLE = "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)"
oracle(
    "daily_drift",
    f"SELECT day, feature, {r8('psi', 'drift')}, {level('psi')} AS level, rows, {_NO_LONG} AS refused, CASE WHEN feature = 'probability' THEN alerts END AS alert_count, {r8('reference_mean', 'reference_mean')},"
    f" {r8('mean', 'current_mean')}, {r8('median', 'current_median')}, {r8('p95', 'current_p95')}, {_NO_LONG} AS new_categories, {_NO_LONG} AS missing_categories FROM numbers"
    f" UNION ALL SELECT day, feature, {r8('tvd', 'drift')}, {level('tvd')}, rows, NULL, NULL, NULL, NULL, NULL, NULL, new_categories, missing_categories FROM texts"
    f" UNION ALL SELECT day, NULL, {_NO_DOUBLE}, status, rows, 0, alerts, NULL, NULL, NULL, NULL, NULL, NULL FROM whole",
    TXN,
    PARTED,
    _day_parts,
    edges(_MEASURED),
    f"day_long AS ({_day_values(_MEASURED, 'DOUBLE')}),"
    " day_binned AS (SELECT day, feature, v, len(list_filter(e, lambda x: x <= v)) AS bin FROM day_long JOIN edges USING (feature))",
    _day_shares("day_binned", "bin", "bin"),
    f"day_texts AS ({_day_values(CATEGORICAL_FEATURES, 'VARCHAR')})",
    _day_shares("day_texts", "v", "text"),
    "numbers AS (SELECT * FROM (SELECT day, feature, sum((c - r) * ln((c + 1e-6) / (r + 1e-6))) AS psi FROM bin_met GROUP BY ALL)"
    " JOIN (SELECT day, feature, count(*) AS rows, avg(v) AS mean, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.95) AS p95 FROM day_long WHERE day IS NOT NULL GROUP BY ALL) USING (day, feature)"
    " JOIN (SELECT feature, avg(v) AS reference_mean FROM day_long WHERE day IS NULL GROUP BY ALL) USING (feature)"
    " JOIN (SELECT day, count(*) FILTER (WHERE p >= " + str(FIXED_MODEL.threshold) + ") AS alerts FROM days GROUP BY day) USING (day))",
    "texts AS (SELECT * FROM (SELECT day, feature, 0.5 * sum(abs(r - c)) AS tvd, count(*) FILTER (WHERE r = 0 AND c > 0) AS new_categories, count(*) FILTER (WHERE r > 0 AND c = 0) AS missing_categories FROM text_met GROUP BY ALL)"
    " JOIN (SELECT day, count(*) AS rows FROM days GROUP BY day) USING (day))",
    "worst AS (SELECT day, max(psi) AS drift FROM numbers GROUP BY day UNION ALL SELECT day, max(tvd) FROM texts GROUP BY day),"
    " whole AS (SELECT day, max(rows) AS rows, max(alerts) AS alerts, any_value(status) AS status FROM numbers"
    " JOIN (SELECT day, CASE WHEN max(drift) >= 0.25 THEN 'critical' WHEN max(drift) >= 0.10 THEN 'warning' ELSE 'healthy' END AS status FROM worst GROUP BY day) USING (day) GROUP BY day)",
)
