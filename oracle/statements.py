"""One DuckDB statement per registered query."""

from __future__ import annotations

from itertools import combinations

from oracle.models import STAMP, hits, statement

_MODEL_KEYS = (
    "cur_users",
    "cur_chargers",
    "cur_payments",
    "cur_transactions",
    "dim_dates",
    "dim_users",
    "dim_chargers",
    "dim_cities",
    "fact_transactions",
    "fact_daily_metrics",
    "fact_charger_performance",
    "charger_lifetime",
    "charger_quartiles",
)

_KEY_NUMBER = "CAST(substr(session_id, 2) AS BIGINT)"
_ISSUES = (
    "is_invalid_amount",
    "is_outlier_amount",
    "is_end_time_earlier",
    "is_negative_kwh",
    "is_outlier_kwh_consumed",
    "is_outlier_charging_time",
)
_TREND = {
    "valid_transactions": "is_valid_transaction",
    "transactions_with_issues": "has_any_quality_issue",
    "missing_amount": "is_missing_payment_amount",
    "invalid_amount": "is_invalid_payment_amount",
    "invalid_time": "is_invalid_time_range",
    "missing_kwh": "is_missing_kwh",
    "negative_kwh": "is_negative_kwh",
    "outlier_kwh": "is_outlier_kwh",
    "outlier_duration": "is_outlier_duration",
    "outlier_amount": "is_outlier_payment_amount",
}
_SHARES = ", ".join(
    f"round_even({c}::DOUBLE / total_transactions::DOUBLE * 100, 2) AS {c}_pct" for c in _TREND
)
_TREND_DAILY = f"""
SELECT *, {_SHARES} FROM (
  SELECT transaction_date, CAST(date_trunc('week', transaction_date) AS DATE) AS week_start_date,
    count(*) AS total_transactions, {', '.join(f'{hits(flag)} AS {c}' for c, flag in _TREND.items())}
  FROM fact_transactions GROUP BY transaction_date) d"""
_ISSUE_TYPES = {
    "All Issues": "transactions_with_issues_pct",
    "Missing Amount": "missing_amount_pct",
    "Invalid Amount": "invalid_amount_pct",
    "Invalid Time Range": "invalid_time_pct",
    "Missing kWh": "missing_kwh_pct",
    "Negative kWh": "negative_kwh_pct",
    "Outlier kWh": "outlier_kwh_pct",
    "Outlier Duration": "outlier_duration_pct",
    "Outlier Amount": "outlier_amount_pct",
}
_THRESHOLDS = (
    f"WITH trend AS ({_TREND_DAILY}), stats AS ("
    + " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS issue_type, avg({c}) AS mean_pct, max({c}) AS max_pct, "
        f"round_even(greatest(avg({c}) + 1.5 * stddev_samp({c}), 2.0), 1) AS threshold FROM trend"
        for i, (name, c) in enumerate(_ISSUE_TYPES.items(), 1)
    )
    + ") SELECT * FROM stats"
)
_SCORECARD = {
    "valid_transactions": "is_valid_transaction",
    "missing_payments": "is_missing_payment",
    "missing_payment_amount": "is_missing_payment_amount",
    "invalid_payment_amount": "is_invalid_payment_amount",
    "invalid_time_range": "is_invalid_time_range",
    "missing_kwh": "is_missing_kwh",
    "negative_kwh": "is_negative_kwh",
    "outlier_kwh": "is_outlier_kwh",
    "outlier_duration": "is_outlier_duration",
    "outlier_payment_amount": "is_outlier_payment_amount",
}
_BREAKDOWN = {
    "Missing Amount": "is_missing_payment_amount",
    "Invalid Amount": "is_invalid_payment_amount",
    "Invalid Time": "is_invalid_time_range",
    "Missing kWh": "is_missing_kwh",
    "Negative kWh": "is_negative_kwh",
    "Outlier kWh": "is_outlier_kwh",
    "Outlier Duration": "is_outlier_duration",
    "Outlier Amount": "is_outlier_payment_amount",
}
_KPI = """
SELECT period, total_revenue, total_energy_kwh, active_chargers, active_users, total_transactions,
  CASE WHEN total_transactions > 0 THEN total_revenue::DOUBLE / total_transactions::DOUBLE ELSE 0 END
    AS avg_revenue_per_transaction
FROM (
  SELECT CASE WHEN d.date_actual >= DATE '2001-07-01' THEN 'Current Month' ELSE 'Previous Month' END AS period,
    SUM(f.valid_revenue) AS total_revenue, SUM(f.valid_energy_kwh) AS total_energy_kwh,
    MAX(f.active_chargers) AS active_chargers, MAX(f.active_users) AS active_users,
    CAST(SUM(f.valid_transactions) AS BIGINT) AS total_transactions
  FROM fact_daily_metrics f JOIN dim_dates d ON f.transaction_date_key = d.date_key
  WHERE f.city_name = '_ALL_CITIES_' AND d.date_actual BETWEEN DATE '2001-06-01' AND DATE '2001-07-31'
  GROUP BY 1) k"""
_KPIS = {
    "Total Revenue": "total_revenue",
    "Energy Delivered (kWh)": "total_energy_kwh",
    "Active Chargers": "active_chargers",
    "Active Users": "active_users",
    "Transactions": "total_transactions",
    "Avg Revenue/Txn": "avg_revenue_per_transaction",
}
_IN_TREND = "transaction_date BETWEEN DATE '2001-07-31' - 89 AND DATE '2001-07-31'"
_TREND_ROWS = f"""
SELECT transaction_date, city_name, valid_revenue AS total_revenue, valid_transactions AS total_transactions,
  active_users, active_chargers
FROM fact_daily_metrics WHERE {_IN_TREND} AND city_name <> '_ALL_CITIES_'"""
_NEAREST = """
SELECT charger_id, city, place, place_city, km FROM (
  SELECT c.charger_id, c.city, p.place, p.place_city, CASE WHEN p.place IS NOT NULL THEN 1 END * 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(p.lat - c.latitude) / 2), 2)
      + cos(radians(c.latitude)) * cos(radians(p.lat)) * pow(sin(radians(p.lon - c.longitude) / 2), 2)))) AS km
  FROM eda_chargers c LEFT JOIN fx_places p ON c.latitude IS NOT NULL AND c.longitude IS NOT NULL) d
QUALIFY row_number() OVER (PARTITION BY charger_id ORDER BY km, place) = 1"""


def _described(column: str, units: str, kind: str) -> str:
    digits = 0 if kind == "time" else 4
    return f"""
SELECT '{column}' AS column_name, count(x) AS "count", NULL::BIGINT AS "unique", NULL::VARCHAR AS top,
  NULL::BIGINT AS freq, ROUND(avg(x), {digits}) AS mean, ROUND(stddev_samp(x), {digits}) AS std, min(x) AS "min",
  ROUND(quantile_cont(x, 0.25), 4) AS p25, ROUND(quantile_cont(x, 0.5), 4) AS p50,
  ROUND(quantile_cont(x, 0.75), 4) AS p75, max(x) AS "max"
FROM (SELECT CAST({units} AS DOUBLE) AS x FROM eda_master) v"""


def _categories(column: str) -> str:
    return f"""
SELECT '{column}' AS column_name, CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique",
  (SELECT CAST(min(v) AS VARCHAR) FROM (SELECT {column} AS v, count(*) AS n FROM eda_master WHERE {column} IS NOT NULL GROUP BY 1) a
   WHERE n = max(f.n)) AS top, max(n) AS freq, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS "min",
  NULL::DOUBLE AS p25, NULL::DOUBLE AS p50, NULL::DOUBLE AS p75, NULL::DOUBLE AS "max"
FROM (SELECT {column} AS v, count(*) AS n FROM eda_master WHERE {column} IS NOT NULL GROUP BY 1) f"""


def _moments(column: str) -> str:
    return f"""
SELECT '{column}' AS column_name, count(x) AS n, count(*) - count(x) AS n_missing, {hits('x = 0')} AS n_zeros,
  {hits('x < 0')} AS n_negative, ROUND(sum(x), 4) AS sum, ROUND(avg(x), 4) AS mean, ROUND(var_samp(x), 4) AS variance,
  ROUND(stddev_samp(x), 4) AS std, ROUND(min(x), 4) AS "min", ROUND(max(x), 4) AS "max",
  ROUND(skewness(x), 4) AS skewness, ROUND(kurtosis(x), 4) AS kurtosis, ROUND(max(x) - min(x), 4) AS "range"
FROM (SELECT CAST({column} AS DOUBLE) AS x FROM eda_master) v"""


def _column_profile(position: int, column: str, kind: str) -> str:
    return f"""
SELECT {position} AS position, '{column}' AS column_name, '{kind}' AS data_type, r.n AS n_rows, r.missing AS n_missing,
  r.missing::DOUBLE / r.n::DOUBLE AS p_missing, d.n_distinct, d.n_unique
FROM (SELECT count(*) AS n, count(*) - count({column}) AS missing FROM stg_payments) r CROSS JOIN
  (SELECT count(*) AS n_distinct, {hits('n = 1')} AS n_unique
   FROM (SELECT {column}, count(*) AS n FROM stg_payments WHERE {column} IS NOT NULL GROUP BY 1) g) d"""


#: Columns of the profiled frames: name, type, kind.
_STAMPS = (("_loaded_at", "timestamp_ntz", "time"), ("_source_file", "string", "text"))
FRAMES = {
    "chargers": ("stg_chargers", (
        ("charger_id", "string", "text"), ("city", "string", "text"), ("latitude", "double", "number"),
        ("longitude", "double", "number"), ("installed_at", "timestamp_ntz", "time"), *_STAMPS)),
    "payments": ("stg_payments", (
        ("payment_id", "string", "text"), ("session_id", "string", "text"), ("user_id", "string", "text"),
        ("amount", "decimal(10,2)", "number"), ("currency", "string", "text"), *_STAMPS)),
    "users": ("stg_users", (
        ("user_id", "string", "text"), ("name", "string", "text"), ("email", "string", "text"), ("tier", "string", "text"),
        ("created_at", "timestamp_ntz", "time"), *_STAMPS)),
    "transactions": ("stg_transactions", (
        ("session_id", "string", "text"), ("user_id", "string", "text"), ("charger_id", "string", "text"),
        ("start_time", "timestamp_ntz", "time"), ("end_time", "timestamp_ntz", "time"),
        ("kwh_consumed", "decimal(10,4)", "number"), ("payment_method", "string", "text"), ("status", "string", "text"),
        *_STAMPS)),
    "master": ("eda_master", (
        ("session_id", "string", "text"), ("user_id", "string", "text"), ("charger_id", "string", "text"),
        ("payment_id", "string", "text"), ("tier", "string", "text"), ("installed_at", "timestamp_ntz", "time"),
        ("city", "string", "text"), ("start_time", "timestamp_ntz", "time"), ("end_time", "timestamp_ntz", "time"),
        ("charging_time", "double", "number"), ("kwh_consumed", "decimal(10,4)", "number"),
        ("cost_per_kwh", "double", "number"), ("payment_method", "string", "text"), ("amount", "decimal(10,2)", "number"),
        ("status", "string", "text"), ("is_invalid_location", "boolean", "flag"), ("is_invalid_amount", "boolean", "flag"),
        ("is_outlier_amount", "boolean", "flag"), ("is_end_time_earlier", "boolean", "flag"),
        ("is_negative_kwh", "boolean", "flag"), ("is_outlier_kwh_consumed", "boolean", "flag"),
        ("is_outlier_charging_time", "boolean", "flag"), ("has_issues", "boolean", "flag"), ("total_issues", "int", "number"))),
}


def _profiled(frame: str, source: str, position: int, column: str, kind_of: str, kind: str) -> str:
    x = {"number": f"CAST({column} AS DOUBLE)", "time": f"CAST(epoch({column}) AS DOUBLE)"}.get(kind, "NULL::DOUBLE")
    digits = 0 if kind == "time" else 4
    text = f"length({column})" if kind == "text" else "NULL::INTEGER"
    number = kind == "number"
    return f"""
SELECT '{frame}' AS frame_name, {position} AS position, '{column}' AS column_name, '{kind_of}' AS data_type, '{kind}' AS kind,
  n_rows, n_missing, ROUND(n_missing::DOUBLE / n_rows::DOUBLE, 4) AS p_missing, n_distinct, n_unique,
  {"top" if kind in ("text", "flag") else "NULL::VARCHAR"} AS top, freq, {"n_zeros" if number else "NULL::BIGINT"} AS n_zeros,
  {"n_negative" if number else "NULL::BIGINT"} AS n_negative, ROUND(mean, {digits}) AS mean, ROUND(std, {digits}) AS std,
  low AS "min", ROUND(p25, 4) AS p25, ROUND(p50, 4) AS p50, ROUND(p75, 4) AS p75, high AS "max",
  {"ROUND(skew, 4)" if number else "NULL::DOUBLE"} AS skewness, {"ROUND(kurt, 4)" if number else "NULL::DOUBLE"} AS kurtosis,
  min_length, max_length, ROUND(mean_length, 4) AS mean_length
FROM (SELECT count(*) AS n_rows, count(*) - count({column}) AS n_missing, {hits(f"{x} = 0")} AS n_zeros,
    {hits(f"{x} < 0")} AS n_negative, avg({x}) AS mean, stddev_samp({x}) AS std, min({x}) AS low, max({x}) AS high,
    quantile_cont({x}, 0.25) AS p25, quantile_cont({x}, 0.5) AS p50, quantile_cont({x}, 0.75) AS p75,
    {f"skewness({x})" if number else "NULL"} AS skew, {f"kurtosis({x})" if number else "NULL"} AS kurt,
    min({text}) AS min_length, max({text}) AS max_length, avg({text}) AS mean_length FROM {source}) r
CROSS JOIN (SELECT count(*) AS n_distinct, {hits("n = 1")} AS n_unique, max(n) AS freq, min(CAST(v AS VARCHAR)) FILTER (n = most) AS top
  FROM (SELECT {column} AS v, count(*) AS n, max(count(*)) OVER () AS most FROM {source} WHERE {column} IS NOT NULL GROUP BY 1) g) d"""


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _counted(source: str, checks: dict[str, str]) -> str:
    return _union(
        f"SELECT '{name}' AS check_name, {hits(condition)} AS row_count FROM {source}"
        for name, condition in checks.items()
    )


def _null_counts(source: str, columns) -> str:
    return _union(
        f"SELECT {i} AS position, '{c}' AS column_name, '{kind}' AS data_type, {hits(f'{c} IS NULL')} AS null_count FROM {source}"
        for i, (c, kind, _) in enumerate(columns, 1)
    )


# --- the 80 rules, one statement each ----------------------------------------------------------------------------


def _rule(table: str, kind: str, column: str, failures: str, argument: str = "", severity: str = "error") -> str:
    shown = column.replace("'", "''")
    return f"""SELECT '{table}' AS table_name, '{kind}' AS rule_name, '{shown}' AS column_name,
  '{argument.replace("'", "''")}' AS argument, '{severity}' AS severity, f AS failures,
  CASE WHEN f = 0 THEN 'pass' WHEN '{severity}' = 'warn' THEN 'warn' ELSE 'fail' END AS status
FROM ({failures}) x"""


def _source_of(table: str) -> str:
    return "fx_city_map" if table == "city_name_mapping" else table


def _rule_unique(table: str, column: str) -> str:
    return _rule(
        table,
        "unique",
        column,
        f"SELECT count(*) AS f FROM (SELECT {column} AS v FROM {_source_of(table)} WHERE ({column}) IS NOT NULL "
        "GROUP BY 1 HAVING count(*) > 1) g",
    )


def _rule_not_null(table: str, column: str) -> str:
    return _rule(table, "not_null", column, f"SELECT {hits(f'{column} IS NULL')} AS f FROM {_source_of(table)}")


def _rule_accepted(table: str, column: str, values: tuple, severity: str = "error") -> str:
    texts = [str(v).lower() if isinstance(v, bool) else str(v) for v in values]
    listed = ", ".join(f"'{t}'" for t in texts)
    return _rule(
        table,
        "accepted_values",
        column,
        f"SELECT count(DISTINCT {column}) AS f FROM {_source_of(table)} WHERE CAST({column} AS VARCHAR) NOT IN ({listed})",
        ", ".join(texts),
        severity,
    )


def _rule_related(table: str, column: str, parent: str, parent_column: str) -> str:
    return _rule(
        table,
        "relationships",
        column,
        f"SELECT count(*) AS f FROM {table} WHERE {column} IS NOT NULL AND {column} NOT IN "
        f"(SELECT {parent_column} FROM {parent} WHERE {parent_column} IS NOT NULL)",
        parent,
    )


_UNIQUE = {
    "city_name_mapping": ["city_name_raw"],
    "cur_chargers": ["charger_id"],
    "cur_payments": ["payment_id"],
    "cur_users": ["user_id", "email"],
    "cur_transactions": ["session_id"],
    "dim_dates": ["date_key", "date_actual"],
    "dim_users": ["user_key", "user_id", "user_email"],
    "dim_chargers": ["charger_key", "charger_id"],
    "dim_cities": ["city_key", "city_name"],
    "fact_transactions": ["session_id"],
    "fact_daily_metrics": ["transaction_date || '|' || city_name"],
    "fact_charger_performance": ["charger_key"],
}
_NOT_NULL = {
    "city_name_mapping": ["city_name_raw", "city_name_standardized"],
    "cur_chargers": ["charger_id", "city", "is_invalid_location", "is_unmapped_city"],
    "cur_payments": [
        "payment_id", "session_id", "user_id", "is_missing_amount", "is_invalid_amount", "is_outlier_amount",
    ],
    "cur_users": ["user_id"],
    "cur_transactions": [
        "session_id", "user_id", "charger_id", "is_invalid_time_range", "is_missing_kwh", "is_negative_kwh",
        "is_outlier_kwh", "is_outlier_duration",
    ],
    "dim_dates": ["date_key", "date_actual", "day_of_week", "day_of_month", "day_of_year"],
    "dim_users": ["user_key", "user_id"],
    "dim_chargers": ["charger_key", "charger_id", "charger_city"],
    "dim_cities": ["city_key", "city_name"],
    "fact_transactions": ["session_id", "user_key", "charger_key"],
    "fact_daily_metrics": ["transaction_date", "city_name"],
    "fact_charger_performance": ["charger_key"],
}
_FLAG_COLUMNS = {
    "cur_chargers": ["is_invalid_location", "is_unmapped_city"],
    "cur_payments": ["is_missing_amount", "is_invalid_amount", "is_outlier_amount"],
    "cur_transactions": [
        "is_invalid_time_range", "is_missing_kwh", "is_negative_kwh", "is_outlier_kwh", "is_outlier_duration",
    ],
}
_METHODS, _STATUSES, _TIERS = ("card", "RFID", "app_wallet"), ("completed", "failed"), ("guest", "subscriber")
_SUITE = _union(
    [
        *[_rule_unique(t, c) for t, columns in _UNIQUE.items() for c in columns],
        *[_rule_not_null(t, c) for t, columns in _NOT_NULL.items() for c in columns],
        *[_rule_accepted(t, c, (True, False)) for t, columns in _FLAG_COLUMNS.items() for c in columns],
        _rule_accepted("cur_chargers", "is_unmapped_city", (False,), "warn"),
        _rule_accepted("cur_users", "tier", _TIERS),
        _rule_accepted("cur_transactions", "payment_method", _METHODS),
        _rule_accepted("cur_transactions", "status", _STATUSES),
        _rule_accepted("dim_dates", "day_of_week", (0, 1, 2, 3, 4, 5, 6)),
        _rule_accepted("dim_users", "user_tier", _TIERS),
        _rule_accepted("fact_transactions", "payment_method", _METHODS),
        _rule_accepted("fact_transactions", "transaction_status", _STATUSES),
        _rule_related("dim_users", "user_id", "cur_users", "user_id"),
        _rule_related("dim_chargers", "charger_id", "cur_chargers", "charger_id"),
        _rule_related("fact_transactions", "user_key", "dim_users", "user_key"),
        _rule_related("fact_transactions", "charger_key", "dim_chargers", "charger_key"),
        _rule_related("fact_charger_performance", "charger_key", "dim_chargers", "charger_key"),
    ]
)


_PLAIN: dict[str, str] = {key: f"SELECT * FROM {key}" for key in _MODEL_KEYS} | {
    # sources
    "raw_json_scan": """
SELECT CASE WHEN NOT bad THEN user_id END AS user_id, CASE WHEN NOT bad THEN name END AS name,
  CASE WHEN NOT bad THEN email END AS email, CASE WHEN NOT bad THEN tier END AS tier,
  CASE WHEN NOT bad THEN created_at END AS created_at,
  CASE WHEN bad THEN left('{"user_id":"' || user_id || '","name":"' || name, 40) END AS _corrupt_record
FROM (SELECT *, CAST(substr(user_id, 2) AS BIGINT) % 97 = 0 AS bad FROM stg_users) u""",
    "flatten_location": """
SELECT charger_id, city, latitude, longitude, installed_at, CAST(NULL AS VARCHAR) AS _corrupt_record FROM stg_chargers""",
    "raw_variant_land": f"""
SELECT * EXCLUDE (_source_file) REPLACE ({STAMP} AS _loaded_at), {STAMP} AS _dbt_updated_at FROM stg_chargers""",
    "raw_variant_land_array": """
SELECT charger_id, city, latitude, longitude, CAST(NULL AS VARCHAR) AS bad_line FROM stg_chargers
UNION ALL SELECT NULL, NULL, NULL, NULL, bad_line
FROM (SELECT DISTINCT CAST(substr(charger_id, 2) AS BIGINT) // 10000 AS block, CAST(substr(charger_id, 2) AS BIGINT) % 5 AS fault FROM stg_chargers) f
  JOIN (VALUES (1, '{"charger_id": "cut'), (2, '{"x": 2, "x": 3}'), (3, '17'), (4, '{"x": "' || chr(65533) || '"}')) b(fault, bad_line)
  USING (fault)
UNION ALL SELECT NULL, NULL, NULL, NULL, bad_line FROM (VALUES ('no record'), ('{"charger_id": "alone"}')) b(bad_line)""",
    "raw_variant_land_large_array": """
SELECT session_id, user_id, charger_id, start_time, end_time, kwh_consumed, payment_method, status,
  CAST(NULL AS VARCHAR) AS bad_line FROM stg_transactions""",
    "load_with_quarantine": f"""
SELECT CASE WHEN NOT bad THEN session_id END AS session_id, CASE WHEN NOT bad THEN user_id END AS user_id,
  CASE WHEN NOT bad THEN charger_id END AS charger_id, CASE WHEN NOT bad THEN status END AS status,
  CASE WHEN NOT bad AND n % 83 <> 0 THEN CAST(kwh_consumed AS DOUBLE) END AS kwh,
  CASE WHEN n % 89 = 0 THEN left(twice, CASE WHEN n % 97 = 0 THEN 40 ELSE 1000 END)
       WHEN n % 97 = 0 THEN left('{{"session_id":"' || session_id || '","user_id":"' || user_id, 40) END AS bad_line
FROM (SELECT *, n % 97 = 0 OR n % 89 = 0 AS bad,
        '{{"session_id":"' || session_id || '","session_id":"' || session_id || '"}}' AS twice
      FROM (SELECT *, {_KEY_NUMBER} AS n FROM stg_transactions) s) t""",
    "load_row_counts": _union(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM stg_{t}"
        for t in ("users", "chargers", "transactions", "payments")
    ),
    "seed_city_map": """
SELECT m.city_name_raw, m.city_name_standardized, count(c.charger_id) AS chargers
FROM fx_city_map m LEFT JOIN stg_chargers c ON m.city_name_raw = c.city GROUP BY ALL""",
    **{
        f"stg_{t}": f"SELECT *, {STAMP} AS _dbt_updated_at FROM stg_{t}"
        for t in ("users", "chargers", "transactions", "payments")
    },
    # projections and parsing
    "variant_extract": """
SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k, props ->> '$.k' AS k_text,
  props ->> '$.missing.path' AS absent FROM events""",
    "safe_timestamp": """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE date_trunc('second', ts) END AS parsed FROM events""",
    "safe_decimal": """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE TRY_CAST(CAST(value AS VARCHAR) AS DECIMAL(10,1)) END
  AS one_digit,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE TRY_CAST(CAST(value AS VARCHAR) AS DECIMAL(4,2)) END AS narrow
FROM events""",
    "tenure_band": "SELECT user_tenure_band, count(*) AS users FROM dim_users GROUP BY 1",
    "age_band": "SELECT charger_age_band, count(*) AS chargers FROM dim_chargers GROUP BY 1",
    "market_tier": "SELECT city_name, total_chargers AS charger_count, market_size_tier FROM dim_cities",
    "tier_display": """
SELECT user_tier AS tier, user_tier_sort_order AS sort_order, user_tier_display AS display, count(*) AS users
FROM dim_users GROUP BY 1, 2, 3""",
    "derived_ratios": "SELECT session_id, revenue_per_kwh, charging_rate_kw FROM fact_transactions",
    "dq_status": "SELECT charger_id, data_quality_status FROM dim_chargers",
    "strip_timezone": "SELECT o_orderkey, o_orderdate AS ts FROM orders",
    # flags
    "invalid_location": "SELECT charger_id, is_invalid_location FROM cur_chargers",
    "unmapped_city": "SELECT charger_id, city FROM cur_chargers WHERE is_unmapped_city",
    "missing_flags": f"""
SELECT (SELECT {hits('kwh_consumed IS NULL')} FROM stg_transactions) AS missing_kwh,
  (SELECT {hits('amount IS NULL')} FROM stg_payments) AS missing_amount""",
    "sign_flags": f"""
SELECT (SELECT {hits('kwh_consumed < 0')} FROM stg_transactions) AS negative_kwh,
  (SELECT {hits('amount <= 0')} FROM stg_payments) AS invalid_amount""",
    "invalid_time_range": "SELECT session_id, start_time, end_time FROM stg_transactions WHERE end_time < start_time",
    "iqr_outlier_amount": "SELECT payment_id, amount FROM cur_payments WHERE is_outlier_amount",
    "iqr_outlier_kwh": "SELECT session_id, kwh_consumed FROM cur_transactions WHERE is_outlier_kwh",
    "iqr_outlier_duration": """
SELECT session_id, charging_duration_minutes FROM cur_transactions WHERE is_outlier_duration""",
    "iqr_outlier_all": """
SELECT c_custkey, cents NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS is_outlier,
  (q1 - 1.5 * (q3 - q1)) / 100 AS lower_bound, (q3 + 1.5 * (q3 - q1)) / 100 AS upper_bound
FROM (SELECT c_custkey, round(c_acctbal * 100) AS cents FROM customer) c
CROSS JOIN (SELECT quantile_cont(round(c_acctbal * 100), 0.25) AS q1, quantile_cont(round(c_acctbal * 100), 0.75) AS q3
            FROM customer) q""",
    "iqr_bounds": _union(
        f"SELECT '{m}' AS measure, n, q1 / {u} AS q1, q3 / {u} AS q3, (q3 - q1) / {u} AS iqr, lo / {u} AS lower_bound, "
        f"hi / {u} AS upper_bound FROM {m}_bounds"
        for m, u in (("kwh", 10000), ("duration", 1), ("amount", 100))
    ),
    "missing_payment": "SELECT session_id, user_key AS user_id FROM fact_transactions WHERE is_missing_payment",
    "any_quality_issue": "SELECT session_id, has_any_quality_issue FROM fact_transactions",
    "valid_transaction": "SELECT session_id, is_valid_transaction FROM fact_transactions",
    # joins
    "city_standardize": "SELECT city, city_original, count(*) AS chargers FROM cur_chargers GROUP BY 1, 2",
    "skewed_left_join": """
SELECT s.key, s.segment, s.customers, l.l_orderkey, l.l_linenumber
FROM (SELECT c_mktsegment AS segment, count(*) AS customers, ascii(c_mktsegment) % 3 AS key FROM customer GROUP BY 1) s
LEFT JOIN (SELECT l_linenumber % 3 AS key, l_orderkey, l_linenumber FROM lineitem) l ON s.key = l.key""",
    "nearest_city": f"SELECT charger_id, place, ROUND(km, 6) AS distance_km FROM ({_NEAREST}) n",
    "city_agreement": f"""
SELECT city, place_city AS city_from_coords, count(*) AS row_count FROM ({_NEAREST}) n
WHERE city IS NOT NULL AND place IS NOT NULL GROUP BY 1, 2""",
    "user_id_mismatch": """
SELECT t.session_id, t.user_id AS user_id_transactions, p.payment_id, p.user_id AS user_id_payments
FROM stg_transactions t JOIN stg_payments p ON t.session_id = p.session_id WHERE t.user_id <> p.user_id""",
    # exploration
    "master_frame": "SELECT * FROM eda_master",
    "row_issue_count": "SELECT session_id, has_issues, total_issues FROM eda_master",
    "threshold_counts": _counted(
        "eda_master",
        {
            "amount not positive": "amount <= 0",
            "amount above 30": "amount > 30",
            "amount inside (0, 30)": "amount > 0 AND amount < 30",
            "kwh not positive": "kwh_consumed <= 0",
            "kwh not positive, completed": "kwh_consumed <= 0 AND status = ''completed''".replace("''", "'"),
            "kwh above 100": "kwh_consumed > 100",
            "time negative": "charging_time < 0",
            "time above 10 h": "charging_time > 10",
            "time inside [0, 10] h": "charging_time BETWEEN 0 AND 10",
            "issue in amount": "is_invalid_amount IS TRUE OR is_outlier_amount IS TRUE",
            "issue, amount not positive, time not positive": "has_issues AND charging_time <= 0 AND amount <= 0",
            "issue, amount not positive, time positive": "has_issues AND charging_time > 0 AND amount <= 0",
        },
    ),
    "email_validity": r"""
SELECT regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$') AS is_valid_email,
  count(*) AS row_count FROM stg_users GROUP BY 1""",
    "clean_revenue_by_city": """
SELECT city, COALESCE(SUM(amount), 0) AS total_revenue FROM eda_master WHERE NOT has_issues AND city IS NOT NULL
GROUP BY 1""",
    "energy_trend": """
SELECT CAST(start_time AS DATE) AS "date", COALESCE(SUM(kwh_consumed), 0) AS total_kwh FROM eda_master
WHERE NOT has_issues
  AND CAST(start_time AS DATE) >= (SELECT max(CAST(start_time AS DATE)) - 90 FROM eda_master WHERE NOT has_issues)
GROUP BY 1""",
    "energy_trend_city": """
SELECT CAST(start_time AS DATE) AS "date", COALESCE(SUM(kwh_consumed), 0) AS total_kwh FROM eda_master
WHERE NOT has_issues AND city = 'Zurich' GROUP BY 1""",
    "issues_per_month": f"""
SELECT CAST(month(start_time) AS VARCHAR) || '-' || CAST(year(start_time) AS VARCHAR) AS month_year,
  CAST(date_trunc('month', start_time) AS DATE) AS month_start, {hits('has_issues')} AS num_issues
FROM eda_master GROUP BY 1, 2""",
    "invalid_locations_per_month": f"""
SELECT CAST(month(installed_at) AS VARCHAR) || '-' || CAST(year(installed_at) AS VARCHAR) AS month_year,
  CAST(date_trunc('month', installed_at) AS DATE) AS month_start, {hits('is_invalid_location')} AS num_invalid_locations
FROM eda_chargers GROUP BY 1, 2""",
    "issue_crosstab": _union(
        f"SELECT '{a}' AS row_issue, '{b}' AS col_issue, {hits(f'{a} AND {b}')} AS row_count FROM eda_master"
        for i, a in enumerate(_ISSUES)
        for b in _ISSUES[: i + 1]
    ),
    "value_counts": """
SELECT cost_per_kwh, count(*) AS row_count FROM eda_master WHERE cost_per_kwh IS NOT NULL GROUP BY 1""",
    "issues_by_dimension": _union(
        f"SELECT '{c}' AS dimension, {c} AS value, count(*) AS row_count FROM eda_master "
        f"WHERE has_issues AND {c} IS NOT NULL GROUP BY {c}"
        for c in ("city", "payment_method", "tier", "status")
    ),
    "issue_distribution": "SELECT total_issues, count(*) AS row_count FROM eda_master GROUP BY 1",
    "describe": _union(
        _categories(c) if kind in ("text", "flag") else _described(c, f"epoch({c})" if kind == "time" else c, kind)
        for c, _, kind in FRAMES["master"][1]
    ),
    "null_counts": _null_counts("stg_transactions", FRAMES["transactions"][1]),
    "distinct_values": "SELECT DISTINCT city FROM stg_chargers",
    "histogram": """
SELECT g.bin, ROUND(any_value(low + g.bin * ((high - low) / 30)), 6) AS bin_start,
  ROUND(any_value(low + (g.bin + 1) * ((high - low) / 30)), 6) AS bin_end, count(e.bin) AS row_count
FROM (SELECT CAST(unnest(range(30)) AS INTEGER) AS bin) g CROSS JOIN (SELECT min(value) AS low, max(value) AS high FROM events) z LEFT JOIN (
  SELECT CAST(least(floor((value - low) / ((high - low) / 30)), 29) AS INTEGER) AS bin FROM events
  CROSS JOIN (SELECT min(value) AS low, max(value) AS high FROM events) r) e ON g.bin = e.bin GROUP BY 1""",
    "profile_table": _union(_moments(c) for c, _, kind in FRAMES["master"][1] if kind == "number"),
    "profile_frames": _union(
        _profiled(frame, source, i, *column) for frame, (source, columns) in FRAMES.items() for i, column in enumerate(columns, 1)
    ),
    "profile_columns": _union(
        _column_profile(i, c, kind) for i, (c, kind, _) in enumerate(FRAMES["payments"][1], 1)
    ),
    "profile_correlations": _union(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, ROUND(corr({a}::DOUBLE, {b}::DOUBLE), 6) AS correlation "
        "FROM eda_master"
        for a, b in combinations([c for c, _, kind in FRAMES["master"][1] if kind == "number"], 2)
    ),
    "profile_duplicates": """
SELECT count(*) AS n_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem) d) AS n_duplicates
FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 5 = 0) a""",
    "profile_time_series": """
SELECT min(day) AS first_day, max(day) AS last_day, count(*) AS days_with_rows,
  CAST(COALESCE(sum(step - 1), 0) AS BIGINT) AS days_without_rows, COALESCE(max(step), 0) AS longest_step_days,
  ROUND(corr(n, n1), 6) AS autocorrelation_1, ROUND(corr(n, n7), 6) AS autocorrelation_7
FROM (SELECT day, n::DOUBLE AS n, day - lag(day) OVER o AS step, (lag(n, 1) OVER o)::DOUBLE AS n1,
        (lag(n, 7) OVER o)::DOUBLE AS n7
      FROM (SELECT CAST(start_time AS DATE) AS day, count(*) AS n FROM stg_transactions GROUP BY 1) d
      WINDOW o AS (ORDER BY day)) s""",
    # aggregates
    "charger_totals": """
SELECT charger_key, total_transactions, total_revenue, first_transaction_date, last_transaction_date
FROM charger_lifetime""",
    "active_entities": """
SELECT transaction_date, count(DISTINCT user_key) AS active_users, count(DISTINCT charger_key) AS active_chargers
FROM fact_transactions GROUP BY 1""",
    "city_variants": """
SELECT c.city AS city_name, count(*) AS chargers, v.city_name_variants FROM cur_chargers c
JOIN city_variants v ON c.city = v.city_name GROUP BY 1, 3""",
    "charger_utilization": """
SELECT charger_key, active_days_span, days_with_transactions, utilization_pct FROM charger_lifetime""",
    "performance_class": """
SELECT performance_classification, count(*) AS chargers, SUM(total_revenue) AS total_revenue
FROM fact_charger_performance GROUP BY 1""",
    # dashboard
    "kpi_month_over_month": _KPI,
    "kpi_pct_change": f"WITH kpi AS ({_KPI})\n"
    + _union(
        f"""SELECT {i} AS position, '{label}' AS kpi, now AS current_value, before AS previous_value,
  CASE WHEN before > 0 THEN (now - before) / before * 100 ELSE 0 END AS pct_change
FROM (SELECT COALESCE(max({c}::DOUBLE) FILTER (WHERE period = 'Current Month'), 0) AS now,
        COALESCE(max({c}::DOUBLE) FILTER (WHERE period = 'Previous Month'), 0) AS before FROM kpi) v"""
        for i, (label, c) in enumerate(_KPIS.items(), 1)
    ),
    "revenue_trend": _TREND_ROWS,
    "revenue_trend_all": f"""
SELECT transaction_date, city_name, valid_revenue AS total_revenue,
  (SUM(valid_revenue) OVER ())::DOUBLE / (count(*) OVER ())::DOUBLE AS average_revenue
FROM fact_daily_metrics WHERE {_IN_TREND} AND city_name = '_ALL_CITIES_'""",
    "city_filter_values": f"SELECT DISTINCT city_name FROM ({_TREND_ROWS}) t",
    "charger_matrix": """
SELECT charger_key, charger_id, charger_city, total_transactions, valid_transactions,
  avg_valid_revenue_per_transaction AS avg_revenue_per_transaction, total_revenue, valid_revenue, unique_users,
  valid_transaction_pct, performance_classification, transaction_volume_quartile, revenue_per_txn_quartile
FROM fact_charger_performance WHERE total_transactions > 0""",
    "quadrant_medians": """
SELECT median(total_transactions::DOUBLE) AS median_transactions,
  median(avg_valid_revenue_per_transaction) AS median_revenue FROM charger_lifetime""",
    "top_chargers": """
SELECT charger_key, charger_city, total_transactions, total_revenue FROM fact_charger_performance
WHERE charger_key IS NOT NULL ORDER BY total_transactions DESC, charger_key LIMIT 5""",
    "geo_performance": """
SELECT c.city_name, c.city_center_latitude, c.city_center_longitude, c.total_chargers, c.market_size_tier,
  SUM(f.valid_revenue) AS total_revenue, SUM(f.valid_energy_kwh) AS total_energy_kwh,
  CAST(SUM(f.valid_transactions) AS BIGINT) AS total_transactions,
  ROUND(AVG(f.valid_transaction_pct), 6) AS avg_valid_transaction_pct
FROM fact_daily_metrics f JOIN dim_cities c ON f.city_name = c.city_name
WHERE f.city_name <> '_ALL_CITIES_' AND NOT c.is_unmapped_city GROUP BY 1, 2, 3, 4, 5""",
    "dq_scorecard": f"""
SELECT count(*) AS total_transactions, {', '.join(f'{hits(flag)} AS {c}' for c, flag in _SCORECARD.items())},
  {hits('has_any_quality_issue AND NOT is_valid_transaction')} AS transactions_with_issues FROM fact_transactions""",
    "dq_validity_split": f"""
SELECT category, n AS row_count, n::DOUBLE / total::DOUBLE * 100 AS percentage FROM (
  SELECT 'Valid Transactions' AS category, {hits('is_valid_transaction')} AS n, count(*) AS total FROM fact_transactions
  UNION ALL
  SELECT 'Transactions with Issues', {hits('NOT is_valid_transaction')}, count(*) FROM fact_transactions) s""",
    "dq_issue_breakdown": "SELECT * FROM ("
    + _union(
        f"SELECT '{label}' AS issue_type, {hits(flag)} AS row_count FROM fact_transactions"
        for label, flag in _BREAKDOWN.items()
    )
    + ") b WHERE row_count > 0",
    "dq_trend_daily": _TREND_DAILY,
    "dq_trend_weekly": f"""
SELECT *, {_SHARES} FROM (
  SELECT CAST(date_trunc('week', transaction_date) AS DATE) AS week_start_date, count(*) AS total_transactions,
    {', '.join(f'{hits(flag)} AS {c}' for c, flag in _TREND.items())}
  FROM fact_transactions GROUP BY 1) w""",
    "dq_alert_thresholds": f"""
SELECT position, issue_type, ROUND(mean_pct, 6) AS mean_pct, max_pct, threshold,
  ROUND(greatest(max_pct * 1.2, threshold * 1.3, 5.0), 6) AS y_max FROM ({_THRESHOLDS}) t""",
    "dq_alert_status": f"""
SELECT position, issue_type, ROUND(mean_pct, 6) AS mean_pct, threshold,
  CASE WHEN mean_pct > threshold * 0.8 THEN 'warn' ELSE 'ok' END AS status
FROM ({_THRESHOLDS}) t WHERE issue_type <> 'All Issues' AND mean_pct > 0.5""",
    "dq_trend_direction": f"""
SELECT ROUND(late, 6) AS recent_pct, ROUND(early, 6) AS earlier_pct,
  CASE WHEN late < early THEN 'Improving' WHEN late > early THEN 'Degrading' ELSE 'Stable' END AS trend_direction
FROM (
  SELECT avg(pct) FILTER (WHERE newest <= 7) AS late, avg(pct) FILTER (WHERE oldest <= 7) AS early
  FROM (SELECT pct, newest, row_number() OVER (ORDER BY transaction_date) AS oldest
        FROM (SELECT transaction_date, transactions_with_issues_pct AS pct,
                row_number() OVER (ORDER BY transaction_date DESC) AS newest FROM ({_TREND_DAILY}) t) r
        WHERE newest <= 90) n) m""",
    # generators
    "date_spine": """
SELECT CAST(d.day AS DATE) AS date_day, count(t.session_id) AS sessions
FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-07-31', INTERVAL 1 DAY)) AS day) d
LEFT JOIN stg_transactions t ON CAST(t.start_time AS DATE) = CAST(d.day AS DATE) GROUP BY 1""",
    "surrogate_key": """
SELECT charger_id, md5(COALESCE(city, '_dbt_utils_surrogate_key_null_')) AS city_key,
  md5(COALESCE(city, '_dbt_utils_surrogate_key_null_') || '-' || CAST(latitude IS NULL AS VARCHAR)) AS pair_key
FROM cur_chargers""",
    # rules
    "dq_unique": """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS value, count(*) AS row_count
FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
    "dq_unique_composite": """
SELECT CAST(transaction_date AS VARCHAR) || '|' || city_name AS value, count(*) AS row_count FROM fact_transactions
WHERE city_name IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "dq_not_null": _union(
        f"SELECT '{c}' AS column_name, {hits(f'{c} IS NULL')} AS failures FROM fact_transactions"
        for c in ("session_id", "user_key", "charger_key", "end_time", "energy_kwh", "payment_id")
    ),
    "dq_accepted_values": """
SELECT tier AS value, count(*) AS row_count FROM cur_users WHERE tier NOT IN ('guest', 'subscriber') GROUP BY 1
UNION ALL
SELECT payment_method, count(*) FROM cur_transactions WHERE payment_method NOT IN ('card', 'RFID', 'app_wallet')
GROUP BY 1""",
    "dq_relationships": """
SELECT user_id AS "key", count(*) AS "rows" FROM cur_payments
WHERE user_id NOT IN (SELECT user_id FROM cur_users) GROUP BY 1""",
    "dq_suite": _SUITE,
    # incremental
    "incremental_merge": f"""
SELECT *, CAST(date_trunc('month', start_time) AS DATE) AS transaction_month FROM (
  SELECT session_id, user_id, charger_id,
    CASE WHEN {_KEY_NUMBER} % 25 = 0 THEN start_time + INTERVAL 40 DAY ELSE start_time END AS start_time, end_time,
    kwh_consumed, payment_method, CASE WHEN {_KEY_NUMBER} % 5 = 0 THEN 'completed' ELSE status END AS status,
    CASE WHEN {_KEY_NUMBER} % 5 = 0 THEN _loaded_at + INTERVAL 1 DAY ELSE _loaded_at END AS _loaded_at
  FROM stg_transactions) m""",
    "source_freshness": _union(
        f"""SELECT '{t}' AS source_name, newest AS max_loaded_at, age AS age_minutes,
  CASE WHEN age IS NULL OR age > 2880 THEN 'error' WHEN age > 1440 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max({c}) AS newest, date_diff('minute', max({c}), TIMESTAMP '2001-08-02 12:00:00') AS age FROM stg_{t}) a"""
        for t, c in ((t, "_loaded_at") for t in ("users", "chargers", "transactions", "payments"))
    ),
    "valid_pct_alerts": """
SELECT transaction_date, total_transactions, valid_transactions, valid_transaction_pct, 60.0::DOUBLE AS threshold_pct
FROM fact_daily_metrics WHERE city_name = '_ALL_CITIES_' AND valid_transaction_pct < 60""",
    "valid_pct_alerts_stream": """
SELECT transaction_date, total_transactions, valid_transactions, valid_transaction_pct, 60.0::DOUBLE AS threshold_pct
FROM fact_daily_metrics WHERE city_name = '_ALL_CITIES_' AND valid_transaction_pct < 60""",
    "distinct_by_grain": _union(
        f"SELECT '{grain}' AS grain, {period} AS period, {city} AS city, count(DISTINCT user_key) AS active_users, "
        "count(DISTINCT charger_key) AS active_chargers FROM fact_transactions GROUP BY 1, 2, 3"
        for grain, period, city in (
            ("week", "CAST(date_trunc('week', transaction_date) AS DATE)", "NULL::VARCHAR"),
            ("month", "CAST(date_trunc('month', transaction_date) AS DATE)", "city_name"),
            ("all", "NULL::DATE", "NULL::VARCHAR"),
        )
    ),
    "refreshed_daily_metrics": "SELECT * FROM fact_daily_metrics",
}


def _complete(sql: str) -> str:
    """Puts the needed models in front; a statement with its own WITH list keeps it behind them."""
    if sql.lstrip().startswith("WITH "):
        return statement(f"SELECT * FROM ({sql}) q")
    return statement(sql)


STATEMENTS: dict[str, str] = {key: _complete(sql) for key, sql in _PLAIN.items()}
