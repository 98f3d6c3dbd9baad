"""Layer models as SQL, from the same definitions the plans follow; each may use the ones above it."""

from __future__ import annotations

from oracle.inputs import INPUTS

STAMP = "TIMESTAMP '2001-08-01 00:00:00'"
TODAY = "DATE '2001-08-01'"


NEWEST = {
    "users.json": ("2001-08-01 00:00:00", "user_id"),
    "chargers.json": ("2001-07-30 18:00:00", "charger_id"),
    "transactions.json": ("2001-08-01 20:00:00", "session_id"),
    "payments.json": ("2001-08-01 00:00:00", "payment_id"),
}


def _audit(file_name: str) -> str:
    newest, key = NEWEST[file_name]
    earlier = f"CAST(CAST(substr({key}, 2) AS BIGINT) % 2000 AS INT) * INTERVAL 1 MINUTE"
    return f"TIMESTAMP '{newest}' - {earlier} AS _loaded_at, '{file_name}' AS _source_file"


def pct(part: str, whole: str = "count(*)") -> str:
    return f"ROUND(100.0::DOUBLE * ({part})::DOUBLE / NULLIF({whole}, 0)::DOUBLE, 2)"


def hits(flag: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {flag}) AS BIGINT)"


_DAILY_MEASURES = f"""
  SUM(payment_amount_coalesced) AS total_revenue,
  SUM(CASE WHEN is_valid_transaction THEN payment_amount_coalesced ELSE 0 END) AS valid_revenue,
  SUM(CASE WHEN payment_amount > 0 THEN payment_amount END)::DOUBLE / NULLIF({hits('payment_amount > 0')}, 0)::DOUBLE
    AS avg_revenue_per_transaction,
  SUM(energy_kwh_coalesced) AS total_energy_kwh,
  SUM(CASE WHEN is_valid_transaction THEN energy_kwh_coalesced ELSE 0 END) AS valid_energy_kwh,
  SUM(CASE WHEN energy_kwh > 0 THEN energy_kwh END)::DOUBLE / NULLIF({hits('energy_kwh > 0')}, 0)::DOUBLE
    AS avg_energy_per_transaction,
  CAST(SUM(duration_minutes_coalesced) AS BIGINT) AS total_duration_minutes,
  SUM(CASE WHEN duration_minutes > 0 THEN duration_minutes END)::DOUBLE
    / NULLIF({hits('duration_minutes > 0')}, 0)::DOUBLE AS avg_duration_minutes,
  count(*) AS total_transactions,
  CAST(SUM(completed_transaction_count) AS BIGINT) AS completed_transactions,
  CAST(SUM(failed_transaction_count) AS BIGINT) AS failed_transactions,
  {hits('is_valid_transaction')} AS valid_transactions,
  COUNT(DISTINCT user_key) AS active_users,
  COUNT(DISTINCT charger_key) AS active_chargers,
  {hits('has_any_quality_issue')} AS transactions_with_issues,
  {hits('is_missing_payment')} AS transactions_missing_payment,
  {hits('is_invalid_time_range')} AS transactions_invalid_time,
  {hits('is_missing_kwh OR is_negative_kwh')} AS transactions_invalid_kwh,
  {hits('is_outlier_kwh OR is_outlier_duration OR is_outlier_payment_amount')} AS transactions_with_outliers,
  {pct(hits('is_valid_transaction'))} AS valid_transaction_pct,
  {pct(hits('has_any_quality_issue'))} AS issue_transaction_pct,
  {pct(hits('is_missing_payment'))} AS missing_payment_pct,
  {hits("payment_method = 'card'")} AS card_transactions,
  {hits("payment_method = 'RFID'")} AS rfid_transactions,
  {hits("payment_method = 'app_wallet'")} AS app_wallet_transactions,
  {STAMP} AS _dbt_updated_at
"""


def _iqr(source: str, units: str, where: str) -> str:
    return f"""
SELECT count(*) AS n, q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
FROM (SELECT quantile_cont({units}, 0.25) AS q1, quantile_cont({units}, 0.75) AS q3 FROM {source} WHERE {where}) q
CROSS JOIN (SELECT 1 FROM {source} WHERE {where}) r GROUP BY q1, q3"""


AMOUNT_UNITS = "CAST(amount * 100 AS DOUBLE)"
KWH_UNITS = "CAST(kwh_consumed * 10000 AS DOUBLE)"
MINUTE_UNITS = "CAST(charging_duration_minutes AS DOUBLE)"
MICRO_UNITS = "CAST(date_diff('microsecond', start_time, end_time) AS DOUBLE)"

MODELS: dict[str, str] = {
    **INPUTS,
    "stg_users": f"SELECT user_id, name, email, tier, CAST(created_on AS TIMESTAMP) AS created_at, {_audit('users.json')} FROM fx_users",
    "stg_chargers": f"SELECT charger_id, city, latitude, longitude, CAST(installed_on AS TIMESTAMP) AS installed_at, {_audit('chargers.json')} FROM fx_chargers",
    "stg_transactions": f"SELECT *, {_audit('transactions.json')} FROM fx_transactions",
    "stg_payments": f"SELECT *, {_audit('payments.json')} FROM fx_payments",
    "cur_users": f"SELECT *, {STAMP} AS _dbt_updated_at FROM stg_users",
    "cur_chargers": f"""
SELECT c.charger_id, COALESCE(m.city_name_standardized, c.city) AS city, c.city AS city_original, c.latitude,
  c.longitude, c.installed_at,
  c.latitude IS NULL OR c.longitude IS NULL OR NOT (c.latitude BETWEEN 45.817995 AND 47.808455
    AND c.longitude BETWEEN 5.955911 AND 10.492294) AS is_invalid_location,
  m.city_name_standardized IS NULL AS is_unmapped_city, c._loaded_at, c._source_file, {STAMP} AS _dbt_updated_at
FROM stg_chargers c LEFT JOIN fx_city_map m ON lower(trim(c.city)) = lower(trim(m.city_name_raw))""",
    "amount_bounds": _iqr("stg_payments", AMOUNT_UNITS, "amount > 0"),
    "cur_payments": f"""
SELECT p.payment_id, p.session_id, p.user_id, p.amount, p.currency, p.amount IS NULL AS is_missing_amount,
  COALESCE(p.amount <= 0, FALSE) AS is_invalid_amount,
  COALESCE(p.amount > 0 AND ({AMOUNT_UNITS} < b.lo OR {AMOUNT_UNITS} > b.hi), FALSE) AS is_outlier_amount,
  b.lo / 100 AS _outlier_lower_bound, b.hi / 100 AS _outlier_upper_bound, p._loaded_at, p._source_file,
  {STAMP} AS _dbt_updated_at
FROM stg_payments p CROSS JOIN amount_bounds b""",
    "timed_transactions": """
SELECT *, CASE WHEN end_time >= start_time THEN date_diff('minute', start_time, end_time) END
  AS charging_duration_minutes FROM stg_transactions""",
    "kwh_bounds": _iqr("timed_transactions", KWH_UNITS, "kwh_consumed > 0"),
    "duration_bounds": _iqr("timed_transactions", MINUTE_UNITS, "charging_duration_minutes > 0"),
    "cur_transactions": f"""
SELECT t.session_id, t.user_id, t.charger_id, t.start_time, t.end_time, t.kwh_consumed, t.payment_method, t.status,
  t.charging_duration_minutes, COALESCE(t.end_time < t.start_time, FALSE) AS is_invalid_time_range,
  t.kwh_consumed IS NULL AS is_missing_kwh, COALESCE(t.kwh_consumed < 0, FALSE) AS is_negative_kwh,
  COALESCE(t.kwh_consumed > 0 AND ({KWH_UNITS} < k.lo OR {KWH_UNITS} > k.hi), FALSE) AS is_outlier_kwh,
  COALESCE(t.charging_duration_minutes > 0 AND ({MINUTE_UNITS} < d.lo OR {MINUTE_UNITS} > d.hi), FALSE)
    AS is_outlier_duration,
  k.lo / 10000 AS _kwh_outlier_lower_bound, k.hi / 10000 AS _kwh_outlier_upper_bound,
  d.lo AS _duration_outlier_lower_bound, d.hi AS _duration_outlier_upper_bound,
  t._loaded_at, t._source_file, {STAMP} AS _dbt_updated_at
FROM timed_transactions t CROSS JOIN kwh_bounds k CROSS JOIN duration_bounds d""",
    "date_spine": """
SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date_day
FROM (SELECT CAST(min(start_time) AS DATE) AS first, CAST(max(start_time) AS DATE) AS last FROM stg_transactions) r""",
    "dim_dates": f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_actual, dayofweek(d) AS day_of_week,
  dayofmonth(d) AS day_of_month, dayofyear(d) AS day_of_year, strftime(d, '%a') AS day_name, dayname(d) AS day_name_full,
  weekofyear(d) AS week_of_year, CAST(date_trunc('week', d) AS DATE) AS week_start_date,
  CAST(date_trunc('week', d) AS DATE) + 6 AS week_end_date, month(d) AS month_number,
  strftime(d, '%b') AS month_name, monthname(d) AS month_name_full,
  CAST(date_trunc('month', d) AS DATE) AS month_start_date, last_day(d) AS month_end_date,
  quarter(d) AS quarter_number, 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name,
  CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date,
  last_day(CAST(date_trunc('quarter', d) + INTERVAL 2 MONTH AS DATE)) AS quarter_end_date, year(d) AS year_number,
  CAST(date_trunc('year', d) AS DATE) AS year_start_date, make_date(year(d), 12, 31) AS year_end_date,
  year(d) AS fiscal_year, quarter(d) AS fiscal_quarter, dayofweek(d) NOT IN (0, 6) AS is_weekday,
  dayofweek(d) IN (0, 6) AS is_weekend, d = {TODAY} AS is_today, d = {TODAY} - 1 AS is_yesterday,
  date_trunc('week', d) = date_trunc('week', {TODAY}) AS is_current_week,
  date_trunc('month', d) = date_trunc('month', {TODAY}) AS is_current_month,
  date_trunc('quarter', d) = date_trunc('quarter', {TODAY}) AS is_current_quarter,
  date_trunc('year', d) = date_trunc('year', {TODAY}) AS is_current_year,
  date_trunc('month', d) = date_trunc('month', {TODAY} - INTERVAL 1 MONTH) AS is_previous_month,
  date_trunc('quarter', d) = date_trunc('quarter', {TODAY} - INTERVAL 3 MONTH) AS is_previous_quarter,
  d >= {TODAY} - 7 AND d < {TODAY} AS is_last_7_days, d >= {TODAY} - 30 AND d < {TODAY} AS is_last_30_days,
  d >= {TODAY} - 90 AND d < {TODAY} AS is_last_90_days, {STAMP} AS _dbt_updated_at
FROM (SELECT date_day AS d FROM date_spine) s""",
    "dim_users": f"""
SELECT user_id AS user_key, user_id, name AS user_name, email AS user_email, tier AS user_tier,
  CASE tier WHEN 'subscriber' THEN 1 WHEN 'guest' THEN 2 ELSE 99 END AS user_tier_sort_order,
  CASE tier WHEN 'subscriber' THEN 'Premium' WHEN 'guest' THEN 'Basic' ELSE 'Unknown' END AS user_tier_display,
  created_at AS user_created_at, CAST(created_at AS DATE) AS user_created_date, days AS user_tenure_days,
  CASE WHEN days < 30 THEN 'New (< 30 days)' WHEN days < 90 THEN 'Recent (30-90 days)'
       WHEN days < 365 THEN 'Established (90-365 days)' ELSE 'Veteran (1+ year)' END AS user_tenure_band,
  _loaded_at, _source_file, _dbt_updated_at, {STAMP} AS _semantic_updated_at
FROM (SELECT *, date_diff('day', CAST(created_at AS DATE), {TODAY}) AS days FROM cur_users) u""",
    "dim_chargers": f"""
SELECT charger_id AS charger_key, charger_id, city AS charger_city, city_original AS charger_city_original,
  latitude AS charger_latitude, longitude AS charger_longitude, installed_at AS charger_installed_at,
  CAST(installed_at AS DATE) AS charger_installed_date,
  CAST(strftime(installed_at, '%Y%m%d') AS INTEGER) AS installed_date_key, days AS charger_age_days,
  CASE WHEN days < 90 THEN 'New (< 90 days)' WHEN days < 365 THEN 'Recent (90-365 days)'
       WHEN days < 730 THEN 'Established (1-2 years)' ELSE 'Mature (2+ years)' END AS charger_age_band,
  is_invalid_location, is_unmapped_city, is_invalid_location OR is_unmapped_city AS has_data_quality_issue,
  CASE WHEN is_invalid_location AND is_unmapped_city THEN 'Invalid Location & Unmapped City'
       WHEN is_invalid_location THEN 'Invalid Location' WHEN is_unmapped_city THEN 'Unmapped City'
       ELSE 'Valid' END AS data_quality_status,
  _loaded_at, _source_file, _dbt_updated_at, {STAMP} AS _semantic_updated_at
FROM (SELECT *, date_diff('day', CAST(installed_at AS DATE), {TODAY}) AS days FROM cur_chargers) c""",
    "city_variants": """
SELECT city_name_standardized AS city_name, string_agg(DISTINCT city_name_raw, ', ' ORDER BY city_name_raw)
  AS city_name_variants FROM fx_city_map GROUP BY city_name_standardized""",
    "dim_cities": f"""
SELECT md5(COALESCE(s.city, '_dbt_utils_surrogate_key_null_')) AS city_key, s.city AS city_name,
  COALESCE(v.city_name_variants, s.city) AS city_name_variants, s.lat AS city_center_latitude,
  s.lon AS city_center_longitude, s.n AS total_chargers, s.n - s.bad AS valid_location_chargers,
  s.bad AS invalid_location_chargers, s.first_at AS first_charger_installed_at, s.last_at AS last_charger_installed_at,
  date_diff('day', CAST(s.first_at AS DATE), CAST(s.last_at AS DATE)) AS expansion_period_days,
  CASE WHEN s.n >= 10 THEN 'Large Market' WHEN s.n >= 5 THEN 'Medium Market' WHEN s.n >= 2 THEN 'Small Market'
       ELSE 'Emerging Market' END AS market_size_tier,
  v.city_name IS NULL AS is_unmapped_city, {STAMP} AS _dbt_updated_at
FROM (SELECT city, count(*) AS n, avg(latitude) AS lat, avg(longitude) AS lon, min(installed_at) AS first_at,
        max(installed_at) AS last_at, {hits('is_invalid_location')} AS bad FROM cur_chargers GROUP BY city) s
LEFT JOIN city_variants v ON s.city = v.city_name""",
    "fact_transactions": f"""
SELECT j.*, is_invalid_time_range OR is_missing_kwh OR is_negative_kwh OR is_outlier_kwh OR is_outlier_duration
    OR payment_id IS NULL OR is_missing_payment_amount OR is_invalid_payment_amount OR is_outlier_payment_amount
    AS has_any_quality_issue,
  transaction_status = 'completed' AND NOT is_invalid_time_range AND NOT is_missing_kwh AND NOT is_negative_kwh
    AND payment_id IS NOT NULL AND NOT is_outlier_payment_amount AND NOT is_invalid_payment_amount
    AS is_valid_transaction,
  1 AS transaction_count, CAST(transaction_status = 'completed' AS INTEGER) AS completed_transaction_count,
  CAST(transaction_status = 'failed' AS INTEGER) AS failed_transaction_count
FROM (
  SELECT t.session_id, t.user_id AS user_key, t.charger_id AS charger_key, c.city AS city_name,
    CAST(strftime(t.start_time, '%Y%m%d') AS INTEGER) AS transaction_date_key,
    CAST(t.start_time AS DATE) AS transaction_date, t.start_time, t.end_time, t.kwh_consumed AS energy_kwh,
    COALESCE(t.kwh_consumed, 0)::DECIMAL(10,4) AS energy_kwh_coalesced,
    t.charging_duration_minutes AS duration_minutes,
    COALESCE(t.charging_duration_minutes, 0) AS duration_minutes_coalesced, p.amount AS payment_amount,
    COALESCE(p.amount, 0)::DECIMAL(10,2) AS payment_amount_coalesced, p.currency AS payment_currency,
    CASE WHEN t.kwh_consumed > 0 THEN p.amount::DOUBLE / t.kwh_consumed::DOUBLE END AS revenue_per_kwh,
    CASE WHEN t.charging_duration_minutes > 0
      THEN t.kwh_consumed::DOUBLE / (t.charging_duration_minutes::DOUBLE / 60.0::DOUBLE) END AS charging_rate_kw,
    t.payment_method, t.status AS transaction_status, p.payment_id, t.is_invalid_time_range, t.is_missing_kwh,
    t.is_negative_kwh, t.is_outlier_kwh, t.is_outlier_duration,
    p.payment_id IS NULL AND t.status = 'completed' AS is_missing_payment,
    COALESCE(p.is_missing_amount, FALSE) AS is_missing_payment_amount,
    COALESCE(p.is_invalid_amount, FALSE) AS is_invalid_payment_amount,
    COALESCE(p.is_outlier_amount, FALSE) AS is_outlier_payment_amount,
    t._loaded_at, t._source_file, t._dbt_updated_at AS _curated_updated_at, {STAMP} AS _semantic_updated_at
  FROM cur_transactions t LEFT JOIN cur_payments p ON t.session_id = p.session_id
  LEFT JOIN cur_chargers c ON t.charger_id = c.charger_id) j""",
    "fact_daily_metrics": f"""
SELECT transaction_date, city_name, transaction_date_key, {_DAILY_MEASURES}
FROM fact_transactions WHERE transaction_date IS NOT NULL GROUP BY transaction_date, city_name, transaction_date_key
UNION ALL
SELECT transaction_date, '_ALL_CITIES_', transaction_date_key, {_DAILY_MEASURES}
FROM fact_transactions WHERE transaction_date IS NOT NULL GROUP BY transaction_date, transaction_date_key""",
    "charger_lifetime": f"""
SELECT charger_key, total_transactions, completed_transactions, failed_transactions, valid_transactions, total_revenue,
  valid_revenue, total_revenue::DOUBLE / total_transactions::DOUBLE AS avg_revenue_per_transaction,
  CASE WHEN valid_transactions > 0 THEN valid_revenue::DOUBLE / valid_transactions::DOUBLE ELSE 0 END
    AS avg_valid_revenue_per_transaction,
  total_energy_kwh, avg_energy_per_transaction, total_duration_minutes, avg_duration_minutes, unique_users,
  first_transaction_date, last_transaction_date, active_days_span, days_with_transactions,
  COALESCE({pct('days_with_transactions', 'active_days_span')}, 0) AS utilization_pct,
  total_transactions::DOUBLE / days_with_transactions::DOUBLE AS avg_transactions_per_day,
  total_revenue::DOUBLE / days_with_transactions::DOUBLE AS avg_revenue_per_day, transactions_with_issues,
  {pct('valid_transactions', 'total_transactions')} AS valid_transaction_pct, {STAMP} AS _dbt_updated_at
FROM (
  SELECT charger_key, count(*) AS total_transactions,
    CAST(SUM(completed_transaction_count) AS BIGINT) AS completed_transactions,
    CAST(SUM(failed_transaction_count) AS BIGINT) AS failed_transactions,
    {hits('is_valid_transaction')} AS valid_transactions, SUM(payment_amount_coalesced) AS total_revenue,
    SUM(CASE WHEN is_valid_transaction THEN payment_amount_coalesced ELSE 0 END) AS valid_revenue,
    SUM(energy_kwh_coalesced) AS total_energy_kwh,
    SUM(CASE WHEN energy_kwh > 0 THEN energy_kwh END)::DOUBLE / NULLIF({hits('energy_kwh > 0')}, 0)::DOUBLE
      AS avg_energy_per_transaction,
    CAST(SUM(duration_minutes_coalesced) AS BIGINT) AS total_duration_minutes,
    SUM(CASE WHEN duration_minutes > 0 THEN duration_minutes END)::DOUBLE
      / NULLIF({hits('duration_minutes > 0')}, 0)::DOUBLE AS avg_duration_minutes,
    COUNT(DISTINCT user_key) AS unique_users, MIN(transaction_date) AS first_transaction_date,
    MAX(transaction_date) AS last_transaction_date,
    date_diff('day', MIN(transaction_date), MAX(transaction_date)) + 1 AS active_days_span,
    COUNT(DISTINCT transaction_date) AS days_with_transactions,
    {hits('has_any_quality_issue')} AS transactions_with_issues
  FROM fact_transactions GROUP BY charger_key) a""",
    "charger_quartiles": """
SELECT charger_key, ntile(4) OVER (ORDER BY total_transactions NULLS LAST, charger_key NULLS LAST)
    AS transaction_volume_quartile,
  ntile(4) OVER (ORDER BY avg_revenue_per_transaction NULLS LAST, charger_key NULLS LAST) AS revenue_per_txn_quartile,
  ntile(4) OVER (ORDER BY total_revenue NULLS LAST, charger_key NULLS LAST) AS total_revenue_quartile
FROM charger_lifetime""",
    "fact_charger_performance": """
SELECT l.*, d.charger_id, d.charger_city, d.charger_installed_date, d.charger_age_days, d.charger_age_band,
  d.has_data_quality_issue AS charger_has_data_quality_issue, d.data_quality_status AS charger_data_quality_status,
  q.transaction_volume_quartile, q.revenue_per_txn_quartile, q.total_revenue_quartile,
  CASE WHEN q.transaction_volume_quartile + q.revenue_per_txn_quartile = 8 THEN 'Star Performer'
       ELSE list_extract(['Underperformer', 'Low Volume / High Value', 'High Volume / Low Value', 'High Performer'],
         1 + 2 * (q.transaction_volume_quartile > 2)::INTEGER + (q.revenue_per_txn_quartile > 2)::INTEGER)
       END AS performance_classification
FROM charger_lifetime l JOIN charger_quartiles q ON l.charger_key IS NOT DISTINCT FROM q.charger_key
LEFT JOIN dim_chargers d ON l.charger_key = d.charger_key""",
    "eda_chargers": """
SELECT charger_id, CASE city WHEN 'Zuerich' THEN 'Zurich' WHEN 'Zürich' THEN 'Zurich'
    WHEN 'Sankt Gallen' THEN 'St. Gallen' ELSE city END AS city, latitude, longitude, installed_at, is_invalid_location
FROM (SELECT s.*, c.is_invalid_location FROM stg_chargers s JOIN cur_chargers c ON s.charger_id = c.charger_id) x""",
    "amount_bounds_all": _iqr("stg_payments", AMOUNT_UNITS, "amount IS NOT NULL"),
    "kwh_bounds_all": _iqr("stg_transactions", KWH_UNITS, "kwh_consumed IS NOT NULL"),
    "time_bounds_all": _iqr("stg_transactions", MICRO_UNITS, "end_time IS NOT NULL AND start_time IS NOT NULL"),
    "eda_master": f"""
SELECT *, is_invalid_amount IS TRUE OR is_outlier_amount IS TRUE OR is_end_time_earlier OR is_negative_kwh
    OR is_outlier_kwh_consumed OR is_outlier_charging_time AS has_issues,
  COALESCE(is_invalid_amount, FALSE)::INTEGER + COALESCE(is_outlier_amount, FALSE)::INTEGER
    + is_end_time_earlier::INTEGER + is_negative_kwh::INTEGER + is_outlier_kwh_consumed::INTEGER
    + is_outlier_charging_time::INTEGER AS total_issues
FROM (
  SELECT t.session_id, t.user_id, t.charger_id, p.payment_id, u.tier, c.installed_at, c.city, t.start_time, t.end_time,
    CAST(date_diff('second', t.start_time, t.end_time) AS DOUBLE) / 3600 AS charging_time, t.kwh_consumed,
    CASE WHEN t.kwh_consumed <> 0 THEN round_even(p.amount::DOUBLE / t.kwh_consumed::DOUBLE, 2) END AS cost_per_kwh,
    t.payment_method, p.amount, t.status, c.is_invalid_location,
    CASE WHEN p.payment_id IS NOT NULL THEN COALESCE(p.amount <= 0, FALSE) END AS is_invalid_amount,
    CASE WHEN p.payment_id IS NOT NULL
      THEN COALESCE(CAST(p.amount * 100 AS DOUBLE) NOT BETWEEN a.lo AND a.hi, FALSE) END AS is_outlier_amount,
    COALESCE(t.end_time < t.start_time, FALSE) AS is_end_time_earlier,
    COALESCE(t.kwh_consumed < 0, FALSE) AS is_negative_kwh,
    COALESCE({KWH_UNITS} NOT BETWEEN k.lo AND k.hi, FALSE) AS is_outlier_kwh_consumed,
    COALESCE({MICRO_UNITS} NOT BETWEEN h.lo AND h.hi, FALSE) AS is_outlier_charging_time
  FROM stg_transactions t LEFT JOIN stg_users u ON t.user_id = u.user_id
  LEFT JOIN eda_chargers c ON t.charger_id = c.charger_id LEFT JOIN stg_payments p ON t.session_id = p.session_id
  CROSS JOIN amount_bounds_all a CROSS JOIN kwh_bounds_all k CROSS JOIN time_bounds_all h) j""",
}


def statement(final: str) -> str:
    """``final`` preceded by the models it needs, in order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in MODELS:
            if name not in needed and _mentions(text, name):
                needed.add(name)
                visit(MODELS[name])

    visit(final)
    chain = ",\n".join(f"{name} AS ({MODELS[name]})" for name in MODELS if name in needed)
    return f"WITH {chain}\n{final}" if chain else final


def _mentions(text: str, name: str) -> bool:
    words = "".join(c if c.isalnum() or c == "_" else " " for c in text).split()
    return any(a.upper() in ("FROM", "JOIN") and b == name for a, b in zip(words, words[1:]))
