"""The rules every refresh is checked against (fixed values)."""

from __future__ import annotations

from ampflow.operators.rules import ACCEPTED, NOT_NULL, RELATED, UNIQUE, Rule

FLAG = (True, False)
TIERS = ("guest", "subscriber")
METHODS = ("card", "RFID", "app_wallet")
STATUSES = ("completed", "failed")


def _unique(table: str, *columns: str) -> list[Rule]:
    return [Rule(table, UNIQUE, c) for c in columns]


def _not_null(table: str, *columns: str) -> list[Rule]:
    return [Rule(table, NOT_NULL, c) for c in columns]


def _accepted(table: str, column: str, values: tuple, severity: str = "error") -> list[Rule]:
    return [Rule(table, ACCEPTED, column, values=values, severity=severity)]


def _flags(table: str, *columns: str) -> list[Rule]:
    return [*_not_null(table, *columns), *[r for c in columns for r in _accepted(table, c, FLAG)]]


def _related(table: str, column: str, parent: str, parent_column: str) -> list[Rule]:
    return [Rule(table, RELATED, column, parent=parent, parent_column=parent_column)]


RULES: list[Rule] = [
    *_unique("city_name_mapping", "city_name_raw"),
    *_not_null("city_name_mapping", "city_name_raw", "city_name_standardized"),
    *_unique("cur_chargers", "charger_id"),
    *_not_null("cur_chargers", "charger_id", "city"),
    *_flags("cur_chargers", "is_invalid_location", "is_unmapped_city"),
    *_accepted("cur_chargers", "is_unmapped_city", (False,), severity="warn"),
    *_unique("cur_payments", "payment_id"),
    *_not_null("cur_payments", "payment_id", "session_id", "user_id"),
    *_flags("cur_payments", "is_missing_amount", "is_invalid_amount", "is_outlier_amount"),
    *_unique("cur_users", "user_id", "email"),
    *_not_null("cur_users", "user_id"),
    *_accepted("cur_users", "tier", TIERS),
    *_unique("cur_transactions", "session_id"),
    *_not_null("cur_transactions", "session_id", "user_id", "charger_id"),
    *_accepted("cur_transactions", "payment_method", METHODS),
    *_accepted("cur_transactions", "status", STATUSES),
    *_flags(
        "cur_transactions",
        "is_invalid_time_range",
        "is_missing_kwh",
        "is_negative_kwh",
        "is_outlier_kwh",
        "is_outlier_duration",
    ),
    *_unique("dim_dates", "date_key", "date_actual"),
    *_not_null("dim_dates", "date_key", "date_actual", "day_of_week", "day_of_month", "day_of_year"),
    *_accepted("dim_dates", "day_of_week", tuple(range(7))),
    *_unique("dim_users", "user_key", "user_id", "user_email"),
    *_not_null("dim_users", "user_key", "user_id"),
    *_related("dim_users", "user_id", "cur_users", "user_id"),
    *_accepted("dim_users", "user_tier", TIERS),
    *_unique("dim_chargers", "charger_key", "charger_id"),
    *_not_null("dim_chargers", "charger_key", "charger_id", "charger_city"),
    *_related("dim_chargers", "charger_id", "cur_chargers", "charger_id"),
    *_unique("dim_cities", "city_key", "city_name"),
    *_not_null("dim_cities", "city_key", "city_name"),
    *_unique("fact_transactions", "session_id"),
    *_not_null("fact_transactions", "session_id", "user_key", "charger_key"),
    *_related("fact_transactions", "user_key", "dim_users", "user_key"),
    *_related("fact_transactions", "charger_key", "dim_chargers", "charger_key"),
    *_accepted("fact_transactions", "payment_method", METHODS),
    *_accepted("fact_transactions", "transaction_status", STATUSES),
    *_not_null("fact_daily_metrics", "transaction_date", "city_name"),
    *_unique("fact_daily_metrics", "transaction_date || '|' || city_name"),
    *_unique("fact_charger_performance", "charger_key"),
    *_not_null("fact_charger_performance", "charger_key"),
    *_related("fact_charger_performance", "charger_key", "dim_chargers", "charger_key"),
]
