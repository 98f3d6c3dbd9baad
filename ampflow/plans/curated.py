"""Curated layer: standardised values and data-quality flags. Rows are flagged, never dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampflow.config import BoundingBox, Run
from ampflow.functions.calendar import minutes_between
from ampflow.functions.measures import ends_before_start, outside_box
from ampflow.operators.joins import lookup_spelling
from ampflow.operators.quantiles import Fixed, IqrRule, decimal_measure, iqr_bounds, with_iqr_bounds

AUDIT = ("_loaded_at", "_source_file")

AMOUNT_RULE = IqrRule("amount", decimal_measure("amount", 10, 2))
KWH_RULE = IqrRule("kwh", decimal_measure("kwh_consumed", 10, 4))
DURATION_RULE = IqrRule("duration", Fixed("charging_duration_minutes"))


def cur_users(stg_users: DataFrame, run: Run) -> DataFrame:
    return stg_users.select(
        "user_id", "name", "email", "tier", "created_at", *AUDIT, run.stamp().alias("_dbt_updated_at")
    )


def location_flag(box: BoundingBox):
    return outside_box(F.col("latitude"), F.col("longitude"), box).alias("is_invalid_location")


def cur_chargers(stg_chargers: DataFrame, city_map: DataFrame, run: Run) -> DataFrame:
    mapped = lookup_spelling(stg_chargers, "city", city_map, "city_name_raw", "city_name_standardized")
    return mapped.select(
        "charger_id",
        F.coalesce("city_name_standardized", "city").alias("city"),
        F.col("city").alias("city_original"),
        "latitude",
        "longitude",
        "installed_at",
        location_flag(run.box),
        F.col("city_name_standardized").isNull().alias("is_unmapped_city"),
        *AUDIT,
        run.stamp().alias("_dbt_updated_at"),
    )


def payment_bounds(stg_payments: DataFrame) -> DataFrame:
    """One row of outlier bounds. Kept with a run, it lets later rows be flagged against the same bounds."""
    return iqr_bounds(stg_payments, [AMOUNT_RULE])


def transaction_bounds(stg_transactions: DataFrame) -> DataFrame:
    """As :func:`payment_bounds`, for energy and duration."""
    return iqr_bounds(with_duration(stg_transactions), [KWH_RULE, DURATION_RULE])


def cur_payments(stg_payments: DataFrame, run: Run, bounds: DataFrame | None = None) -> DataFrame:
    amount = F.col("amount")
    return with_iqr_bounds(stg_payments, [AMOUNT_RULE], bounds).select(
        "payment_id",
        "session_id",
        "user_id",
        "amount",
        "currency",
        amount.isNull().alias("is_missing_amount"),
        F.coalesce(amount <= 0, F.lit(False)).alias("is_invalid_amount"),
        AMOUNT_RULE.outlier().alias("is_outlier_amount"),
        F.col("amount_lower_bound").alias("_outlier_lower_bound"),
        F.col("amount_upper_bound").alias("_outlier_upper_bound"),
        *AUDIT,
        run.stamp().alias("_dbt_updated_at"),
    )


def with_duration(transactions: DataFrame) -> DataFrame:
    """Adds whole minutes, NULL for open or reversed intervals."""
    start, end = F.col("start_time"), F.col("end_time")
    return transactions.withColumn(
        "charging_duration_minutes", F.when(end >= start, minutes_between(start, end))
    )


def cur_transactions(stg_transactions: DataFrame, run: Run, bounds: DataFrame | None = None) -> DataFrame:
    kwh = F.col("kwh_consumed")
    timed = with_duration(stg_transactions)
    return with_iqr_bounds(timed, [KWH_RULE, DURATION_RULE], bounds).select(
        "session_id",
        "user_id",
        "charger_id",
        "start_time",
        "end_time",
        "kwh_consumed",
        "payment_method",
        "status",
        "charging_duration_minutes",
        ends_before_start(F.col("start_time"), F.col("end_time")).alias("is_invalid_time_range"),
        kwh.isNull().alias("is_missing_kwh"),
        F.coalesce(kwh < 0, F.lit(False)).alias("is_negative_kwh"),
        KWH_RULE.outlier().alias("is_outlier_kwh"),
        DURATION_RULE.outlier().alias("is_outlier_duration"),
        F.col("kwh_lower_bound").alias("_kwh_outlier_lower_bound"),
        F.col("kwh_upper_bound").alias("_kwh_outlier_upper_bound"),
        F.col("duration_lower_bound").alias("_duration_outlier_lower_bound"),
        F.col("duration_upper_bound").alias("_duration_outlier_upper_bound"),
        *AUDIT,
        run.stamp().alias("_dbt_updated_at"),
    )
