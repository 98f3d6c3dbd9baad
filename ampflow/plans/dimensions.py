"""Dimensions of the semantic layer. Each run overwrites them; no history is kept."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampflow.config import AGE_BAND, MARKET_BAND, SPINE_END, SPINE_START, TENURE_BAND, Run
from ampflow.functions.calendar import date_key
from ampflow.functions.measures import any_of, band, is_true, rows_where

NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"  # fixed value: stands for NULL inside hash keys


def surrogate_key(*columns: Column) -> Column:
    """Hex md5 of the '-'-joined values, with NULL replaced by a token."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_KEY_TOKEN)) for c in columns]
    return F.md5(F.concat_ws("-", *parts).cast("binary"))


def tier_rank(tier: Column) -> Column:
    """Fixed values, as the labels of the next function and of :func:`quality_status`."""
    return F.when(tier == "subscriber", 1).when(tier == "guest", 2).otherwise(99)


def tier_display(tier: Column) -> Column:
    return F.when(tier == "subscriber", "Premium").when(tier == "guest", "Basic").otherwise("Unknown")


def days_since(ts: Column, run: Run) -> Column:
    return F.datediff(run.today(), F.to_date(ts))


def dim_users(cur_users: DataFrame, run: Run) -> DataFrame:
    tenure = days_since(F.col("created_at"), run)
    return cur_users.select(
        F.col("user_id").alias("user_key"),
        "user_id",
        F.col("name").alias("user_name"),
        F.col("email").alias("user_email"),
        F.col("tier").alias("user_tier"),
        tier_rank(F.col("tier")).alias("user_tier_sort_order"),
        tier_display(F.col("tier")).alias("user_tier_display"),
        F.col("created_at").alias("user_created_at"),
        F.to_date("created_at").alias("user_created_date"),
        tenure.alias("user_tenure_days"),
        band(tenure, TENURE_BAND).alias("user_tenure_band"),
        "_loaded_at",
        "_source_file",
        "_dbt_updated_at",
        run.stamp().alias("_semantic_updated_at"),
    )


def quality_status(invalid_location: Column, unmapped_city: Column) -> Column:
    location, city = is_true(invalid_location), is_true(unmapped_city)
    return (
        F.when(location & city, "Invalid Location & Unmapped City")
        .when(location, "Invalid Location")
        .when(city, "Unmapped City")
        .otherwise("Valid")
    )


def dim_chargers(cur_chargers: DataFrame, run: Run) -> DataFrame:
    flags = [F.col("is_invalid_location"), F.col("is_unmapped_city")]
    age = days_since(F.col("installed_at"), run)
    return cur_chargers.select(
        F.col("charger_id").alias("charger_key"),
        "charger_id",
        F.col("city").alias("charger_city"),
        F.col("city_original").alias("charger_city_original"),
        F.col("latitude").alias("charger_latitude"),
        F.col("longitude").alias("charger_longitude"),
        F.col("installed_at").alias("charger_installed_at"),
        F.to_date("installed_at").alias("charger_installed_date"),
        date_key(F.to_date("installed_at")).alias("installed_date_key"),
        age.alias("charger_age_days"),
        band(age, AGE_BAND).alias("charger_age_band"),
        *flags,
        any_of(flags).alias("has_data_quality_issue"),
        quality_status(*flags).alias("data_quality_status"),
        "_loaded_at",
        "_source_file",
        "_dbt_updated_at",
        run.stamp().alias("_semantic_updated_at"),
    )


def city_variants(city_map: DataFrame) -> DataFrame:
    """All spellings of each standard city name as one ordered text."""
    return city_map.groupBy(F.col("city_name_standardized").alias("city_name")).agg(
        F.expr("listagg(DISTINCT city_name_raw, ', ') WITHIN GROUP (ORDER BY city_name_raw)").alias(
            "city_name_variants"
        )
    )


def charger_cities(cur_chargers: DataFrame) -> DataFrame:
    """Charger statistics per city. The centre averages all coordinates, invalid ones included."""
    invalid = F.col("is_invalid_location")
    return cur_chargers.groupBy(F.col("city").alias("city_name")).agg(
        F.count(F.lit(1)).alias("charger_count"),
        F.avg("latitude").alias("avg_latitude"),
        F.avg("longitude").alias("avg_longitude"),
        F.min("installed_at").alias("first_charger_installed_at"),
        F.max("installed_at").alias("last_charger_installed_at"),
        rows_where(~invalid).alias("valid_location_chargers"),
        rows_where(invalid).alias("invalid_location_chargers"),
    )


def dim_cities(cur_chargers: DataFrame, city_map: DataFrame, run: Run) -> DataFrame:
    variants = city_variants(city_map).withColumn("_mapped", F.lit(True))
    first, last = F.col("first_charger_installed_at"), F.col("last_charger_installed_at")
    return (
        charger_cities(cur_chargers)
        .join(variants, "city_name", "left")
        .select(
            surrogate_key(F.col("city_name")).alias("city_key"),
            "city_name",
            F.coalesce("city_name_variants", "city_name").alias("city_name_variants"),
            F.col("avg_latitude").alias("city_center_latitude"),
            F.col("avg_longitude").alias("city_center_longitude"),
            F.col("charger_count").alias("total_chargers"),
            "valid_location_chargers",
            "invalid_location_chargers",
            "first_charger_installed_at",
            "last_charger_installed_at",
            F.datediff(F.to_date(last), F.to_date(first)).alias("expansion_period_days"),
            band(F.col("charger_count"), MARKET_BAND).alias("market_size_tier"),
            F.col("_mapped").isNull().alias("is_unmapped_city"),
            run.stamp().alias("_dbt_updated_at"),
        )
    )


def date_spine(spark: SparkSession, start: date = SPINE_START, end: date = SPINE_END) -> DataFrame:
    """One row per day, ``end`` exclusive."""
    days = F.sequence(F.lit(start), F.date_sub(F.lit(end), 1))
    empty = F.lit(start) >= F.lit(end)
    return spark.range(1).select(F.explode(F.when(~empty, days)).alias("date_day"))


def spine_of(df: DataFrame, ts: str) -> DataFrame:
    """One row per day from the first to the last day of ``ts``; one row of bounds is expanded."""
    day = F.to_date(ts)
    return df.agg(F.min(day).alias("first"), F.max(day).alias("last")).select(
        F.explode(F.sequence("first", "last")).alias("date_day")
    )


def dim_dates(spine: DataFrame, run: Run) -> DataFrame:
    """Calendar attributes of ``spine.date_day``. Weeks start on Monday; ``day_of_week`` counts from Sunday = 0."""
    day, today = F.col("date_day"), run.today()
    weekday = F.dayofweek(day) - 1
    month, quarter, year = F.trunc(day, "month"), F.trunc(day, "quarter"), F.trunc(day, "year")

    def same(unit: str, other: Column) -> Column:
        return F.trunc(day, unit) == F.trunc(other, unit)

    def last_days(n: int) -> Column:
        return (day >= F.date_sub(today, n)) & (day < today)

    return spine.select(
        date_key(day).alias("date_key"),
        day.alias("date_actual"),
        weekday.alias("day_of_week"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.date_format(day, "E").alias("day_name"),
        F.date_format(day, "EEEE").alias("day_name_full"),
        F.weekofyear(day).alias("week_of_year"),
        F.trunc(day, "week").alias("week_start_date"),
        F.date_add(F.trunc(day, "week"), 6).alias("week_end_date"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMM").alias("month_name"),
        F.date_format(day, "MMMM").alias("month_name_full"),
        month.alias("month_start_date"),
        F.last_day(day).alias("month_end_date"),
        F.quarter(day).alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter_name"),
        quarter.alias("quarter_start_date"),
        F.last_day(F.add_months(quarter, 2)).alias("quarter_end_date"),
        F.year(day).alias("year_number"),
        year.alias("year_start_date"),
        F.last_day(F.add_months(year, 11)).alias("year_end_date"),
        F.year(day).alias("fiscal_year"),
        F.quarter(day).alias("fiscal_quarter"),
        (~weekday.isin(0, 6)).alias("is_weekday"),
        weekday.isin(0, 6).alias("is_weekend"),
        (day == today).alias("is_today"),
        (day == F.date_sub(today, 1)).alias("is_yesterday"),
        same("week", today).alias("is_current_week"),
        same("month", today).alias("is_current_month"),
        same("quarter", today).alias("is_current_quarter"),
        same("year", today).alias("is_current_year"),
        same("month", F.add_months(today, -1)).alias("is_previous_month"),
        same("quarter", F.add_months(today, -3)).alias("is_previous_quarter"),
        last_days(7).alias("is_last_7_days"),
        last_days(30).alias("is_last_30_days"),
        last_days(90).alias("is_last_90_days"),
        run.stamp().alias("_dbt_updated_at"),
    )
