"""Dashboard questions over the semantic layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampflow.config import ALL_CITIES, Reporting
from ampflow.functions.measures import ratio
from ampflow.operators.joins import with_row
from ampflow.operators.quantiles import float_quantiles

CURRENT, PREVIOUS = "Current Month", "Previous Month"

# Display name of each headline measure.
KPIS = {
    "Total Revenue": "total_revenue",
    "Energy Delivered (kWh)": "total_energy_kwh",
    "Active Chargers": "active_chargers",
    "Active Users": "active_users",
    "Transactions": "total_transactions",
    "Avg Revenue/Txn": "avg_revenue_per_transaction",
}


def kpi_month_over_month(daily: DataFrame, dim_dates: DataFrame, when: Reporting) -> DataFrame:
    """Headline measures of the current and the previous month; "active" is the best single day."""
    day = F.col("date_actual")
    period = F.when(day.between(when.current_start, when.data_end), CURRENT).when(
        day.between(when.previous_start, when.previous_end), PREVIOUS
    )
    dates = dim_dates.where(day.between(when.previous_start, when.data_end)).select("date_key", period.alias("period"))
    totals = (
        daily.where(F.col("city_name") == ALL_CITIES)
        .join(dates, F.col("transaction_date_key") == F.col("date_key"))
        .groupBy("period")
        .agg(
            F.sum("valid_revenue").alias("total_revenue"),
            F.sum("valid_energy_kwh").alias("total_energy_kwh"),
            F.max("active_chargers").alias("active_chargers"),
            F.max("active_users").alias("active_users"),
            F.sum("valid_transactions").alias("total_transactions"),
        )
    )
    average = F.coalesce(ratio(F.col("total_revenue"), F.col("total_transactions")), F.lit(0.0))
    return totals.withColumn("avg_revenue_per_transaction", average).orderBy(F.desc("period"))


def kpi_pct_change(kpis: DataFrame) -> DataFrame:
    """One row per headline measure: current, previous and change in percent (0 without a positive previous)."""

    def value_in(period: str, column: str):
        value = F.max(F.when(F.col("period") == period, F.col(column).cast("double")))
        return F.coalesce(value, F.lit(0.0))

    wide = kpis.agg(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(label).alias("kpi"),
                value_in(CURRENT, column).alias("current_value"),
                value_in(PREVIOUS, column).alias("previous_value"),
            ).alias(f"k{i}")
            for i, (label, column) in enumerate(KPIS.items(), 1)
        ]
    )
    now, before = F.col("current_value"), F.col("previous_value")
    change = F.when(before > 0, (now - before) / before * 100).otherwise(0.0)
    return wide.select(F.inline(F.array(*wide.columns))).withColumn("pct_change", change).orderBy("position")


def _in_trend(daily: DataFrame, when: Reporting) -> DataFrame:
    return daily.where(F.col("transaction_date").between(when.trend_start, when.data_end))


def revenue_trend(daily: DataFrame, when: Reporting) -> DataFrame:
    """Daily valid revenue per city over the last 90 days."""
    return (
        _in_trend(daily, when)
        .where(F.col("city_name") != ALL_CITIES)
        .select(
            "transaction_date",
            "city_name",
            F.col("valid_revenue").alias("total_revenue"),
            F.col("valid_transactions").alias("total_transactions"),
            "active_users",
            "active_chargers",
        )
        .orderBy("transaction_date", "city_name")
    )


def revenue_trend_all(daily: DataFrame, when: Reporting) -> DataFrame:
    """Network-wide daily valid revenue with the mean of the window as reference line."""
    days = (
        _in_trend(daily, when)
        .where(F.col("city_name") == ALL_CITIES)
        .select("transaction_date", "city_name", F.col("valid_revenue").alias("total_revenue"))
    )
    line = days.agg(ratio(F.sum("total_revenue"), F.count("total_revenue")).alias("average_revenue"))
    return with_row(days, line).orderBy("transaction_date")


def city_filter_values(daily: DataFrame, when: Reporting) -> DataFrame:
    """Sorted city names offered as filter."""
    return revenue_trend(daily, when).select("city_name").distinct().orderBy("city_name")


def charger_matrix(performance: DataFrame) -> DataFrame:
    """Volume against valid revenue per session; the quartiles stay those of the unfiltered measures."""
    return (
        performance.where(F.col("total_transactions") > 0)
        .select(
            "charger_key",
            "charger_id",
            "charger_city",
            "total_transactions",
            "valid_transactions",
            F.col("avg_valid_revenue_per_transaction").alias("avg_revenue_per_transaction"),
            "total_revenue",
            "valid_revenue",
            "unique_users",
            "valid_transaction_pct",
            "performance_classification",
            "transaction_volume_quartile",
            "revenue_per_txn_quartile",
        )
        .orderBy(F.desc("total_transactions"))
    )


def quadrant_medians(matrix: DataFrame) -> DataFrame:
    """Reference lines of the matrix."""
    middle = float_quantiles(
        matrix,
        {"transactions": F.col("total_transactions"), "revenue": F.col("avg_revenue_per_transaction")},
        (0.5,),
    )
    return middle.select(
        F.col("transactions_p0").alias("median_transactions"), F.col("revenue_p0").alias("median_revenue")
    )


def top_chargers(performance: DataFrame, n: int = 5) -> DataFrame:
    return (
        performance.where(F.col("charger_key").isNotNull())
        .select("charger_key", "charger_city", "total_transactions", "total_revenue")
        .orderBy(F.desc("total_transactions"), "charger_key")
        .limit(n)
    )


def geo_performance(daily: DataFrame, dim_cities: DataFrame) -> DataFrame:
    """Valid measures per mapped city with its centre and market size."""
    cities = dim_cities.where(~F.col("is_unmapped_city")).select(
        "city_name", "city_center_latitude", "city_center_longitude", "total_chargers", "market_size_tier"
    )
    per_city = (
        daily.where(F.col("city_name") != ALL_CITIES)
        .groupBy("city_name")
        .agg(
            F.sum("valid_revenue").alias("total_revenue"),
            F.sum("valid_energy_kwh").alias("total_energy_kwh"),
            F.sum("valid_transactions").alias("total_transactions"),
            F.avg("valid_transaction_pct").alias("avg_valid_transaction_pct"),
        )
    )
    return cities.join(per_city, "city_name").orderBy(F.desc("total_revenue"))
