"""Data-quality monitor: scorecard, trends, thresholds, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ampflow.functions.measures import percent_half_even, round_half_even, rows_where

# Fixed values up to ISSUE_TYPES: output columns and labels. Scorecard column per flag of the session fact.
SCORECARD = {
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
BREAKDOWN = {
    "Missing Amount": "missing_payment_amount",
    "Invalid Amount": "invalid_payment_amount",
    "Invalid Time": "invalid_time_range",
    "Missing kWh": "missing_kwh",
    "Negative kWh": "negative_kwh",
    "Outlier kWh": "outlier_kwh",
    "Outlier Duration": "outlier_duration",
    "Outlier Amount": "outlier_payment_amount",
}
# Trend column per flag, in display order.
TREND = {
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
ISSUE_TYPES = {
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


def dq_scorecard(fact: DataFrame) -> DataFrame:
    """Counts per flag in one pass; "with issues" here means flagged and not valid."""
    flagged = F.col("has_any_quality_issue") & ~F.col("is_valid_transaction")
    return fact.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        *[rows_where(F.col(flag)).alias(name) for name, flag in SCORECARD.items()],
        rows_where(flagged).alias("transactions_with_issues"),
    )


def dq_validity_split(scorecard: DataFrame) -> DataFrame:
    """Valid sessions against all others, with shares."""
    valid, total = F.col("valid_transactions"), F.col("total_transactions")
    parts = F.array(
        F.struct(F.lit("Valid Transactions").alias("category"), valid.alias("row_count")),
        F.struct(F.lit("Transactions with Issues").alias("category"), (total - valid).alias("row_count")),
    )
    share = F.try_divide(F.col("row_count").cast("double"), total.cast("double")) * 100
    return scorecard.select("total_transactions", F.inline(parts)).select(
        "category", "row_count", share.alias("percentage")
    )


def dq_issue_breakdown(scorecard: DataFrame) -> DataFrame:
    """Scorecard in long form without empty issue types, smallest first."""
    cells = [
        F.struct(F.lit(label).alias("issue_type"), F.col(column).alias("row_count"))
        for label, column in BREAKDOWN.items()
    ]
    return (
        scorecard.select(F.inline(F.array(*cells)))
        .where(F.col("row_count") > 0)
        .orderBy("row_count", "issue_type")
    )


def _with_percentages(counts: DataFrame) -> DataFrame:
    total = F.col("total_transactions")
    return counts.withColumns({f"{c}_pct": percent_half_even(F.col(c), total) for c in TREND})


def dq_trend_daily(fact: DataFrame, dim_dates: DataFrame) -> DataFrame:
    """Counts and percentages per day. Days are aggregated first, so only days meet the calendar."""
    days = fact.groupBy("transaction_date_key").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        *[rows_where(F.col(flag)).alias(name) for name, flag in TREND.items()],
    )
    dates = dim_dates.select("date_key", F.col("date_actual").alias("transaction_date"), "week_start_date")
    joined = days.join(dates, F.col("transaction_date_key") == F.col("date_key")).select(
        "transaction_date", "week_start_date", "total_transactions", *TREND
    )
    return _with_percentages(joined).orderBy("transaction_date")


def dq_trend_weekly(daily: DataFrame) -> DataFrame:
    """Weeks from days: counts add up, percentages are computed anew."""
    counts = daily.groupBy("week_start_date").agg(*[F.sum(c).alias(c) for c in ["total_transactions", *TREND]])
    return _with_percentages(counts).orderBy("week_start_date")


def dq_alert_thresholds(daily: DataFrame, sigmas: float = 1.5, floor: float = 2.0) -> DataFrame:
    """Per issue type: mean, threshold (mean + 1.5 sd, at least 2 %) and axis limit."""
    cells = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("issue_type"), F.col(column).alias("pct"))
        for i, (name, column) in enumerate(ISSUE_TYPES.items(), 1)
    ]
    stats = (
        daily.select(F.inline(F.array(*cells)))
        .groupBy("position", "issue_type")
        .agg(F.avg("pct").alias("mean_pct"), F.stddev_samp("pct").alias("_sd"), F.max("pct").alias("max_pct"))
    )
    threshold = round_half_even(F.greatest(F.col("mean_pct") + sigmas * F.col("_sd"), F.lit(floor)), 1)
    return (
        stats.withColumn("threshold", threshold)
        .withColumn("y_max", F.greatest(F.col("max_pct") * 1.2, F.col("threshold") * 1.3, F.lit(5.0)))
        .select("position", "issue_type", "mean_pct", "max_pct", "threshold", "y_max")
        .orderBy("position")
    )


def dq_alert_status(thresholds: DataFrame, near: float = 0.8, listed_above: float = 0.5) -> DataFrame:
    """Single issue types worth listing, ``warn`` when their mean comes near the threshold."""
    mean = F.col("mean_pct")
    return (
        thresholds.where((F.col("issue_type") != "All Issues") & (mean > listed_above))
        .withColumn("status", F.when(mean > F.col("threshold") * near, "warn").otherwise("ok"))
        .select("position", "issue_type", "mean_pct", "threshold", "status")
        .orderBy("position")
    )


def dq_trend_direction(daily: DataFrame, window_rows: int = 90, edge_rows: int = 7) -> DataFrame:
    """Last seven against first seven of the latest 90 daily rows; the window runs over at most 90 rows."""
    pct = F.col("transactions_with_issues_pct")
    recent = daily.select("transaction_date", pct).orderBy(F.desc("transaction_date")).limit(window_rows)
    newest = F.row_number().over(Window.orderBy(F.desc("transaction_date")))
    oldest = F.row_number().over(Window.orderBy("transaction_date"))
    ranked = recent.withColumns({"_newest": newest, "_oldest": oldest})
    means = ranked.agg(
        F.avg(F.when(F.col("_newest") <= edge_rows, pct)).alias("recent_pct"),
        F.avg(F.when(F.col("_oldest") <= edge_rows, pct)).alias("earlier_pct"),
    )
    late, early = F.col("recent_pct"), F.col("earlier_pct")
    direction = F.when(late < early, "Improving").when(late > early, "Degrading").otherwise("Stable")
    return means.withColumn("trend_direction", direction)
