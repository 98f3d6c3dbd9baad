"""Exploratory questions: the joined session frame, its issues, and what remains without them.

Here the outlier rule takes its quartiles from the whole series, and a missing payment is no issue; both differ from
the curated layer on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampflow.config import BoundingBox
from ampflow.functions.calendar import hours_between, minutes_between, month_label
from ampflow.functions.measures import (
    any_of,
    count_of,
    ends_before_start,
    is_true,
    outside_box,
    ratio,
    round_half_even,
    rows_where,
)
from ampflow.functions.parsing import is_valid_email
from ampflow.operators.joins import differing, left_join_many, replace_values
from ampflow.operators.nearest import nearest_place
from ampflow.operators.profile import predicate_counts
from ampflow.operators.quantiles import Fixed, IqrRule, decimal_measure, with_iqr_bounds

# City spellings corrected by hand in the exploration.
CITY_FIXES = {"Zuerich": "Zurich", "Zürich": "Zurich", "Sankt Gallen": "St. Gallen"}

ISSUES = (
    "is_invalid_amount",
    "is_outlier_amount",
    "is_end_time_earlier",
    "is_negative_kwh",
    "is_outlier_kwh_consumed",
    "is_outlier_charging_time",
)

AMOUNT_ALL = IqrRule("amount", decimal_measure("amount", 10, 2), positive_only=False)
KWH_ALL = IqrRule("kwh", decimal_measure("kwh_consumed", 10, 4), positive_only=False)
TIME_ALL = IqrRule("time", Fixed("_charging_micros", 3_600_000_000, digits=18), positive_only=False)


def clean_chargers(stg_chargers: DataFrame, box: BoundingBox) -> DataFrame:
    return stg_chargers.replace(CITY_FIXES, subset=["city"]).withColumn(
        "is_invalid_location", outside_box(F.col("latitude"), F.col("longitude"), box)
    )


def clean_payments(stg_payments: DataFrame) -> DataFrame:
    return with_iqr_bounds(stg_payments, [AMOUNT_ALL]).select(
        *stg_payments.columns,
        F.coalesce(F.col("amount") <= 0, F.lit(False)).alias("is_invalid_amount"),
        AMOUNT_ALL.outlier().alias("is_outlier_amount"),
    )


def clean_transactions(stg_transactions: DataFrame) -> DataFrame:
    start, end = F.col("start_time"), F.col("end_time")
    seconds = F.extract(F.lit("SECOND"), end) - F.extract(F.lit("SECOND"), start)
    micros = minutes_between(start, end) * 60_000_000 + (seconds * 1_000_000).cast("bigint")
    timed = stg_transactions.withColumns(
        {"charging_time": hours_between(start, end), "_charging_micros": micros}
    )
    return with_iqr_bounds(timed, [KWH_ALL, TIME_ALL]).select(
        *stg_transactions.columns,
        "charging_time",
        ends_before_start(start, end).alias("is_end_time_earlier"),
        F.coalesce(F.col("kwh_consumed") < 0, F.lit(False)).alias("is_negative_kwh"),
        KWH_ALL.outlier().alias("is_outlier_kwh_consumed"),
        TIME_ALL.outlier().alias("is_outlier_charging_time"),
    )


def joined_frame(
    transactions: DataFrame, users: DataFrame, chargers: DataFrame, payments: DataFrame
) -> DataFrame:
    """Sessions with user, charger and payment attributes; the payer stays apart as ``user_id_payments``."""
    return left_join_many(
        transactions.join(users.select("user_id", "tier"), "user_id", "left").join(
            chargers.select("charger_id", "installed_at", "city", "is_invalid_location"), "charger_id", "left"
        ),
        payments.select(
            "session_id",
            "payment_id",
            F.col("user_id").alias("user_id_payments"),
            "amount",
            "is_invalid_amount",
            "is_outlier_amount",
        ),
        "session_id",
    )


def user_id_mismatch(transactions: DataFrame, payments: DataFrame) -> DataFrame:
    """Sessions whose payment names another user."""
    payer = payments.select("session_id", "payment_id", F.col("user_id").alias("user_id_payments"))
    return (
        transactions.select("session_id", F.col("user_id").alias("user_id_transactions"))
        .join(payer, "session_id")
        .where(differing(F.col("user_id_transactions"), F.col("user_id_payments")))
    )


def master_frame(joined: DataFrame) -> DataFrame:
    """The columns the exploration works on, with cost per kWh and the issue marks."""
    flags = [F.col(c) for c in ISSUES]
    return joined.withColumns(
        {
            "cost_per_kwh": round_half_even(ratio(F.col("amount"), F.col("kwh_consumed")), 2),
            "has_issues": any_of(flags),
            "total_issues": count_of(flags),
        }
    ).select(
        "session_id",
        "user_id",
        "charger_id",
        "payment_id",
        "tier",
        "installed_at",
        "city",
        "start_time",
        "end_time",
        "charging_time",
        "kwh_consumed",
        "cost_per_kwh",
        "payment_method",
        "amount",
        "status",
        "is_invalid_location",
        *ISSUES,
        "has_issues",
        "total_issues",
    )


def inspections() -> dict[str, Column]:
    """Named row filters of the assessment. The limits are those applied, whatever their captions say."""
    amount, kwh, hours = F.col("amount"), F.col("kwh_consumed"), F.col("charging_time")
    return {
        "amount not positive": amount <= 0,
        "amount above 30": amount > 30,
        "amount inside (0, 30)": (amount > 0) & (amount < 30),
        "kwh not positive": kwh <= 0,
        "kwh not positive, completed": (kwh <= 0) & (F.col("status") == "completed"),
        "kwh above 100": kwh > 100,
        "time negative": hours < 0,
        "time above 10 h": hours > 10,
        "time inside [0, 10] h": (hours >= 0) & (hours <= 10),
        "issue in amount": is_true(F.col("is_invalid_amount")) | is_true(F.col("is_outlier_amount")),
        "issue, amount not positive, time not positive": F.col("has_issues") & (hours <= 0) & (amount <= 0),
        "issue, amount not positive, time positive": F.col("has_issues") & (hours > 0) & (amount <= 0),
    }


def threshold_counts(master: DataFrame) -> DataFrame:
    return predicate_counts(master, inspections())


def email_validity(users: DataFrame) -> DataFrame:
    return users.groupBy(is_valid_email(F.col("email")).alias("is_valid_email")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def issue_distribution(master: DataFrame) -> DataFrame:
    return master.groupBy("total_issues").agg(F.count(F.lit(1)).alias("row_count")).orderBy("total_issues")


def flagged_per_month(df: DataFrame, ts: str, flag: str, name: str) -> DataFrame:
    """Flagged rows per month: the ``M-YYYY`` label and the month itself to sort by."""
    month = F.trunc(F.to_date(ts), "month")
    return (
        df.groupBy(month_label(F.col(ts)).alias("month_year"), month.alias("month_start"))
        .agg(rows_where(F.col(flag)).alias(name))
        .orderBy("month_start")
    )


def clean_revenue_by_city(master: DataFrame) -> DataFrame:
    """Revenue of issue-free sessions; sessions without city are left out, as a grouping by name does."""
    return (
        master.where(~F.col("has_issues") & F.col("city").isNotNull())
        .groupBy("city")
        .agg(F.coalesce(F.sum("amount"), F.lit(0)).cast("decimal(20,2)").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"))
    )


def energy_trend(master: DataFrame, days: int | None = 90, city: str | None = None) -> DataFrame:
    """Daily energy of issue-free sessions from ``days`` before the last such day on (all days for None)."""
    clean = master.where(~F.col("has_issues") & F.col("start_time").isNotNull())
    if city is not None:
        clean = clean.where(F.col("city") == city)
    daily = clean.groupBy(F.to_date("start_time").alias("date")).agg(
        F.coalesce(F.sum("kwh_consumed"), F.lit(0)).cast("decimal(20,4)").alias("total_kwh")
    )
    if days is not None:
        first = clean.agg(F.date_sub(F.max(F.to_date("start_time")), days))
        daily = daily.where(F.col("date") >= first.scalar())
    return daily.orderBy("date")


def city_from_coordinates(chargers: DataFrame, places: DataFrame, place_cities: DataFrame) -> DataFrame:
    """Chargers with the city of the nearest known place, districts counting towards their city."""
    found = nearest_place(chargers, places).withColumnRenamed("place", "city_from_coords")
    return replace_values(found, "city_from_coords", place_cities, "place", "city")
