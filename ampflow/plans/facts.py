"""Facts of the semantic layer: sessions, day x city, charger lifetime."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampflow.config import ALL_CITIES, Run
from ampflow.functions.calendar import date_key
from ampflow.functions.measures import all_of, any_of, is_true, percent, positive, ratio, rows_where, sum_where
from ampflow.operators.distinct import distinct_counts, distinct_counts_with_total, join_on_group
from ampflow.operators.joins import left_join_many
from ampflow.operators.ranking import with_tiles
from ampflow.session import cut_lineage

SESSION_FLAGS = (
    "is_invalid_time_range",
    "is_missing_kwh",
    "is_negative_kwh",
    "is_outlier_kwh",
    "is_outlier_duration",
)
PAYMENT_FLAGS = {
    "is_missing_amount": "is_missing_payment_amount",
    "is_invalid_amount": "is_invalid_payment_amount",
    "is_outlier_amount": "is_outlier_payment_amount",
}


def quality_issue() -> Column:
    """Any flag of the session or its payment, or no payment at all (whatever the status)."""
    flags = [*SESSION_FLAGS, *PAYMENT_FLAGS.values()]
    return any_of([*[F.col(f) for f in flags], F.col("payment_id").isNull()])


def valid_transaction() -> Column:
    """Completed, paid, plausible. Outliers of energy or duration and a NULL amount do not disqualify."""
    return all_of(
        [
            F.col("transaction_status") == "completed",
            ~F.col("is_invalid_time_range"),
            ~F.col("is_missing_kwh"),
            ~F.col("is_negative_kwh"),
            ~F.col("is_outlier_payment_amount"),
            F.col("payment_id").isNotNull(),
            ~F.col("is_invalid_payment_amount"),
        ]
    )


def missing_payment() -> Column:
    return F.col("payment_id").isNull() & is_true(F.col("transaction_status") == "completed")


def joined_sessions(cur_transactions: DataFrame, cur_payments: DataFrame, cur_chargers: DataFrame) -> DataFrame:
    """Sessions with payment and city. Several payments of a session give several rows, as in the plain joins."""
    paid = cur_payments.select("session_id", "payment_id", "amount", "currency", *PAYMENT_FLAGS)
    cities = cur_chargers.select("charger_id", F.col("city").alias("city_name"))
    sessions = cur_transactions.withColumnRenamed("_dbt_updated_at", "_curated_updated_at")
    return left_join_many(sessions, paid, "session_id").join(cities, "charger_id", "left")


def fact_transactions(
    cur_transactions: DataFrame, cur_payments: DataFrame, cur_chargers: DataFrame, run: Run
) -> DataFrame:
    joined = joined_sessions(cur_transactions, cur_payments, cur_chargers)
    kwh, minutes, amount = F.col("kwh_consumed"), F.col("charging_duration_minutes"), F.col("amount")
    day = F.to_date("start_time")
    status = F.col("transaction_status")
    return (
        joined.withColumnRenamed("status", "transaction_status")
        .withColumns({new: is_true(F.col(old)) for old, new in PAYMENT_FLAGS.items()})
        .select(
            "session_id",
            F.col("user_id").alias("user_key"),
            F.col("charger_id").alias("charger_key"),
            "city_name",
            date_key(day).alias("transaction_date_key"),
            day.alias("transaction_date"),
            "start_time",
            "end_time",
            kwh.alias("energy_kwh"),
            F.coalesce(kwh, F.lit(0).cast("decimal(10,4)")).alias("energy_kwh_coalesced"),
            minutes.alias("duration_minutes"),
            F.coalesce(minutes, F.lit(0)).alias("duration_minutes_coalesced"),
            amount.alias("payment_amount"),
            F.coalesce(amount, F.lit(0).cast("decimal(10,2)")).alias("payment_amount_coalesced"),
            F.col("currency").alias("payment_currency"),
            F.when(kwh > 0, ratio(amount, kwh)).alias("revenue_per_kwh"),
            F.when(minutes > 0, ratio(kwh, minutes / 60.0)).alias("charging_rate_kw"),
            "payment_method",
            "transaction_status",
            "payment_id",
            *SESSION_FLAGS,
            missing_payment().alias("is_missing_payment"),
            *PAYMENT_FLAGS.values(),
            quality_issue().alias("has_any_quality_issue"),
            valid_transaction().alias("is_valid_transaction"),
            F.lit(1).alias("transaction_count"),
            is_true(status == "completed").cast("int").alias("completed_transaction_count"),
            is_true(status == "failed").cast("int").alias("failed_transaction_count"),
            "_loaded_at",
            "_source_file",
            "_curated_updated_at",
            run.stamp().alias("_semantic_updated_at"),
        )
    )


def _average(total: str, rows: str) -> Column:
    return ratio(F.col(total), F.col(rows))


def fact_daily_metrics(fact: DataFrame, run: Run) -> DataFrame:
    """Day x city measures plus one all-cities row per day.

    The fact is aggregated per day and city only; the all-cities rows are sums of those few rows. Distinct users and
    chargers do not add up over cities, so each is also counted in the first city it is met in, which does. A NULL
    city is a group of its own: the total is told by ``grouping``, never by a NULL name.
    """
    dated = fact.where(F.col("transaction_date").isNotNull())
    valid = F.col("is_valid_transaction")
    amount, kwh, minutes = F.col("payment_amount"), F.col("energy_kwh"), F.col("duration_minutes")
    method = F.col("payment_method")
    additive = {
        "total_revenue": F.sum("payment_amount_coalesced"),
        "valid_revenue": sum_where(valid, F.col("payment_amount_coalesced")),
        "_paid_sum": F.sum(positive(amount)),
        "_paid_rows": F.count(positive(amount)),
        "total_energy_kwh": F.sum("energy_kwh_coalesced"),
        "valid_energy_kwh": sum_where(valid, F.col("energy_kwh_coalesced")),
        "_energy_sum": F.sum(positive(kwh)),
        "_energy_rows": F.count(positive(kwh)),
        "total_duration_minutes": F.sum("duration_minutes_coalesced"),
        "_duration_sum": F.sum(positive(minutes)),
        "_duration_rows": F.count(positive(minutes)),
        "total_transactions": F.count(F.lit(1)),
        "completed_transactions": F.sum("completed_transaction_count"),
        "failed_transactions": F.sum("failed_transaction_count"),
        "valid_transactions": rows_where(valid),
        "transactions_with_issues": rows_where(F.col("has_any_quality_issue")),
        "transactions_missing_payment": rows_where(F.col("is_missing_payment")),
        "transactions_invalid_time": rows_where(F.col("is_invalid_time_range")),
        "transactions_invalid_kwh": rows_where(any_of([F.col("is_missing_kwh"), F.col("is_negative_kwh")])),
        "transactions_with_outliers": rows_where(
            any_of([F.col("is_outlier_kwh"), F.col("is_outlier_duration"), F.col("is_outlier_payment_amount")])
        ),
        "card_transactions": rows_where(method == "card"),
        "rfid_transactions": rows_where(method == "RFID"),
        "app_wallet_transactions": rows_where(method == "app_wallet"),
    }
    day, city = ["transaction_date", "transaction_date_key"], "city_name"
    counted = {"active_users": "user_key", "active_chargers": "charger_key"}
    per_city = join_on_group(
        dated.groupBy(*day, city).agg(*[agg.alias(name) for name, agg in additive.items()]),
        distinct_counts_with_total(dated, day[:1], city, counted),
        [day[0], city],
    )
    is_total = F.grouping(city) == 1
    entities = [
        F.coalesce(F.when(is_total, F.sum(f"{out}_first")).otherwise(F.sum(out)), F.lit(0)).alias(out)
        for out in counted
    ]
    metrics = per_city.groupingSets([[F.col(c) for c in (*day, city)], [F.col(c) for c in day]], *day, city).agg(
        is_total.alias("_is_total"), *[F.sum(name).alias(name) for name in additive], *entities
    )
    rows = F.col("total_transactions")
    return metrics.select(
        "transaction_date",
        F.when(F.col("_is_total"), ALL_CITIES).otherwise(F.col("city_name")).alias("city_name"),
        "transaction_date_key",
        "total_revenue",
        "valid_revenue",
        _average("_paid_sum", "_paid_rows").alias("avg_revenue_per_transaction"),
        "total_energy_kwh",
        "valid_energy_kwh",
        _average("_energy_sum", "_energy_rows").alias("avg_energy_per_transaction"),
        "total_duration_minutes",
        _average("_duration_sum", "_duration_rows").alias("avg_duration_minutes"),
        "total_transactions",
        "completed_transactions",
        "failed_transactions",
        "valid_transactions",
        "active_users",
        "active_chargers",
        "transactions_with_issues",
        "transactions_missing_payment",
        "transactions_invalid_time",
        "transactions_invalid_kwh",
        "transactions_with_outliers",
        percent(F.col("valid_transactions"), rows).alias("valid_transaction_pct"),
        percent(F.col("transactions_with_issues"), rows).alias("issue_transaction_pct"),
        percent(F.col("transactions_missing_payment"), rows).alias("missing_payment_pct"),
        "card_transactions",
        "rfid_transactions",
        "app_wallet_transactions",
        run.stamp().alias("_dbt_updated_at"),
    )


# What of the session fact the lifetime measures read.
LIFETIME_COLUMNS = (
    "charger_key",
    "user_key",
    "transaction_date",
    "completed_transaction_count",
    "failed_transaction_count",
    "is_valid_transaction",
    "payment_amount_coalesced",
    "energy_kwh",
    "energy_kwh_coalesced",
    "duration_minutes",
    "duration_minutes_coalesced",
    "has_any_quality_issue",
)


def charger_lifetime(fact: DataFrame, run: Run) -> DataFrame:
    """Lifetime measures per charger; sessions without charger form the NULL group."""
    valid = F.col("is_valid_transaction")
    revenue = F.col("payment_amount_coalesced")
    totals = fact.groupBy("charger_key").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("completed_transaction_count").alias("completed_transactions"),
        F.sum("failed_transaction_count").alias("failed_transactions"),
        rows_where(valid).alias("valid_transactions"),
        F.sum(revenue).alias("total_revenue"),
        sum_where(valid, revenue).alias("valid_revenue"),
        F.sum("energy_kwh_coalesced").alias("total_energy_kwh"),
        F.sum(positive(F.col("energy_kwh"))).alias("_energy_sum"),
        F.count(positive(F.col("energy_kwh"))).alias("_energy_rows"),
        F.sum("duration_minutes_coalesced").alias("total_duration_minutes"),
        F.sum(positive(F.col("duration_minutes"))).alias("_duration_sum"),
        F.count(positive(F.col("duration_minutes"))).alias("_duration_rows"),
        F.min("transaction_date").alias("first_transaction_date"),
        F.max("transaction_date").alias("last_transaction_date"),
        rows_where(F.col("has_any_quality_issue")).alias("transactions_with_issues"),
    )
    counted = {"unique_users": "user_key", "days_with_transactions": "transaction_date"}
    totals = join_on_group(totals, distinct_counts(fact, ["charger_key"], counted), ["charger_key"]).fillna(
        0, subset=list(counted)
    )
    rows, days = F.col("total_transactions"), F.col("days_with_transactions")
    span = F.datediff("last_transaction_date", "first_transaction_date") + 1
    zero = F.lit(0.0)
    return totals.select(
        "charger_key",
        "total_transactions",
        "completed_transactions",
        "failed_transactions",
        "valid_transactions",
        "total_revenue",
        "valid_revenue",
        F.coalesce(ratio(F.col("total_revenue"), rows), zero).alias("avg_revenue_per_transaction"),
        F.coalesce(ratio(F.col("valid_revenue"), F.col("valid_transactions")), zero).alias(
            "avg_valid_revenue_per_transaction"
        ),
        "total_energy_kwh",
        _average("_energy_sum", "_energy_rows").alias("avg_energy_per_transaction"),
        "total_duration_minutes",
        _average("_duration_sum", "_duration_rows").alias("avg_duration_minutes"),
        "unique_users",
        "first_transaction_date",
        "last_transaction_date",
        span.alias("active_days_span"),
        "days_with_transactions",
        F.coalesce(percent(days, span), zero).alias("utilization_pct"),
        F.coalesce(ratio(rows, days), zero).alias("avg_transactions_per_day"),
        F.coalesce(ratio(F.col("total_revenue"), days), zero).alias("avg_revenue_per_day"),
        "transactions_with_issues",
        percent(F.col("valid_transactions"), rows).alias("valid_transaction_pct"),
        run.stamp().alias("_dbt_updated_at"),
    )


QUARTILE_MEASURES = {
    "transaction_volume_quartile": "total_transactions",
    "revenue_per_txn_quartile": "avg_revenue_per_transaction",
    "total_revenue_quartile": "total_revenue",
}


def performance_class(volume: Column, value: Column) -> Column:
    """Quadrant of two quartiles; the labels are fixed values. 'Average' is documented but cannot occur with quartiles 1 to 4."""
    busy, rich = volume >= 3, value >= 3
    return (
        F.when((volume == 4) & (value == 4), "Star Performer")
        .when(busy & rich, "High Performer")
        .when(~busy & ~rich, "Underperformer")
        .when(busy & ~rich, "High Volume / Low Value")
        .when(~busy & rich, "Low Volume / High Value")
        .otherwise("Average")
    )


def fact_charger_performance(lifetime: DataFrame, dim_chargers: DataFrame) -> DataFrame:
    """Lifetime measures with charger attributes, quartiles and quadrant."""
    attributes = dim_chargers.select(
        "charger_key",
        "charger_id",
        "charger_city",
        "charger_installed_date",
        "charger_age_days",
        "charger_age_band",
        F.col("has_data_quality_issue").alias("charger_has_data_quality_issue"),
        F.col("data_quality_status").alias("charger_data_quality_status"),
    )
    ranked = with_tiles(cut_lineage(lifetime), "charger_key", QUARTILE_MEASURES)
    volume, value = F.col("transaction_volume_quartile"), F.col("revenue_per_txn_quartile")
    return ranked.join(attributes, "charger_key", "left").withColumn(
        "performance_classification", performance_class(volume, value)
    )
