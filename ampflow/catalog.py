"""Every registered query: name -> (session, folder of test tables) -> DataFrame.

A query states one operator or model over the layer tables below it; those are written once per application, except where
one reader needs a part of them (:meth:`Warehouse.model`).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ampflow.config import AGE_BAND, MARKET_BAND, TENURE_BAND
from ampflow.functions import measures, parsing
from ampflow.operators import bitmaps, joins, profile, quantiles, ranking, rules
from ampflow.operators.distinct import distinct_counts
from ampflow.operators.nearest import nearest_place
from ampflow.plans import curated, dimensions, eda, facts, marts, monitor, stage
from ampflow.plans.quality_rules import METHODS, RULES, TIERS
from ampflow.plans.warehouse import STAGE, TEST_REPORTING, TEST_RUN, Warehouse, refresh
from ampflow.sources import domain, raw, seeds
from ampflow.streaming import monitoring
from ampflow.streaming.alerts import alert_on_new_sessions, open_alerts
from ampflow.streaming.landing import Landing, load_new_files, loaded, quarantined
from ampflow.streaming.merge import MergeTarget, merge_new_files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
FRESHNESS_CLOCK = datetime(2001, 8, 2, 12, 0)
PCT_THRESHOLD = 60.0


def query(function: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """Registers a function of the warehouse under its own name."""
    QUERIES[function.__name__] = lambda spark, sf_dir: function(Warehouse(spark, sf_dir))
    return function


def _model_query(name: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: Warehouse(spark, sf_dir).model(name)


for _name in (
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
):
    _model_query(_name)


# --- sources ---------------------------------------------------------------------------------------------------


def _work_folder(w: Warehouse, name: str) -> str:
    return f"{w.store.root}/work/{name}-{uuid.uuid4().hex}"


def _written_lines(w: Warehouse, table: str) -> str:
    """The stage table as JSON lines in a fresh folder."""
    path = _work_folder(w, f"raw_{table}")
    w.table(f"stg_{table}").select(stage.as_json(table).alias("value")).write.text(path)
    return path


def _cut(every: int, number: Column, line: Column) -> Column:
    """Every so many lines end after 40 characters."""
    return F.when(number % every == 0, F.substr(line, F.lit(1), F.lit(40))).otherwise(line)


def _number(key: str) -> Column:
    return F.substr(key, F.lit(2)).cast("bigint")


@query
def raw_json_scan(w):
    """Lines, every 97th cut short."""
    path = _work_folder(w, "raw_users")
    line = _cut(97, _number("user_id"), stage.as_json("users"))
    w.table("stg_users").select(line.alias("value")).write.text(path)
    users = raw.scan_json(w.spark, path, raw.RAW_SCHEMAS["users"])
    return users.withColumn("created_at", parsing.safe_timestamp(F.col("created_at")))


@query
def flatten_location(w):
    chargers = raw.scan_json(w.spark, _written_lines(w, "chargers"), raw.RAW_SCHEMAS["chargers"])
    return raw.flatten_location(chargers).withColumn("installed_at", parsing.safe_timestamp(F.col("installed_at")))


@query
def raw_variant_land(w):
    landed = raw.land_variant(w.spark, _written_lines(w, "chargers"), TEST_RUN.stamp())
    return stage.stg_chargers(landed, TEST_RUN).drop("_source_file")


@query
def raw_variant_land_array(w):
    """Array files of at most 2,000 records, four of five with a fault: cut off, a repeated key, no object, bad bytes.

    Two more are no array.
    """
    path = _work_folder(w, "raw_arrays")
    number = _number("charger_id")
    rows = w.table("stg_chargers").select(
        (F.floor(number / 10_000) * 5 + number % 5).alias("file"), F.struct("charger_id", stage.as_json("chargers").alias("json")).alias("r")
    )
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["json"]), ",\n")
    files = rows.groupBy("file").agg(joined.alias("records"))
    ends = {0: "]", 1: ', {"charger_id": "cut', 2: ', {"x": 2, "x": 3}]', 3: ", 17 ]"}
    ending = F.concat(F.lit(', {"x": "'), F.unhex(F.lit("FF")).cast("string"), F.lit('"}]'))
    for file, end in ends.items():
        ending = F.when(F.col("file") % 5 == file, end).otherwise(ending)
    lone = F.when(F.col("id") == 0, '{"charger_id": "alone"}').otherwise("no record").alias("value")
    others = w.spark.range(2).select((-1 - F.col("id")).alias("file"), lone)
    arrays = files.select("file", F.concat(F.lit("["), "records", ending).alias("value"))
    arrays.unionByName(others).write.partitionBy("file").text(path)  # a folder, and so a file, for each
    landed = raw.land_variant_array(w.spark, path, TEST_RUN.stamp())
    good, bad = raw.good_and_bad(landed)
    columns = ["charger_id", "city", "latitude", "longitude"]
    nothing = [F.lit(None).cast(t).alias(c) for c, t in stage.stg_chargers(good, TEST_RUN).select(*columns).dtypes]
    return stage.stg_chargers(good, TEST_RUN).select(*columns, F.lit(None).cast("string").alias("bad_line")).unionByName(
        bad.select(*nothing, F.col("_bad_line").alias("bad_line"))
    )


@query
def raw_variant_land_large_array(w):
    """Sessions in array files of up to 200,000 records, each read by as many tasks as it has blocks."""
    path = _work_folder(w, "raw_large_arrays")
    number = _number("session_id")
    rows = w.table("stg_transactions").select(
        F.floor(number / 200_000).alias("file"), "session_id", stage.as_json("transactions").alias("json")
    )
    # A file has a record a line; the window is no larger than a file.
    order = Window.partitionBy("file").orderBy("session_id")
    ends = rows.withColumns({"first": F.row_number().over(order) == 1, "last": F.lead("session_id").over(order).isNull()})
    lines = ends.select(
        "file", "session_id", F.concat(F.when(F.col("first"), "[").otherwise(""), "json", F.when(F.col("last"), "]").otherwise(",")).alias("value")
    )
    lines.repartition("file").sortWithinPartitions("file", "session_id").select("file", "value").write.partitionBy("file").text(path)
    landed = raw.land_variant_array(w.spark, path, TEST_RUN.stamp())
    good, bad = raw.good_and_bad(landed)
    sessions = stage.stg_transactions(good, TEST_RUN).drop("_source_file", "_loaded_at", "_dbt_updated_at")
    return sessions.withColumn("bad_line", F.lit(None).cast("string")).unionByName(
        bad.select(F.col("_bad_line").alias("bad_line")), allowMissingColumns=True
    )


@query
def load_with_quarantine(w):
    """Sessions arrive as lines and are loaded twice; some are cut short, repeat a key, or have text as their energy."""
    source = _work_folder(w, "arriving")
    number = _number("session_id")
    line = stage.as_json("transactions")
    twice = F.concat(F.lit('{"session_id":"'), "session_id", F.lit('","session_id":"'), "session_id", F.lit('"}'))
    text = F.regexp_replace(line, '"kWh_consumed":[^,]*', '"kWh_consumed":"zz"')
    line = F.when(number % 89 == 0, twice).when(number % 83 == 0, text).otherwise(line)
    w.table("stg_transactions").select(_cut(97, number, line).alias("value")).write.text(source)
    landing = Landing(source, raw.RAW_SCHEMAS["transactions"], _work_folder(w, "landed"), _work_folder(w, "progress"))
    for _ in range(2):
        load_new_files(w.spark, landing, TEST_RUN.stamp())
    energy = parsing.safe_decimal(F.col("kWh_consumed"), 10, 4).cast("double")
    good = loaded(w.spark, landing).select("session_id", "user_id", "charger_id", "status", energy.alias("kwh"))
    return good.withColumn("bad_line", F.lit(None).cast("string")).unionByName(
        quarantined(w.spark, landing).select("bad_line"), allowMissingColumns=True
    )


@query
def load_row_counts(w):
    return raw.row_counts(
        {t: w.table(f"stg_{t}") for t in ("users", "chargers", "transactions", "payments")}
    )


@query
def seed_city_map(w):
    """The seed with the number of chargers that use each spelling."""
    used = w.table("stg_chargers").groupBy("city").agg(F.count(F.lit(1)).alias("chargers"))
    seed = seeds.city_map(w.spark)
    return seed.join(used, F.col("city_name_raw") == F.col("city"), "left").select(
        "city_name_raw", "city_name_standardized", F.coalesce("chargers", F.lit(0)).alias("chargers")
    )


def _stage_query(table: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        records = stage.as_variant(Warehouse(spark, sf_dir).table(f"stg_{table}"), table)
        return getattr(stage, f"stg_{table}")(records, TEST_RUN)

    QUERIES[f"stg_{table}"] = run


for _name in ("users", "chargers", "transactions", "payments"):
    _stage_query(_name)


# --- projections and parsing -------------------------------------------------------------------------------------


@query
def variant_extract(w):
    events = domain.read(w.spark, w.sf_dir, "events").withColumn("v", F.try_parse_json("props"))
    return events.select(
        "event_id",
        parsing.json_field("v", "$.k", "bigint").alias("k"),
        parsing.json_field("v", "$.k").alias("k_text"),
        parsing.json_field("v", "$.missing.path").alias("absent"),
    )


@query
def safe_timestamp(w):
    """Event times as text, every 7th damaged, every 11th with an offset that must not be applied."""
    events = domain.read(w.spark, w.sf_dir, "events")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    raw_text = (
        F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("x"), text))
        .when(F.col("event_id") % 11 == 0, F.concat(text, F.lit("+05:00")))
        .otherwise(text)
    )
    return events.select("event_id", parsing.safe_timestamp(raw_text).alias("parsed"))


@query
def safe_decimal(w):
    """Event values as text, every 5th damaged; overflow of the narrow type becomes NULL."""
    events = domain.read(w.spark, w.sf_dir, "events")
    text = F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.col("value").cast("string"))
    return events.select(
        "event_id",
        parsing.safe_decimal(text, 10, 1).alias("one_digit"),
        parsing.safe_decimal(text, 4, 2).alias("narrow"),
    )


@query
def tenure_band(w):
    days = dimensions.days_since(F.col("created_at"), w.run)
    banded = w.table("cur_users").withColumn("user_tenure_band", measures.band(days, TENURE_BAND))
    return banded.groupBy("user_tenure_band").agg(F.count(F.lit(1)).alias("users"))


@query
def age_band(w):
    days = dimensions.days_since(F.col("installed_at"), w.run)
    banded = w.table("cur_chargers").withColumn("charger_age_band", measures.band(days, AGE_BAND))
    return banded.groupBy("charger_age_band").agg(F.count(F.lit(1)).alias("chargers"))


@query
def market_tier(w):
    return dimensions.charger_cities(w.table("cur_chargers")).select(
        "city_name", "charger_count", measures.band(F.col("charger_count"), MARKET_BAND).alias("market_size_tier")
    )


@query
def tier_display(w):
    tier = F.col("tier")
    return (
        w.table("cur_users")
        .groupBy("tier")
        .agg(F.count(F.lit(1)).alias("users"))
        .select(
            "tier",
            dimensions.tier_rank(tier).alias("sort_order"),
            dimensions.tier_display(tier).alias("display"),
            "users",
        )
    )


@query
def derived_ratios(w):
    return w.table("fact_transactions").select("session_id", "revenue_per_kwh", "charging_rate_kw")


@query
def dq_status(w):
    status = dimensions.quality_status(F.col("is_invalid_location"), F.col("is_unmapped_city"))
    return w.table("cur_chargers").select("charger_id", status.alias("data_quality_status"))


@query
def strip_timezone(w):
    """Order times read as zoned, stripped again."""
    zoned = domain.read(w.spark, w.sf_dir, "orders").select(
        "o_orderkey", F.convert_timezone(F.lit("UTC"), F.current_timezone(), "o_orderdate").cast("timestamp").alias("ts")
    )
    return parsing.strip_timezone(zoned)


# --- flags ---------------------------------------------------------------------------------------------------------


@query
def invalid_location(w):
    return w.table("stg_chargers").select("charger_id", curated.location_flag(w.run.box))


@query
def unmapped_city(w):
    mapped = joins.lookup_spelling(
        w.table("stg_chargers"), "city", w.table("city_name_mapping"), "city_name_raw", "city_name_standardized"
    )
    return mapped.where(F.col("city_name_standardized").isNull()).select("charger_id", "city")


@query
def missing_flags(w):
    sessions = w.table("stg_transactions").agg(measures.rows_where(F.col("kwh_consumed").isNull()).alias("missing_kwh"))
    paid = w.table("stg_payments").agg(measures.rows_where(F.col("amount").isNull()).alias("missing_amount"))
    return joins.with_row(sessions, paid)


@query
def sign_flags(w):
    sessions = w.table("stg_transactions").agg(measures.rows_where(F.col("kwh_consumed") < 0).alias("negative_kwh"))
    paid = w.table("stg_payments").agg(measures.rows_where(F.col("amount") <= 0).alias("invalid_amount"))
    return joins.with_row(sessions, paid)


@query
def invalid_time_range(w):
    flag = measures.ends_before_start(F.col("start_time"), F.col("end_time"))
    return w.table("stg_transactions").where(flag).select("session_id", "start_time", "end_time")


def _outliers(df: DataFrame, rule: quantiles.IqrRule, *shown: str) -> DataFrame:
    return quantiles.with_iqr_bounds(df, [rule]).where(rule.outlier()).select(*shown)


@query
def iqr_outlier_amount(w):
    return _outliers(w.table("stg_payments"), curated.AMOUNT_RULE, "payment_id", "amount")


@query
def iqr_outlier_kwh(w):
    return _outliers(w.table("stg_transactions"), curated.KWH_RULE, "session_id", "kwh_consumed")


@query
def iqr_outlier_duration(w):
    timed = curated.with_duration(w.table("stg_transactions"))
    return _outliers(timed, curated.DURATION_RULE, "session_id", "charging_duration_minutes")


@query
def iqr_outlier_all(w):
    """Whole-series rule on signed account balances, in cents."""
    rule = quantiles.IqrRule("balance", quantiles.decimal_measure("balance", 12, 2), positive_only=False)
    customers = domain.read(w.spark, w.sf_dir, "customer").select(
        "c_custkey", F.col("c_acctbal").cast("decimal(12,2)").alias("balance")
    )
    return quantiles.with_iqr_bounds(customers, [rule]).select(
        "c_custkey",
        rule.outlier().alias("is_outlier"),
        F.col("balance_lower_bound").alias("lower_bound"),
        F.col("balance_upper_bound").alias("upper_bound"),
    )


@query
def iqr_bounds(w):
    sessions = quantiles.iqr_bounds(
        curated.with_duration(w.table("stg_transactions")), [curated.KWH_RULE, curated.DURATION_RULE]
    )
    paid = quantiles.iqr_bounds(w.table("stg_payments"), [curated.AMOUNT_RULE])
    both = joins.with_row(sessions, paid)
    names = ("n", "q1", "q3", "iqr", "lower_bound", "upper_bound")
    return both.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("measure"), *[F.col(f"{m}_{n}").alias(n) for n in names])
                    for m in ("kwh", "duration", "amount")
                ]
            )
        )
    )


def _joined(w) -> DataFrame:
    return facts.joined_sessions(
        w.table("cur_transactions"), w.table("cur_payments"), w.table("cur_chargers")
    ).withColumnRenamed("status", "transaction_status").withColumns(
        {new: measures.is_true(F.col(old)) for old, new in facts.PAYMENT_FLAGS.items()}
    )


@query
def missing_payment(w):
    return _joined(w).where(facts.missing_payment()).select("session_id", "user_id")


@query
def any_quality_issue(w):
    return _joined(w).select("session_id", facts.quality_issue().alias("has_any_quality_issue"))


@query
def valid_transaction(w):
    return _joined(w).select("session_id", facts.valid_transaction().alias("is_valid_transaction"))


# --- joins -----------------------------------------------------------------------------------------------------------


@query
def city_standardize(w):
    return w.table("cur_chargers").groupBy("city", "city_original").agg(F.count(F.lit(1)).alias("chargers"))


@query
def skewed_left_join(w):
    """Line items of every customer segment: few keys, each split over several tasks."""
    read = lambda name: domain.read(w.spark, w.sf_dir, name)
    segments = read("customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("customers"))
    segments = segments.withColumn("key", F.ascii("segment") % 3)
    lines = read("lineitem").select((F.col("l_linenumber") % 3).cast("int").alias("key"), "l_orderkey", "l_linenumber")
    return joins.left_join_many(segments, lines, "key", rows_per_task=5000)


@query
def nearest_city(w):
    found = nearest_place(w.table("stg_chargers"), seeds.places(w.spark))
    return found.select("charger_id", "place", F.round("distance_km", 6).alias("distance_km"))


@query
def city_agreement(w):
    chargers = eda.clean_chargers(w.table("stg_chargers"), w.run.box)
    located = eda.city_from_coordinates(chargers, seeds.places(w.spark), seeds.place_cities(w.spark))
    return profile.pair_counts(located, "city", "city_from_coords")


# --- exploration -------------------------------------------------------------------------------------------------------


def _master(w) -> DataFrame:
    """The exploration's joined frame, written once."""

    def build() -> DataFrame:
        return eda.master_frame(
            eda.joined_frame(
                eda.clean_transactions(w.table("stg_transactions")),
                w.table("stg_users"),
                eda.clean_chargers(w.table("stg_chargers"), w.run.box),
                eda.clean_payments(w.table("stg_payments")),
            )
        )

    return w.store.table("eda_master", build)


@query
def master_frame(w):
    joined = eda.joined_frame(
        eda.clean_transactions(w.table("stg_transactions")),
        w.table("stg_users"),
        eda.clean_chargers(w.table("stg_chargers"), w.run.box),
        eda.clean_payments(w.table("stg_payments")),
    )
    return eda.master_frame(joined)


@query
def user_id_mismatch(w):
    return eda.user_id_mismatch(w.table("stg_transactions"), w.table("stg_payments"))


@query
def row_issue_count(w):
    flags = [F.col(c) for c in eda.ISSUES]
    return _master(w).select(
        "session_id",
        measures.any_of(flags).alias("has_issues"),
        measures.count_of(flags).alias("total_issues"),
    )


@query
def threshold_counts(w):
    return eda.threshold_counts(_master(w))


@query
def email_validity(w):
    return eda.email_validity(w.table("stg_users"))


@query
def clean_revenue_by_city(w):
    return eda.clean_revenue_by_city(_master(w))


@query
def energy_trend(w):
    return eda.energy_trend(_master(w))


@query
def energy_trend_city(w):
    return eda.energy_trend(_master(w), days=None, city="Zurich")


@query
def issues_per_month(w):
    return eda.flagged_per_month(_master(w), "start_time", "has_issues", "num_issues")


@query
def invalid_locations_per_month(w):
    chargers = eda.clean_chargers(w.table("stg_chargers"), w.run.box)
    return eda.flagged_per_month(chargers, "installed_at", "is_invalid_location", "num_invalid_locations")


@query
def issue_crosstab(w):
    return profile.flag_crosstab(_master(w), eda.ISSUES)


@query
def value_counts(w):
    return profile.value_counts(_master(w), "cost_per_kwh")


@query
def issues_by_dimension(w):
    issues = _master(w).where("has_issues")
    return profile.counts_by(issues, ("city", "payment_method", "tier", "status"))


@query
def issue_distribution(w):
    return eda.issue_distribution(_master(w))


@query
def describe(w):
    described = profile.describe(_master(w))
    exact = {c: F.round(c, 4) for c in ("p25", "p50", "p75")}
    # Times are some 1e9 seconds, where doubles added up in another order differ in the fifth digit after the point.
    return described.withColumns(exact | {c: F.expr(f"IF(abs(mean) > 1e6, ROUND({c}, 0), ROUND({c}, 4))") for c in ("mean", "std")})


@query
def null_counts(w):
    return profile.null_counts(w.table("stg_transactions"))


@query
def distinct_values(w):
    return profile.distinct_values(w.table("stg_chargers"), "city")


@query
def histogram(w):
    bins = profile.histogram(domain.read(w.spark, w.sf_dir, "events"), "value", 30)
    return bins.withColumns({c: F.round(c, 6) for c in ("bin_start", "bin_end")})


@query
def profile_table(w):
    numeric = profile.profile_numeric(_master(w))
    rounded = ("sum", "mean", "variance", "std", "skewness", "kurtosis", "range", "min", "max")
    return numeric.withColumns({c: F.round(c, 4) for c in rounded})


@query
def profile_frames(w):
    """The profile of all five exploration frames, every column and every statistic of them."""
    frames = {t: w.table(f"stg_{t}") for t in ("chargers", "payments", "users", "transactions")}
    profiled = profile.profile_frames(frames | {"master": _master(w)})
    exact = {c: F.round(F.col(c), 4) for c in ("p25", "p50", "p75", "skewness", "kurtosis", "mean_length", "p_missing")}
    return profiled.withColumns(exact | {c: F.expr(f"IF(kind = 'time', ROUND({c}, 0), ROUND({c}, 4))") for c in ("mean", "std")})


@query
def profile_columns(w):
    return profile.profile_columns(w.table("stg_payments"))


@query
def profile_correlations(w):
    return profile.profile_correlations(_master(w)).withColumn("correlation", F.round("correlation", 6))


@query
def profile_duplicates(w):
    """Whole order lines, each of every fifth order twice."""
    lines = domain.read(w.spark, w.sf_dir, "lineitem")
    return profile.profile_duplicates(lines.unionByName(lines.where("l_orderkey % 5 = 0")))


@query
def profile_time_series(w):
    series = profile.profile_time_series(w.table("stg_transactions"), "start_time")
    return series.withColumns({f"autocorrelation_{k}": F.round(f"autocorrelation_{k}", 6) for k in (1, 7)})


# --- aggregates and windows ------------------------------------------------------------------------------------------


@query
def charger_totals(w):
    return (
        w.table("fact_transactions")
        .groupBy("charger_key")
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            F.sum("payment_amount_coalesced").alias("total_revenue"),
            F.min("transaction_date").alias("first_transaction_date"),
            F.max("transaction_date").alias("last_transaction_date"),
        )
    )


@query
def active_entities(w):
    return distinct_counts(
        w.table("fact_transactions"),
        ["transaction_date"],
        {"active_users": "user_key", "active_chargers": "charger_key"},
    )


@query
def city_variants(w):
    """Spellings of the standard cities that have chargers."""
    cities = w.table("cur_chargers").groupBy(F.col("city").alias("city_name")).agg(F.count(F.lit(1)).alias("chargers"))
    return cities.join(dimensions.city_variants(seeds.city_map(w.spark)), "city_name")


@query
def charger_lifetime(w):
    return facts.charger_lifetime(w.table("fact_transactions"), w.run)


@query
def charger_utilization(w):
    return facts.charger_lifetime(w.table("fact_transactions"), w.run).select(
        "charger_key", "active_days_span", "days_with_transactions", "utilization_pct"
    )


def _lifetime(w) -> DataFrame:
    return w.store.table("charger_lifetime", lambda: facts.charger_lifetime(w.table("fact_transactions"), w.run))


@query
def charger_quartiles(w):
    return ranking.with_tiles(_lifetime(w), "charger_key", facts.QUARTILE_MEASURES).select(
        "charger_key", *facts.QUARTILE_MEASURES
    )


@query
def performance_class(w):
    performance = w.table("fact_charger_performance")
    return performance.groupBy("performance_classification").agg(
        F.count(F.lit(1)).alias("chargers"), F.sum("total_revenue").alias("total_revenue")
    )


# --- dashboard ---------------------------------------------------------------------------------------------------------


@query
def kpi_month_over_month(w):
    return marts.kpi_month_over_month(w.table("fact_daily_metrics"), w.table("dim_dates"), TEST_REPORTING)


@query
def kpi_pct_change(w):
    return marts.kpi_pct_change(
        marts.kpi_month_over_month(w.table("fact_daily_metrics"), w.table("dim_dates"), TEST_REPORTING)
    )


@query
def revenue_trend(w):
    return marts.revenue_trend(w.table("fact_daily_metrics"), TEST_REPORTING)


@query
def revenue_trend_all(w):
    return marts.revenue_trend_all(w.table("fact_daily_metrics"), TEST_REPORTING)


@query
def city_filter_values(w):
    return marts.city_filter_values(w.table("fact_daily_metrics"), TEST_REPORTING)


@query
def charger_matrix(w):
    return marts.charger_matrix(w.table("fact_charger_performance"))


@query
def quadrant_medians(w):
    return marts.quadrant_medians(marts.charger_matrix(w.table("fact_charger_performance")))


@query
def top_chargers(w):
    return marts.top_chargers(w.table("fact_charger_performance"))


@query
def geo_performance(w):
    geo = marts.geo_performance(w.table("fact_daily_metrics"), w.table("dim_cities"))
    return geo.withColumn("avg_valid_transaction_pct", F.round("avg_valid_transaction_pct", 6))


@query
def dq_scorecard(w):
    return monitor.dq_scorecard(w.table("fact_transactions"))


@query
def dq_validity_split(w):
    return monitor.dq_validity_split(monitor.dq_scorecard(w.table("fact_transactions")))


@query
def dq_issue_breakdown(w):
    return monitor.dq_issue_breakdown(monitor.dq_scorecard(w.table("fact_transactions")))


def _trend(w) -> DataFrame:
    return monitor.dq_trend_daily(w.table("fact_transactions"), w.table("dim_dates"))


@query
def dq_trend_daily(w):
    return _trend(w)


@query
def dq_trend_weekly(w):
    return monitor.dq_trend_weekly(_trend(w))


@query
def dq_alert_thresholds(w):
    return monitor.dq_alert_thresholds(_trend(w)).withColumns(
        {"mean_pct": F.round("mean_pct", 6), "y_max": F.round("y_max", 6)}
    )


@query
def dq_alert_status(w):
    return monitor.dq_alert_status(monitor.dq_alert_thresholds(_trend(w))).withColumn(
        "mean_pct", F.round("mean_pct", 6)
    )


@query
def dq_trend_direction(w):
    return monitor.dq_trend_direction(_trend(w)).withColumns(
        {c: F.round(c, 6) for c in ("recent_pct", "earlier_pct")}
    )


# --- generators ----------------------------------------------------------------------------------------------------------


@query
def date_spine(w):
    """Every day of the reporting span, its end exclusive, with the sessions started on it."""
    sessions = w.table("stg_transactions")
    started = sessions.groupBy(F.to_date("start_time").alias("date_day")).agg(F.count(F.lit(1)).alias("sessions"))
    spine = dimensions.date_spine(w.spark, date(1995, 1, 1), date(2001, 8, 1))
    return spine.join(started, "date_day", "left").select("date_day", F.coalesce("sessions", F.lit(0)).alias("sessions"))


@query
def surrogate_key(w):
    return w.table("cur_chargers").select(
        "charger_id",
        dimensions.surrogate_key(F.col("city")).alias("city_key"),
        dimensions.surrogate_key(F.col("city"), F.col("latitude").isNull()).alias("pair_key"),
    )


# --- rules -----------------------------------------------------------------------------------------------------------------


@query
def dq_unique(w):
    """(order, line number) pairs that occur more than once."""
    lines = domain.read(w.spark, w.sf_dir, "lineitem")
    return rules.duplicated(lines, "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)")


@query
def dq_unique_composite(w):
    return rules.duplicated(w.table("fact_transactions"), "CAST(transaction_date AS STRING) || '|' || city_name")


@query
def dq_not_null(w):
    return rules.null_rows(
        w.table("fact_transactions"), ["session_id", "user_key", "charger_key", "end_time", "energy_kwh", "payment_id"]
    )


@query
def dq_accepted_values(w):
    return rules.not_accepted(w.table("cur_users"), "tier", TIERS).unionByName(
        rules.not_accepted(w.table("cur_transactions"), "payment_method", METHODS)
    )


@query
def dq_relationships(w):
    """Payers that are no known user."""
    return joins.orphans(w.table("cur_payments"), "user_id", w.table("cur_users"), "user_id")


@query
def dq_suite(w):
    names = {r.table for r in RULES} | {r.parent for r in RULES if r.parent}
    return rules.evaluate(RULES, {name: w.table(name) for name in sorted(names)})


# --- incremental -----------------------------------------------------------------------------------------------------------

_FEED = (
    "session_id string, user_id string, charger_id string, start_time timestamp_ntz, end_time timestamp_ntz, "
    "kwh_consumed decimal(10,4), payment_method string, status string, _loaded_at timestamp_ntz, "
    "transaction_month date"
)


@query
def incremental_merge(w):
    """Three loads into one table: all sessions, corrections of every 5th, late old copies of every 7th.

    Corrections close the session and may move it to another month; the late copies must not win.
    """
    base = w.table("stg_transactions").drop("_source_file")
    number = F.substr("session_id", F.lit(2)).cast("bigint")
    later = F.when(number % 25 == 0, F.col("start_time") + F.expr("INTERVAL '40' DAY")).otherwise(F.col("start_time"))
    corrected = base.where(number % 5 == 0).withColumns(
        {
            "status": F.lit("completed"),
            "start_time": later,
            "_loaded_at": F.col("_loaded_at") + F.expr("INTERVAL '1' DAY"),
        }
    )
    late = base.where(number % 7 == 0).withColumns(
        {"status": F.lit("stale"), "_loaded_at": F.col("_loaded_at") - F.expr("INTERVAL '1' DAY")}
    )
    source, progress = _work_folder(w, "feed"), _work_folder(w, "feed_progress")
    target = MergeTarget(_work_folder(w, "sessions"), _FEED)
    for part in (base, corrected, late):
        month = F.trunc(F.to_date("start_time"), "month")
        part.withColumn("transaction_month", month).write.mode("append").parquet(source)
        merge_new_files(w.spark, source, target, progress)
    return target.read(w.spark)


@query
def source_freshness(w):
    return monitoring.source_freshness(
        {
            table: (w.table(f"stg_{table}"), "_loaded_at")
            for table in ("users", "chargers", "transactions", "payments")
        },
        FRESHNESS_CLOCK,
    )


@query
def valid_pct_alerts(w):
    return monitoring.valid_pct_alerts(w.table("fact_daily_metrics"), PCT_THRESHOLD)


@query
def valid_pct_alerts_stream(w):
    """The same alerts from the sessions as they arrive, in three loads; the last is looked at twice."""
    source, log, progress = (_work_folder(w, f"alert_{part}") for part in ("feed", "log", "progress"))
    sessions = w.table("fact_transactions").select("transaction_date", "is_valid_transaction")
    dealt = sessions.withColumn("load", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(3)))
    for load in (0, 1, 2, None):
        if load is not None:
            dealt.where(F.col("load") == load).drop("load").write.mode("append").parquet(source)
        alert_on_new_sessions(
            w.spark, source, sessions.schema.simpleString()[7:-1].replace(":", " "), "transaction_date",
            "is_valid_transaction", PCT_THRESHOLD, log, progress,
        )
    return open_alerts(w.spark, log).withColumn("threshold_pct", F.lit(PCT_THRESHOLD))


@query
def distinct_by_grain(w):
    """Users and chargers met per week, per month and city, and in all, from one stored frame of sets per day and city."""
    fact = w.table("fact_transactions")
    counted = {"active_users": "user_key", "active_chargers": "charger_key"}

    def build() -> DataFrame:
        numbers = {kind: bitmaps.numbered_ids(fact, column) for kind, column in counted.items()}
        return bitmaps.id_sets(fact, ["transaction_date", "city_name"], counted, numbers)

    sets = w.store.table("day_city_sets", build)
    day, nothing = F.col("transaction_date"), F.lit(None)
    grains = {
        "week": (F.trunc(day, "week"), nothing.cast("string")),
        "month": (F.trunc(day, "month"), F.col("city_name")),
        "all": (nothing.cast("date"), nothing.cast("string")),
    }
    parts = []
    for grain, (period, city) in grains.items():
        placed = sets.select(F.lit(grain).alias("grain"), period.alias("period"), city.alias("city"), "kind", "bucket", "ids")
        parts.append(bitmaps.distinct_at(placed, ["grain", "period", "city"], list(counted)))
    return joins.union_all(parts)


@query
def refreshed_daily_metrics(w):
    """The daily fact as the catalog has it after a full refresh of all layers, the sides of the session join bucketed."""
    name = w.store.root.rsplit("/", 1)[-1]
    sources = {t: w.table(t) for t in STAGE} | {"date_spine": w.source("date_spine")}
    prefix = f"ampflow_{name}_"
    if not w.spark.catalog.tableExists(f"{prefix}semantic.fact_daily_metrics"):  # once per application and input state, as the layers are
        refresh(w.spark, sources, w.run, buckets=4, prefix=prefix, location=f"{w.store.root}/catalog")
    return w.spark.table(f"{prefix}semantic.fact_daily_metrics")
