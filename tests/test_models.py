"""Hand-made rows for the behaviours that the derived tables do not reach."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import values
from pyspark.sql import functions as F

from ampflow.config import ALL_CITIES, Reporting
from ampflow.plans import curated, dimensions, eda, facts, marts, monitor
from ampflow.sources import seeds

T0 = datetime(2025, 5, 1, 10, 0)
AUDIT = "_loaded_at timestamp_ntz, _source_file string"


def stage(spark, rows, schema):
    return spark.createDataFrame([(*r, T0, "f.json") for r in rows], f"{schema}, {AUDIT}")


def stg_transactions(spark, rows):
    """(session, user, charger, start, end, kwh, method, status)"""
    return stage(
        spark,
        [(s, u, c, a, b, None if k is None else Decimal(str(k)), m, st) for s, u, c, a, b, k, m, st in rows],
        "session_id string, user_id string, charger_id string, start_time timestamp_ntz, end_time timestamp_ntz, "
        "kwh_consumed decimal(10,4), payment_method string, status string",
    )


def stg_payments(spark, rows):
    return stage(
        spark,
        [(p, s, u, None if a is None else Decimal(str(a)), "CHF") for p, s, u, a in rows],
        "payment_id string, session_id string, user_id string, amount decimal(10,2), currency string",
    )


def stg_chargers(spark, rows):
    return stage(
        spark,
        rows,
        "charger_id string, city string, latitude double, longitude double, installed_at timestamp_ntz",
    )


@pytest.fixture(scope="module")
def layers(spark, run):
    """Eleven sessions around the corner cases, plus ordinary ones that keep the quartiles in place."""
    at = lambda day, hour, minute=0: datetime(2025, 5, day, hour, minute)
    rows = [
        ("s1", "u1", "c1", at(1, 10), at(1, 11), 10, "card", "completed"),
        ("s2", "u2", "c1", at(1, 10), at(1, 11), 11, "card", "completed"),  # no payment
        ("s3", "u1", "c2", at(1, 10), None, None, "RFID", "failed"),  # failed, no payment
        ("s4", "u3", "c9", at(1, 12), at(1, 13), 10, "RFID", "completed"),  # unknown charger
        ("s5", "u3", None, at(2, 12), at(2, 13), 10, "RFID", "completed"),  # no charger
        ("s6", "u1", "c2", at(2, 12), at(2, 11), 10, "app_wallet", "completed"),  # ends before start
        ("s7", "u1", "c3", at(2, 12), at(2, 13), 10, "app_wallet", "completed"),  # amount NULL, NULL city
        ("s8", "u1", "c1", at(2, 12), at(2, 13), 500, "app_wallet", "completed"),  # energy outlier
        ("s9", "u1", "c1", at(2, 12), at(2, 13), 10, "app_wallet", "completed"),  # amount outlier
        ("s10", "u1", "c1", None, at(2, 13), -4, "app_wallet", "completed"),  # no start, negative energy
        ("s11", "u1", "c1", at(2, 14), at(2, 15), 10, "card", "completed"),  # two payments
    ]
    rows += [(f"n{i}", f"u{i}", "c2", at(3, 10), at(3, 11), 9 + i % 4, "card", "completed") for i in range(12)]
    paid = [("p1", "s1", "u1", 10), ("p4", "s4", "u3", 10), ("p5", "s5", "u3", 0), ("p6", "s6", "u1", 9)]
    paid += [("p7", "s7", "u1", None), ("p8", "s8", "u1", 10), ("p9", "s9", "u1", 999), ("p10", "s10", "uX", 10)]
    paid += [("p11a", "s11", "u1", 10), ("p11b", "s11", "u1", 11)]
    paid += [(f"q{i}", f"n{i}", f"u{i}", 9 + i % 4) for i in range(12)]
    chargers = [
        ("c1", " zürich", 47.3, 8.5, datetime(2025, 5, 20)),
        ("c2", "Chur", 46.8, None, datetime(2020, 1, 1)),
        ("c3", None, 46.8, 9.5, None),
    ]
    run_ = run
    ct = curated.cur_transactions(stg_transactions(spark, rows), run_)
    cp = curated.cur_payments(stg_payments(spark, paid), run_)
    cc = curated.cur_chargers(stg_chargers(spark, chargers), seeds.city_map(spark), run_)
    fact = facts.fact_transactions(ct, cp, cc, run_).cache()
    yield {"ct": ct, "cp": cp, "cc": cc, "fact": fact, "n": len(rows)}
    fact.unpersist()


def of(layers, session, *columns):
    return [tuple(r) for r in layers["fact"].where(F.col("session_id") == session).select(*columns).collect()]


def test_rows_are_flagged_not_dropped(layers):
    assert layers["ct"].count() == layers["n"]
    assert layers["fact"].select("session_id").distinct().count() == layers["n"]


def test_missing_payment_only_counts_completed(layers):
    flags = ("is_missing_payment", "has_any_quality_issue", "is_valid_transaction")
    assert of(layers, "s2", *flags) == [(True, True, False)]
    assert of(layers, "s3", *flags) == [(False, True, False)]


def test_valid_and_issue_may_both_hold(layers):
    flags = ("has_any_quality_issue", "is_valid_transaction")
    assert of(layers, "s1", *flags) == [(False, True)]
    assert of(layers, "s7", *flags, "is_missing_payment_amount", "payment_amount_coalesced") == [
        (True, True, True, Decimal("0.00"))
    ]
    assert of(layers, "s8", *flags, "is_outlier_kwh") == [(True, True, True)]
    assert of(layers, "s9", *flags, "is_outlier_payment_amount") == [(True, False, True)]
    assert of(layers, "s5", *flags, "is_invalid_payment_amount") == [(True, False, True)]


def test_reversed_and_open_intervals(layers):
    columns = ("is_invalid_time_range", "duration_minutes", "duration_minutes_coalesced", "charging_rate_kw")
    assert of(layers, "s6", *columns) == [(True, None, 0, None)]
    assert of(layers, "s3", *columns) == [(False, None, 0, None)]
    assert of(layers, "s1", *columns) == [(False, 60, 60, 10.0)]


def test_two_payments_fan_out(layers):
    assert sorted(of(layers, "s11", "payment_id")) == [("p11a",), ("p11b",)]


def test_city_standardisation(layers):
    got = values(layers["cc"], "charger_id", "city", "city_original", "is_unmapped_city", "is_invalid_location")
    assert got == [
        ("c1", "Zurich", " zürich", False, False),
        ("c2", "Chur", "Chur", True, True),
        ("c3", None, None, True, False),
    ]


@pytest.fixture(scope="module")
def daily(layers, run):
    frame = facts.fact_daily_metrics(layers["fact"], run).cache()
    yield frame
    frame.unpersist()


def test_null_city_is_not_the_total(daily):
    rows = {r["city_name"]: r for r in daily.where("transaction_date = DATE '2025-05-01'").collect()}
    assert set(rows) == {"Zurich", "Chur", None, ALL_CITIES}
    assert rows[None]["total_transactions"] == 1
    assert rows[ALL_CITIES]["total_transactions"] == 4
    assert (rows[ALL_CITIES]["active_users"], rows[ALL_CITIES]["active_chargers"]) == (3, 3)
    assert (rows["Zurich"]["active_users"], rows["Chur"]["active_users"]) == (2, 1)


def test_sessions_without_start_have_no_day(daily):
    assert daily.where("transaction_date IS NULL").count() == 0


def test_additive_measures_add_up(daily):
    additive = [
        c
        for c, t in daily.dtypes
        if t.startswith(("bigint", "decimal")) and not c.startswith("active_") and c != "transaction_date_key"
    ]
    assert len(additive) >= 15
    parts = daily.where(F.coalesce(F.col("city_name") != ALL_CITIES, F.lit(True)))
    total = daily.where(F.col("city_name") == ALL_CITIES)
    sums = lambda df: values(df.groupBy("transaction_date").agg(*[F.sum(c).alias(c) for c in additive]))
    assert sums(parts) == sums(total)


def test_daily_averages_and_percentages(daily):
    row = daily.where((F.col("city_name") == ALL_CITIES) & (F.col("transaction_date") == date(2025, 5, 1))).first()
    assert (row["valid_transactions"], row["total_transactions"], row["valid_transaction_pct"]) == (2, 4, 50.0)
    assert (row["missing_payment_pct"], row["issue_transaction_pct"]) == (25.0, 50.0)
    assert row["avg_revenue_per_transaction"] == 10.0
    assert (row["card_transactions"], row["rfid_transactions"]) == (2, 2)


def test_charger_performance(layers, run):
    lifetime = facts.charger_lifetime(layers["fact"], run)
    full = facts.fact_charger_performance(lifetime, dimensions.dim_chargers(layers["cc"], run))
    rows = {r["charger_key"]: r for r in full.collect()}
    assert set(rows) == {"c1", "c2", "c3", "c9", None}
    c2 = rows["c2"]
    assert (c2["total_transactions"], c2["days_with_transactions"], c2["active_days_span"]) == (14, 3, 3)
    assert c2["utilization_pct"] == 100.0
    assert c2["avg_transactions_per_day"] == pytest.approx(14 / 3)
    assert (c2["charger_city"], c2["charger_data_quality_status"]) == ("Chur", "Invalid Location & Unmapped City")
    assert rows["c9"]["charger_city"] is None
    assert {r["performance_classification"] for r in rows.values()} <= {
        "Star Performer",
        "High Performer",
        "Underperformer",
        "High Volume / Low Value",
        "Low Volume / High Value",
    }


def test_dimension_bands_with_null_dates(layers, spark, run):
    chargers = {r["charger_id"]: r for r in dimensions.dim_chargers(layers["cc"], run).collect()}
    assert chargers["c1"]["charger_age_band"] == "New (< 90 days)"
    assert chargers["c1"]["charger_age_days"] == 12
    assert chargers["c3"]["charger_age_band"] == "Mature (2+ years)"
    assert chargers["c3"]["installed_date_key"] is None
    users = stage(
        spark,
        [("u1", "A", "a@b.ch", "guest", None), ("u2", "B", "b@b.ch", "gold", datetime(2025, 5, 31, 23, 59))],
        "user_id string, name string, email string, tier string, created_at timestamp_ntz",
    )
    got = values(
        dimensions.dim_users(curated.cur_users(users, run), run),
        "user_id", "user_tenure_band", "user_tenure_days", "user_tier_display", "user_tier_sort_order",
    )
    assert got == [("u1", "Veteran (1+ year)", None, "Basic", 2), ("u2", "New (< 30 days)", 1, "Unknown", 99)]


def test_cities(layers, spark, run):
    rows = {r["city_name"]: r for r in dimensions.dim_cities(layers["cc"], seeds.city_map(spark), run).collect()}
    assert rows["Zurich"]["city_name_variants"] == "Zuerich, Zurich, Zürich"
    assert rows["Chur"]["city_name_variants"] == "Chur" and rows["Chur"]["is_unmapped_city"]
    assert rows["Zurich"]["market_size_tier"] == "Emerging Market"
    assert rows["Chur"]["city_center_longitude"] is None
    assert len({r["city_key"] for r in rows.values()}) == 3


def test_surrogate_key_of_null_and_several_columns(spark):
    import hashlib

    df = spark.createDataFrame([("a", None)], "x string, y int")
    row = df.select(
        dimensions.surrogate_key(F.col("x")).alias("one"), dimensions.surrogate_key(F.col("x"), F.col("y")).alias("two")
    ).first()
    assert row["one"] == hashlib.md5(b"a").hexdigest()
    assert row["two"] == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()


def test_default_calendar(spark, run):
    spine = dimensions.date_spine(spark)
    assert spine.count() == 4017
    assert dimensions.date_spine(spark, date(2025, 1, 1), date(2025, 1, 1)).count() == 0
    days = {r["date_actual"]: r for r in dimensions.dim_dates(spine, run).collect()}
    assert max(days) == date(2030, 12, 30)
    d = days[date(2025, 6, 1)]
    assert (d["day_of_week"], d["day_name"], d["day_name_full"], d["is_weekend"]) == (0, "Sun", "Sunday", True)
    assert (d["week_start_date"], d["week_end_date"]) == (date(2025, 5, 26), date(2025, 6, 1))
    assert (d["quarter_name"], d["quarter_start_date"], d["quarter_end_date"]) == ("Q2", date(2025, 4, 1), date(2025, 6, 30))
    assert d["is_today"] and d["is_current_week"] and not d["is_last_7_days"]
    assert days[date(2025, 5, 25)]["is_last_7_days"] and not days[date(2025, 5, 24)]["is_last_7_days"]
    assert sum(r["is_last_90_days"] for r in days.values()) == 90
    assert days[date(2025, 5, 31)]["is_previous_month"] and days[date(2025, 2, 1)]["is_previous_quarter"]
    assert days[date(2027, 1, 1)]["week_of_year"] == 53
    assert (d["month_name"], d["month_name_full"], d["month_end_date"]) == ("Jun", "June", date(2025, 6, 30))


# --- dashboard and monitor --------------------------------------------------------------------------------------

WHEN = Reporting(date(2025, 5, 31))


def kpis_of(spark, rows):
    schema = (
        "transaction_date date, city_name string, transaction_date_key int, valid_revenue decimal(20,2), "
        "valid_energy_kwh decimal(20,4), active_chargers bigint, active_users bigint, valid_transactions bigint"
    )
    daily = spark.createDataFrame(
        [(d, c, d.year * 10000 + d.month * 100 + d.day, Decimal(r), Decimal(r), n, n, n) for d, c, r, n in rows], schema
    )
    dates = daily.select(F.col("transaction_date_key").alias("date_key"), F.col("transaction_date").alias("date_actual"))
    return marts.kpi_month_over_month(daily, dates.distinct(), WHEN)


def test_reporting_windows():
    assert WHEN.current_start == date(2025, 5, 1)
    assert (WHEN.previous_start, WHEN.previous_end) == (date(2025, 4, 1), date(2025, 4, 30))
    assert WHEN.trend_start == date(2025, 3, 3)


def test_kpi_takes_the_best_day_as_active(spark):
    rows = [
        (date(2025, 5, 1), ALL_CITIES, 100, 4),
        (date(2025, 5, 2), ALL_CITIES, 50, 6),
        (date(2025, 5, 2), "Bern", 50, 6),
        (date(2025, 4, 30), ALL_CITIES, 100, 5),
        (date(2025, 3, 31), ALL_CITIES, 900, 9),
    ]
    got = kpis_of(spark, rows)
    assert [(r["period"], r["active_users"], r["total_transactions"]) for r in got.collect()] == [
        ("Previous Month", 5, 5),
        ("Current Month", 6, 10),
    ]
    change = {r["kpi"]: r["pct_change"] for r in marts.kpi_pct_change(got).collect()}
    assert change["Total Revenue"] == pytest.approx(50.0)
    assert change["Active Users"] == pytest.approx(20.0)


def test_kpi_without_previous_period(spark):
    change = marts.kpi_pct_change(kpis_of(spark, [(date(2025, 5, 1), ALL_CITIES, 100, 4)])).collect()
    assert [r["pct_change"] for r in change] == [0.0] * 6
    assert change[0]["previous_value"] == 0.0


@pytest.mark.parametrize(
    "shares,expected",
    [
        ([10.0] * 5, "Stable"),
        ([1.0, 9.0], "Stable"),
        ([30.0] * 50 + [5.0] * 50, "Improving"),
        ([30.0] * 10 + [5.0] * 83 + [9.0] * 7, "Degrading"),
    ],
)
def test_trend_direction(spark, shares, expected):
    """The window is 90 daily rows; with fewer than 14 the two ends overlap."""
    rows = [(date(2025, 1, 1).fromordinal(date(2025, 1, 1).toordinal() + i), s) for i, s in enumerate(shares)]
    df = spark.createDataFrame(rows, "transaction_date date, transactions_with_issues_pct double")
    assert monitor.dq_trend_direction(df).first()["trend_direction"] == expected


def test_thresholds_and_status(spark):
    columns = list(monitor.ISSUE_TYPES.values())
    rows = [(0.0, 4.0, *[0.1] * 7), (10.0, 4.0, *[0.1] * 7)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    got = {r["issue_type"]: r for r in monitor.dq_alert_thresholds(df).collect()}
    assert got["All Issues"]["threshold"] == 15.6
    assert got["All Issues"]["y_max"] == pytest.approx(15.6 * 1.3)
    assert (got["Missing kWh"]["threshold"], got["Missing kWh"]["y_max"]) == (2.0, 5.0)
    status = values(monitor.dq_alert_status(monitor.dq_alert_thresholds(df)), "issue_type", "status")
    assert status == [("Missing Amount", "warn")]


def test_scorecard_splits_total_by_validity(layers):
    card = monitor.dq_scorecard(layers["fact"])
    split = {r["category"]: r["row_count"] for r in monitor.dq_validity_split(card).collect()}
    row = card.first()
    assert sum(split.values()) == row["total_transactions"]
    assert split["Valid Transactions"] == row["valid_transactions"]
    assert row["transactions_with_issues"] == split["Transactions with Issues"]
    assert [r["row_count"] for r in monitor.dq_issue_breakdown(card).collect()] == sorted(
        r["row_count"] for r in monitor.dq_issue_breakdown(card).collect()
    )


def test_exploration_ignores_missing_payments(spark, run):
    day = datetime(2025, 5, 1, 10)
    sessions = stg_transactions(
        spark,
        [(f"s{i}", "u1", "c1", day, datetime(2025, 5, 1, 11), 10, "card", "completed") for i in range(5)]
        + [("z", "u1", "c1", day, datetime(2025, 5, 1, 11), 0, "card", "completed")],
    )
    paid = stg_payments(spark, [("p0", "s0", "u1", 10), ("p1", "s1", "u2", 10), ("p2", "s2", "u1", -3), ("pz", "z", "u1", 5)])
    chargers = stg_chargers(spark, [("c1", "Zuerich", 47.3, 8.5, day)])
    users = spark.createDataFrame([("u1", "guest")], "user_id string, tier string")
    clean = eda.clean_transactions(sessions)
    joined = eda.joined_frame(clean, users, eda.clean_chargers(chargers, run.box), eda.clean_payments(paid))
    rows = {r["session_id"]: r for r in eda.master_frame(joined).collect()}
    assert len(rows) == 6
    assert rows["s3"]["has_issues"] is False and rows["s3"]["is_invalid_amount"] is None
    assert rows["s2"]["has_issues"] is True
    assert rows["z"]["cost_per_kwh"] is None
    assert rows["s0"]["city"] == "Zurich" and rows["s0"]["charging_time"] == 1.0
    assert values(eda.user_id_mismatch(sessions, paid)) == [("s1", "u1", "p1", "u2")]
