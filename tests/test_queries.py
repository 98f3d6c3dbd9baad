"""Every registered query against its statement, and the shape of the important plans."""

from __future__ import annotations

import re
import sys
from pathlib import Path

import pytest
from conftest import SMALL, plan_of, values

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from check_oracle import compare, connect  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from ampflow.catalog import QUERIES  # noqa: E402
from ampflow.plans.warehouse import Warehouse  # noqa: E402
from oracle.statements import STATEMENTS  # noqa: E402

# Values of the derived tables at scale factor 0.001.
EXPECTED_FLAGS = {
    "is_invalid_time_range": 42,
    "is_missing_kwh": 48,
    "is_negative_kwh": 41,
    "is_outlier_kwh": 31,
    "is_outlier_duration": 41,
    "is_missing_payment": 61,
    "is_missing_payment_amount": 22,
    "is_invalid_payment_amount": 54,
    "is_outlier_payment_amount": 20,
    "has_any_quality_issue": 502,
    "is_valid_transaction": 1081,
}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)
    assert set(QUERIES) <= set(queries()) and set(STATEMENTS) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_statement(spark, duck, name):
    df = queries()[name](spark, SMALL)
    result = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert compare(df.columns, [tuple(r) for r in df.collect()], columns, result.fetchall()) is None


def test_entry(spark):
    assert entry(spark).count() == 2497


def test_flag_counts(spark):
    fact = Warehouse(spark, SMALL).table("fact_transactions")
    assert {c: fact.where(c).count() for c in EXPECTED_FLAGS} == EXPECTED_FLAGS
    assert fact.where("is_valid_transaction AND has_any_quality_issue").count() == 83
    assert fact.where("city_name IS NULL").count() == 27


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_and_no_cross_join_in_plans(spark, name):
    plan = plan_of(queries()[name](spark, SMALL))
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_bounds_are_a_scalar_subquery(spark):
    plan = plan_of(queries()["cur_transactions"](spark, SMALL))
    main = plan.split("FileScan")[-1]
    assert "Subquery" in plan and "session_id" in main
    assert "percentile" not in plan


def test_daily_metrics_scan_only_their_columns(spark):
    plan = plan_of(queries()["fact_daily_metrics"](spark, SMALL))
    scans = [set(re.sub(r"#\d+L?", "", s).split(",")) for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]
    assert all(not scan & {"session_id", "revenue_per_kwh", "start_time"} for scan in scans)
    assert {"user_key", "charger_key", "city_name", "transaction_date"} in scans


def test_filters_reach_the_scan(spark):
    plan = plan_of(queries()["revenue_trend"](spark, SMALL))
    assert "GreaterThanOrEqual(transaction_date" in plan


def test_ranking_needs_no_single_partition(spark):
    plan = plan_of(queries()["charger_quartiles"](spark, SMALL))
    assert "ntile" not in plan


def test_charger_performance_writes_no_wide_table(spark):
    """Of the session fact only what the charger measures read is worked out and written, unless the fact is there."""
    apart, whole = Warehouse(spark, SMALL), Warehouse(spark, SMALL)
    apart.store.root += "-charger-sessions"
    whole.store.root += "-whole-fact"
    narrow = apart.model("fact_charger_performance")
    assert not any(apart.store.has(t) for t in ("cur_transactions", "cur_payments", "fact_transactions"))
    assert apart.store.has("charger_sessions") and len(apart.table("charger_sessions").columns) == 12
    for table in ("cur_transactions", "cur_payments", "fact_transactions"):
        whole.table(table)
    from_fact = whole.model("fact_charger_performance")
    assert not whole.store.has("charger_sessions")
    assert values(narrow) == values(from_fact, *narrow.columns)
