"""Times the headline queries and prints one JSON line.

``layers`` is the full build of stage, curated and semantic tables from the source files; every other entry is one
query over those tables, run to completion without collecting rows. Everything runs twice; ``queries`` holds the
second run and ``first_run`` the first, which includes class loading and code generation. BENCH_SF_DIR, BENCH_CPUS
and BENCH_QUERIES (comma-separated names, or ``all``) choose input, cores and queries.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ampflow.catalog import QUERIES  # noqa: E402
from ampflow.plans.warehouse import Warehouse  # noqa: E402
from ampflow.session import build_session  # noqa: E402

HEADLINE = (
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
    "iqr_bounds",
    "charger_quartiles",
    "nearest_city",
    "master_frame",
    "kpi_month_over_month",
    "revenue_trend",
    "charger_matrix",
    "geo_performance",
    "dq_scorecard",
    "dq_trend_daily",
    "dq_trend_weekly",
    "dq_alert_thresholds",
    "dq_trend_direction",
    "describe",
    "profile_table",
    "histogram",
    "issue_crosstab",
    "dq_unique",
    "dq_relationships",
    "dq_suite",
    "incremental_merge",
)


# Small inputs on one machine: keep all cores busy although a whole table fits in one default-sized split.
LOCAL_SETTINGS = {
    "spark.driver.memory": "16g",
    "spark.sql.files.openCostInBytes": "65536",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def build_layers(spark, sf_dir: str, label: str) -> float:
    """Seconds to write all layer tables into a store of their own."""
    warehouse = Warehouse(spark, sf_dir)
    warehouse.store.root += label
    start = time.perf_counter()
    warehouse.build_all()
    return time.perf_counter() - start


def run_query(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)
    spark = build_session(
        "ampflow-bench", f"local[{cpus}]", **LOCAL_SETTINGS, **{"spark.sql.shuffle.partitions": cpus}
    )
    spark.sparkContext.setLogLevel("OFF")

    cold = {"layers": build_layers(spark, sf_dir, "")}
    warm = {"layers": build_layers(spark, sf_dir, "-again")}
    for name in names:
        cold[name] = run_query(spark, sf_dir, name)
        warm[name] = run_query(spark, sf_dir, name)
    scale = Path(sf_dir).name.removeprefix("sf")
    result = {
        "metric": "wall time of layer build and headline queries, second run in one session",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in warm.items()},
        "first_run": {k: round(v, 3) for k, v in cold.items()},
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
        "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
