"""The layers as tables: bronze (stg), silver (cur), gold (dim, fact)."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from ampflow.config import Reporting, Run
from ampflow.plans import curated, dimensions, facts
from ampflow.sources import domain, seeds
from ampflow.sources.tables import TableStore, ensure_database, input_state, save_table

# The derived sessions run from 1995-01-01 to 2001-08-01; "today" is the day after the last full month.
TEST_RUN = Run(as_of=date(2001, 8, 1), run_ts=datetime(2001, 8, 1))
TEST_REPORTING = Reporting(data_end=date(2001, 7, 31))

Source = Callable[[str], DataFrame]

# Layer, table and the tables it reads. Order is build order.
LAYERS: dict[str, str] = {
    "cur_users": "curated",
    "cur_chargers": "curated",
    "cur_payments": "curated",
    "cur_transactions": "curated",
    "dim_dates": "semantic",
    "dim_users": "semantic",
    "dim_chargers": "semantic",
    "dim_cities": "semantic",
    "fact_transactions": "semantic",
    "fact_daily_metrics": "semantic",
    "fact_charger_performance": "semantic",
}


STAGE = ("stg_users", "stg_chargers", "stg_transactions", "stg_payments")
# Tables that do not read each other, in build order; those of a group are built at the same time.
GROUPS = (
    STAGE,
    ("cur_transactions", "cur_payments", "cur_chargers", "cur_users"),
    ("fact_transactions", "dim_dates", "dim_users", "dim_chargers", "dim_cities"),
    ("fact_daily_metrics", "fact_charger_performance"),
)
BUILDERS = 4


def build_groups(build: Callable[[str], object]) -> None:
    """Calls ``build`` for every table, ``BUILDERS`` at a time within a group."""
    with ThreadPoolExecutor(BUILDERS) as pool:
        for group in GROUPS:
            list(pool.map(build, group))


def model(name: str, table: Source, run: Run, bounds: DataFrame | None = None) -> DataFrame:
    """The DataFrame of one model over the tables ``table`` returns; ``bounds`` replaces fresh outlier bounds."""
    match name:
        case "cur_users":
            return curated.cur_users(table("stg_users"), run)
        case "cur_chargers":
            return curated.cur_chargers(table("stg_chargers"), table("city_name_mapping"), run)
        case "cur_payments":
            return curated.cur_payments(table("stg_payments"), run, bounds)
        case "cur_transactions":
            return curated.cur_transactions(table("stg_transactions"), run, bounds)
        case "dim_dates":
            return dimensions.dim_dates(table("date_spine"), run)
        case "dim_users":
            return dimensions.dim_users(table("cur_users"), run)
        case "dim_chargers":
            return dimensions.dim_chargers(table("cur_chargers"), run)
        case "dim_cities":
            return dimensions.dim_cities(table("cur_chargers"), table("city_name_mapping"), run)
        case "fact_transactions":
            return facts.fact_transactions(
                table("cur_transactions"), table("cur_payments"), table("cur_chargers"), run
            )
        case "fact_daily_metrics":
            return facts.fact_daily_metrics(table("fact_transactions"), run)
        case "fact_charger_performance":
            lifetime = facts.charger_lifetime(table("fact_transactions"), run)
            return facts.fact_charger_performance(lifetime, table("dim_chargers"))
    raise KeyError(name)


def refresh(
    spark: SparkSession,
    stage: dict[str, DataFrame],
    run: Run,
    buckets: int = 0,
    partition_facts: bool = False,
    prefix: str = "",
    location: str | None = None,
) -> dict[str, DataFrame]:
    """Full refresh of every layer as catalog tables (databases stg, curated, semantic).

    The databases' names may have a ``prefix``, and they may lie under a ``location`` of their own.

    ``stage`` holds the four stage tables and optionally ``city_name_mapping`` and ``date_spine``. With ``buckets``
    the two sides of the session join are bucketed by ``session_id``; with ``partition_facts`` the facts with a date
    are partitioned by it. The outlier bounds of the run are kept as ``curated.*_bounds``.
    """
    tables = {"city_name_mapping": seeds.city_map(spark), "date_spine": dimensions.date_spine(spark)} | stage
    measured = {
        "cur_payments": ("payment_bounds", curated.payment_bounds, "stg_payments"),
        "cur_transactions": ("transaction_bounds", curated.transaction_bounds, "stg_transactions"),
    }

    def build(name: str) -> None:
        if name in STAGE:
            tables[name] = save_table(tables[name], f"{prefix}stg", name)
            return
        bounds = None
        if name in measured:
            kept, of, source = measured[name]
            bounds = save_table(of(tables[source]).withColumn("_run_ts", run.stamp()), f"{prefix}curated", kept)
        bucketed = buckets if name in ("cur_transactions", "cur_payments") else 0
        dated = partition_facts and name in ("fact_transactions", "fact_daily_metrics")
        tables[name] = save_table(
            model(name, tables.__getitem__, run, bounds),
            f"{prefix}{LAYERS[name]}",
            name,
            partition_by=["transaction_date"] if dated else (),
            bucket_by="session_id" if bucketed else None,
            buckets=bucketed,
        )

    for database in ("stg", "curated", "semantic"):
        ensure_database(spark, f"{prefix}{database}", location)
    tables["city_name_mapping"] = save_table(tables["city_name_mapping"], f"{prefix}stg", "city_name_mapping")
    build_groups(build)
    return tables


class Warehouse:
    """The layers over one folder of test tables. A table is written on first use and then read as parquet."""

    def __init__(self, spark: SparkSession, sf_dir: str, run: Run = TEST_RUN):
        self.spark, self.sf_dir, self.run = spark, sf_dir, run
        inputs = [f"{sf_dir}/{t}.parquet" for t in ("orders", "lineitem", "customer", "supplier")]
        self.store = TableStore(spark, input_state(spark, inputs))

    def source(self, name: str) -> DataFrame:
        """Unwritten inputs of the layers."""
        match name:
            case "stg_users":
                return domain.users(self.spark, self.sf_dir)
            case "stg_chargers":
                return domain.chargers(self.spark, self.sf_dir)
            case "stg_transactions":
                return domain.transactions(self.spark, self.sf_dir)
            case "stg_payments":
                return domain.payments(self.spark, self.sf_dir)
            case "date_spine":
                return dimensions.spine_of(self.table("stg_transactions"), "start_time")
        return self.model(name)

    def build_all(self) -> None:
        """Writes every layer table, independent ones at the same time."""
        build_groups(self.table)

    def model(self, name: str) -> DataFrame:
        """The model's own plan over its input tables; some that it reads in part need not be written."""
        inputs = {
            "fact_transactions": {t: lambda t=t: self.planned(t) for t in ("cur_transactions", "cur_payments")},
            "fact_charger_performance": {"fact_transactions": self.charger_sessions},
        }.get(name, {})
        return model(name, lambda t: inputs[t]() if t in inputs else self.table(t), self.run)

    def planned(self, name: str) -> DataFrame:
        """The table if it is written, else its plan, for a reader that needs it once and not all of its columns."""
        return self.table(name) if self.store.has(name) else self.model(name)

    def charger_sessions(self) -> DataFrame:
        """The session fact for the charger measures, which read a third of its columns twice.

        Unless the whole fact is written already, these columns alone are worked out and written.
        """
        if self.store.has("fact_transactions"):
            return self.table("fact_transactions")
        return self.store.table(
            "charger_sessions", lambda: self.model("fact_transactions").select(*facts.LIFETIME_COLUMNS)
        )

    def table(self, name: str) -> DataFrame:
        if name == "city_name_mapping":
            return seeds.city_map(self.spark)
        return self.store.table(name, lambda: self.source(name))
