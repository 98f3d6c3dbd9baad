"""Freshness of sources and alerts on the daily fact."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampflow.config import ALL_CITIES
from ampflow.functions.calendar import minutes_between
from ampflow.operators.joins import union_all


def source_freshness(
    sources: Mapping[str, tuple[DataFrame, str]], now: datetime, warn_hours: int = 24, error_hours: int = 48
) -> DataFrame:
    """Age of the newest record per source and its status; a source without records is an error.

    ``sources`` maps a name to (table, load-time column).
    """
    clock = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    newest = [
        df.agg(F.lit(name).alias("source_name"), F.max(column).alias("max_loaded_at"))
        for name, (df, column) in sources.items()
    ]
    age = minutes_between(F.col("max_loaded_at"), clock)
    status = (
        F.when(age.isNull() | (age > error_hours * 60), "error").when(age > warn_hours * 60, "warn").otherwise("pass")
    )
    return union_all(newest).select("source_name", "max_loaded_at", age.alias("age_minutes"), status.alias("status"))


def valid_pct_alerts(daily: DataFrame, threshold: float) -> DataFrame:
    """Network-wide days whose share of valid sessions falls below ``threshold`` percent."""
    return daily.where(
        (F.col("city_name") == ALL_CITIES) & (F.col("valid_transaction_pct") < threshold)
    ).select(
        "transaction_date",
        "total_transactions",
        "valid_transactions",
        "valid_transaction_pct",
        F.lit(float(threshold)).alias("threshold_pct"),
    )
