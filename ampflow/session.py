"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "ampflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans are written for.

    Adaptive execution splits skewed join partitions even when a later aggregation could have reused the
    join's partitioning, because one hot charger or session must not become one task.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
    } | conf
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster that folder would be invisible to
    the other machines, so a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="ampflow-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that values assigned once are never assigned again differently."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def local_table(spark: SparkSession, columns: dict[str, Sequence]) -> DataFrame:
    """A few rows of driver data as a local relation, whose exact size lets Catalyst decide on a broadcast."""
    return spark.createDataFrame(pa.table({name: list(values) for name, values in columns.items()}))
