"""Incremental file landing: each file is loaded once, bad records are set aside instead of failing the load."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampflow.sources import records
from ampflow.sources.raw import CORRUPT


@dataclass(frozen=True)
class Landing:
    """Where one kind of record arrives and where it is kept. All folders are shared by the executors.

    Files hold one record per line, or with ``outer_array`` one array of records each.
    """

    source: str
    schema: str
    target: str
    checkpoint: str
    outer_array: bool = False
    files_per_batch: int | None = None


def load_new_files(spark: SparkSession, landing: Landing, loaded_at: Column) -> None:
    """Load all files not loaded before, then stop. Re-running without new files adds no rows.

    A large backlog is taken in batches of ``files_per_batch``, each committed on its own.
    """
    reader = spark.readStream
    if landing.files_per_batch:
        reader = reader.option("maxFilesPerTrigger", landing.files_per_batch)
    arriving = records.read_records(reader, landing.source, landing.outer_array)
    query = (
        records.typed(arriving, landing.schema, CORRUPT)
        .withColumn("_loaded_at", loaded_at)
        .writeStream.format("parquet")
        .option("path", landing.target)
        .option("checkpointLocation", landing.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _landed(spark: SparkSession, landing: Landing) -> DataFrame:
    return spark.read.parquet(landing.target)


def loaded(spark: SparkSession, landing: Landing) -> DataFrame:
    """Rows that parsed."""
    return _landed(spark, landing).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantined(spark: SparkSession, landing: Landing) -> DataFrame:
    """Records that did not, with their file."""
    return (
        _landed(spark, landing)
        .where(F.col(CORRUPT).isNotNull())
        .select(F.col(CORRUPT).alias("bad_line"), "_loaded_at", "_source_file")
    )
