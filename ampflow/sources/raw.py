"""JSON files and VARIANT landing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampflow.operators.joins import union_all
from ampflow.sources import records

CORRUPT = "_corrupt_record"

# Shapes of the raw records.
RAW_SCHEMAS = {
    "users": "user_id string, name string, email string, tier string, created_at string",
    "chargers": "charger_id string, city string, location struct<lat double, lon double>, installed_at string",
    "transactions": (
        "session_id string, user_id string, charger_id string, start_time string, end_time string, "
        "kWh_consumed string, payment_method string, status string"
    ),
    "payments": "payment_id string, session_id string, user_id string, amount string, currency string",
}


def scan_json(spark: SparkSession, path: str, schema: str, outer_array: bool = False) -> DataFrame:
    """Typed JSON scan. Bad records are NULL in all columns but ``_corrupt_record``, which holds their text.

    Lines and arrays split into many tasks; a compressed array file is split into its records by a single task. Compression
    follows the file suffix.
    """
    return records.typed(records.read_records(spark.read, path, outer_array).drop("_source_file"), schema, CORRUPT)


def land_variant(spark: SparkSession, path: str, loaded_at: Column, outer_array: bool = False) -> DataFrame:
    """Records as one VARIANT column plus load time and file name; bad ones have their text in ``_bad_line``."""
    return records.read_records(spark.read, path, outer_array).select(
        records.parsed().alias("raw_data"),
        records.bad_text().alias("_bad_line"),
        loaded_at.alias("_loaded_at"),
        "_source_file",
    )


def land_variant_array(spark: SparkSession, path: str, loaded_at: Column) -> DataFrame:
    """As :func:`land_variant` for files that hold one outer array each."""
    return land_variant(spark, path, loaded_at, outer_array=True)


def good_and_bad(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Landed records to go on with, and those to keep in a quarantine table."""
    good = landed.where(F.col("raw_data").isNotNull()).drop("_bad_line")
    return good, landed.where(F.col("raw_data").isNull()).select("_bad_line", "_loaded_at", "_source_file")


def flatten_location(df: DataFrame) -> DataFrame:
    """Nested ``location`` as the columns latitude and longitude."""
    return df.select(
        *[c for c in df.columns if c != "location"],
        F.col("location.lat").alias("latitude"),
        F.col("location.lon").alias("longitude"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, for load verification."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return union_all(counts)
