"""Stage layer: VARIANT records to typed columns, one row per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampflow.config import Run
from ampflow.functions.parsing import json_field, safe_decimal, safe_timestamp


def _text(*names: str) -> list[Column]:
    return [json_field("raw_data", f"$.{name}").alias(name) for name in names]


def _time(name: str) -> Column:
    return safe_timestamp(json_field("raw_data", f"$.{name}")).alias(name)


def _parsed(raw: DataFrame, run: Run, *columns: Column) -> DataFrame:
    return raw.select(*columns, "_loaded_at", "_source_file", run.stamp().alias("_dbt_updated_at"))


def stg_users(raw: DataFrame, run: Run) -> DataFrame:
    return _parsed(raw, run, *_text("user_id", "name", "email", "tier"), _time("created_at"))


def stg_chargers(raw: DataFrame, run: Run) -> DataFrame:
    return _parsed(
        raw,
        run,
        *_text("charger_id", "city"),
        json_field("raw_data", "$.location.lat", "double").alias("latitude"),
        json_field("raw_data", "$.location.lon", "double").alias("longitude"),
        _time("installed_at"),
    )


def stg_transactions(raw: DataFrame, run: Run) -> DataFrame:
    return _parsed(
        raw,
        run,
        *_text("session_id", "user_id", "charger_id"),
        _time("start_time"),
        _time("end_time"),
        safe_decimal(json_field("raw_data", "$.kWh_consumed"), 10, 4).alias("kwh_consumed"),
        *_text("payment_method", "status"),
    )


def stg_payments(raw: DataFrame, run: Run) -> DataFrame:
    return _parsed(
        raw,
        run,
        *_text("payment_id", "session_id", "user_id"),
        safe_decimal(json_field("raw_data", "$.amount"), 10, 2).alias("amount"),
        *_text("currency"),
    )


# Stage table back to the record it is parsed from; used to exercise the landing path on derived data.
RAW_RECORDS = {
    "users": ["user_id", "name", "email", "tier", "created_at"],
    "chargers": [
        "charger_id",
        "city",
        "named_struct('lat', latitude, 'lon', longitude) AS location",
        "installed_at",
    ],
    "transactions": [
        "session_id",
        "user_id",
        "charger_id",
        "start_time",
        "end_time",
        "kwh_consumed AS kWh_consumed",
        "payment_method",
        "status",
    ],
    "payments": ["payment_id", "session_id", "user_id", "amount", "currency"],
}


def as_json(table: str) -> Column:
    return F.to_json(F.struct(*[F.expr(c) for c in RAW_RECORDS[table]]), {"ignoreNullFields": "false"})


def as_variant(stage: DataFrame, table: str) -> DataFrame:
    return stage.select(F.parse_json(as_json(table)).alias("raw_data"), "_loaded_at", "_source_file")
