"""Charging-domain stage tables derived from the star-schema test tables.

The test tables carry almost no dirt, so orders become sessions and payments, suppliers become chargers and
customers become users, with fixed shares of bad values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The newest load instant by source; a record with a higher key came up to 2,000 minutes earlier.
LOADED_AT = {
    "users.json": "2001-08-01 00:00:00",
    "chargers.json": "2001-07-30 18:00:00",
    "transactions.json": "2001-08-01 20:00:00",
    "payments.json": "2001-08-01 00:00:00",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _code(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), 8, "0"))


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def _audit(file_name: str, key: str) -> list[Column]:
    earlier = (F.col(key) % 2000).cast("int") * F.expr("INTERVAL '1' MINUTE")
    return [
        (F.lit(LOADED_AT[file_name]).cast("timestamp_ntz") - earlier).alias("_loaded_at"),
        F.lit(file_name).alias("_source_file"),
    ]


def _day_offset(days: Column) -> Column:
    return F.date_add(F.lit("1995-01-01").cast("date"), days.cast("int")).cast("timestamp_ntz")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    tier = (
        F.when(segment.isin("BUILDING", "MACHINERY"), "subscriber")
        .when(segment == "FURNITURE", "trial")
        .otherwise("guest")
    )
    domain = F.when(_every("c_custkey", 211), "").otherwise("@example.ch")
    return read(spark, sf_dir, "customer").select(
        _code("U", F.col("c_custkey")).alias("user_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), domain).alias("email"),
        tier.alias("tier"),
        _day_offset(F.col("c_custkey") % 2400).alias("created_at"),
        *_audit("users.json", "c_custkey"),
    )


CITY_SPELLINGS = (
    "Zuerich", "Zürich", " ZURICH ", "Sankt Gallen", "St Gallen", "Basel",
    "Genève", "Luzern", "Lugano", "Chur", "Bern", "Lausanne",
)  # fixed values, indexed by the supplier key modulo 12


def chargers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    step = (key % 100).cast("double")
    missing = key % 7 == 3
    spelling = F.element_at(F.array(*[F.lit(c) for c in CITY_SPELLINGS]), (key % 12 + 1).cast("int"))
    latitude = F.when(missing, None).when(key % 9 == 4, 52.5).otherwise(46 + step / 64)
    return read(spark, sf_dir, "supplier").select(
        _code("C", key).alias("charger_id"),
        spelling.alias("city"),
        latitude.alias("latitude"),
        F.when(~missing, 6 + step / 32).alias("longitude"),
        _day_offset((key * 37) % 2000).alias("installed_at"),
        *_audit("chargers.json", "s_suppkey"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per order; charger and quantity come from the order's first line.

    The first line is a minimum per order, which combines on the map side, so an order with very many lines does
    not gather them in one task.
    """
    first_line = (
        read(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.min(
                F.struct(
                    "l_linenumber",
                    "l_suppkey",
                    "l_partkey",
                    "l_extendedprice",
                    F.col("l_quantity").cast("double").alias("l_quantity"),
                )
            ).alias("line")
        )
        .select("o_orderkey", "line.l_suppkey", "line.l_quantity")
    )
    minute = F.expr("INTERVAL '1' MINUTE")
    failed = (F.col("o_orderstatus") == "F") & _every("o_orderkey", 3)
    start = F.col("o_orderdate") + (F.col("o_orderkey") % 1440).cast("int") * minute
    quantity = F.col("l_quantity")
    end = (
        F.when(failed, None)
        .when(_every("o_orderkey", 29), F.col("start_time") - 30 * minute)
        .when(_every("o_orderkey", 31), F.col("start_time") + 2000 * minute)
        .otherwise(F.col("start_time") + (10 + quantity).cast("int") * minute)
    )
    kwh = (
        F.when(_every("o_orderkey", 37), -quantity)
        .when(_every("o_orderkey", 41), quantity * 40)
        .when(_every("o_orderkey", 67), None)
        .otherwise(quantity * 1.25)
    )
    priority = F.col("o_orderpriority")
    method = (
        F.when(priority.isin("1-URGENT", "2-HIGH"), "card").when(priority == "3-MEDIUM", "RFID").otherwise("app_wallet")
    )
    return (
        read(spark, sf_dir, "orders")
        .withColumn("start_time", start)
        .join(first_line, "o_orderkey", "left")
        .select(
            _code("S", F.col("o_orderkey")).alias("session_id"),
            _code("U", F.col("o_custkey")).alias("user_id"),
            _code("C", F.col("l_suppkey")).alias("charger_id"),
            "start_time",
            end.alias("end_time"),
            kwh.cast("decimal(10,4)").alias("kwh_consumed"),
            method.alias("payment_method"),
            F.when(failed, "failed").otherwise("completed").alias("status"),
            *_audit("transactions.json", "o_orderkey"),
        )
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    failed = (F.col("o_orderstatus") == "F") & _every("o_orderkey", 3)
    amount = (
        F.when(_every("o_orderkey", 43), -5)
        .when(_every("o_orderkey", 47), 0)
        .when(_every("o_orderkey", 53), None)
        .when(_every("o_orderkey", 59), 100 + key % 900)
        .otherwise(5 + (key * 13) % 20)
    )
    payer = F.col("o_custkey") + _every("o_orderkey", 61).cast("int")
    return (
        read(spark, sf_dir, "orders")
        .where((key % 23 != 0) & ~failed)
        .select(
            _code("P", key).alias("payment_id"),
            _code("S", key).alias("session_id"),
            _code("U", payer).alias("user_id"),
            amount.cast("decimal(10,2)").alias("amount"),
            F.lit("CHF").alias("currency"),
            *_audit("payments.json", "o_orderkey"),
        )
    )
