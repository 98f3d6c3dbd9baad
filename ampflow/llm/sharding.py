"""Reproducible shuffle into shards: a Feistel permutation over global row numbers.

Every row gets its global number in a stated order. A keyed permutation of ``0 .. rows-1`` maps the number to a place;
place modulo shard count is the shard, place divided by it the slot. Both can be computed for any row number without
the data, and shard sizes differ by one row at most.

The permutation is a Feistel network over pairs ``(left, right)`` with ``left < a`` and ``right < b``, where ``a * b``
is the smallest such product at or above the row count for ``a`` about its square root. Fewer than ``a`` of its
values lie outside the row numbers; a value that does is permuted again until it lies inside (cycle walking).

Corner cases: an empty table gives no rows. Null texts count no bytes and have the checksum of the empty text. Null
order columns come first. Rows that are alike in all order columns are interchangeable: the set of results does not
depend on how they are told apart. Columns of the input with the names of the results are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ampflow.llm.common import free_name, read_table, scratch_path

ROUNDS = 4
SEED = 20_240_229
SHARDS = 40
OVERHEAD = 16
#: Walks after the first permutation. With fewer than 4,096 rows they reach every value outside the row numbers, so
#: the walk must end; with more, a walk goes on with a chance below 1 in 64, so 64 steps have one below 1e-115.
WALKS = 64


def halves(total: int) -> tuple[int, int]:
    """``(a, b)`` with ``a * b >= total`` and fewer than ``a`` values too many."""
    a = max(1, math.isqrt(max(0, total - 1)) + 1)
    return a, max(1, -(-total // a))


def permuted(number: Column, total: int, seed: int = SEED) -> Column:
    """One pass of the Feistel network."""
    a, b = halves(total)
    right = number % b
    left = F.call_function("div", number, F.lit(b).cast("long"))
    for i in range(ROUNDS):
        key = F.lit(seed * ROUNDS + i).cast("long")
        if i % 2 == 0:
            left = (left + F.pmod(F.xxhash64(key, right.cast("long")), F.lit(a).cast("long"))) % a
        else:
            right = (right + F.pmod(F.xxhash64(key, left.cast("long")), F.lit(b).cast("long"))) % b
    return left * b + right


def place_of(number: Column, total: int, seed: int = SEED) -> Column:
    """The place of a row number among ``total``: permuted until inside."""
    first = permuted(number, total, seed)
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)),
        first,
        lambda at, _: F.when(at < total, at).otherwise(permuted(at, total, seed)),
    )
    ended = F.when(walk < total, walk).otherwise(F.raise_error(F.lit("the permutation did not end")).cast("long"))
    return F.when(first < total, first).otherwise(ended)


def numbered(df: DataFrame, order: list[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """``df`` with its global row number from 0 in the order of the columns ``order``; and the row count.

    Rows are range-partitioned and sorted once and written with their partition and position there; what is added to
    a position is the row count of the partitions before, one number per partition. Ties are split over partitions by
    a running id, so a value that many rows share does not make a large partition.
    """
    spark = df.sparkSession
    tie, part, at, before = free_name(df, "_tie", "_part", "_at", "_before")
    keys = [F.col(f"`{c}`") for c in order]
    ranged = (
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys, F.col(tie))
        .sortWithinPartitions(*keys, tie)
        .drop(tie)
        .withColumn(part, F.spark_partition_id())
        .withColumn(at, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    path = scratch_path(spark, "numbered")
    ranged.write.parquet(path)
    stored = spark.read.schema(ranged.schema).parquet(path)
    sizes = stored.groupBy(part).agg(F.count("*").alias(before))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(part, F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before))
    total = stored.count()
    # One row per partition of the sort: their number is a setting, not a matter of the data.
    out = stored.join(F.broadcast(offsets), part)
    return out.withColumn(name, F.col(at) + F.col(before)).drop(part, at, before), total


def feistel_shards(df: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` with ``row_number``, ``shard`` (0 .. shards-1) and ``slot`` (gapless from 0 in each shard)."""
    rows, total = numbered(df.drop("row_number", "shard", "slot"), order)
    (place,) = free_name(rows, "_place")
    return (
        rows.withColumn(place, place_of(F.col("row_number"), total, seed))
        .withColumn("shard", (F.col(place) % shards).cast("int"))
        .withColumn("slot", F.call_function("div", F.col(place), F.lit(shards).cast("long")))
        .drop(place)
    )


def op9_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards under the law ``rows``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    return feistel_shards(narrow, ["doc_id", "size", "text_crc32"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
