"""Distinct counts that add up: exact bitmaps of ids per finest group, united by OR for any coarser one.

Ids are numbered once, densely. The set of ids of a group is kept as bitmaps, one for every 32,768 numbers, so a set costs
at most a bit per id and its parts combine on the map side. Weeks, months and totals come from the stored sets of the days,
without reading the fact again and without a count being wrong for ids met on several days.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampflow.operators.joins import union_all
from ampflow.operators.ranking import global_positions


def numbered_ids(df: DataFrame, column: str) -> DataFrame:
    """``(id, number)`` of every non-NULL value, numbered from 1 in order."""
    ids = df.select(F.col(column).alias("id"), F.lit(0).alias("_all")).where(F.col("id").isNotNull()).distinct()
    ranked = global_positions(ids, "_all", [F.col("id")])
    return ranked.select("id", (F.col("position") + 1).cast("bigint").alias("number"))


def id_sets(df: DataFrame, keys: Sequence[str], counted: Mapping[str, str], numbers: Mapping[str, DataFrame]) -> DataFrame:
    """``keys`` with ``(kind, bucket, ids)``: the ids of each column of ``counted`` in each group, as bitmaps.

    ``numbers`` has the :func:`numbered_ids` of each column. Repeated ids of a group combine before the join.
    """
    parts = []
    for kind, column in counted.items():
        met = df.select(*keys, F.col(column).alias("id")).where(F.col("id").isNotNull()).distinct()
        own = met.join(numbers[kind], "id").select(
            *keys,
            F.lit(kind).alias("kind"),
            F.bitmap_bucket_number("number").alias("bucket"),
            F.bitmap_bit_position("number").alias("bit"),
        )
        parts.append(own.groupBy(*keys, "kind", "bucket").agg(F.bitmap_construct_agg("bit").alias("ids")))
    return union_all(parts)


def distinct_at(sets: DataFrame, keys: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """One row for each group of the coarser ``keys``, with the number of distinct ids of each kind."""
    united = sets.groupBy(*keys, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("ids")).alias("n"))
    return united.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in kinds]
    )
