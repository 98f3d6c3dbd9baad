"""Several distinct counts per group without widening the other aggregates.

Spark answers several COUNT(DISTINCT) beside ordinary sums by repeating each input row once per distinct column, with
all sums in every shuffled row. Here the counted columns alone are stacked into (group, kind, id) rows, made distinct
(copies combine before the shuffle, and a hot group is spread over its ids) and counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _distinct_ids(df: DataFrame, keys: Sequence[str], counted: Mapping[str, str]) -> DataFrame:
    cells = [
        F.struct(F.lit(i).alias("_kind"), F.col(column).cast("string").alias("_id"))
        for i, column in enumerate(counted.values())
    ]
    return df.select(*keys, F.inline(F.array(*cells))).where(F.col("_id").isNotNull()).distinct()


def distinct_counts(df: DataFrame, keys: Sequence[str], counted: Mapping[str, str]) -> DataFrame:
    """One row per group with any value; ``counted`` maps output name to column."""
    return (
        _distinct_ids(df, keys, counted)
        .groupBy(*keys)
        .agg(*[F.count_if(F.col("_kind") == i).alias(out) for i, out in enumerate(counted)])
    )


def distinct_counts_with_total(df: DataFrame, keys: Sequence[str], part: str, counted: Mapping[str, str]) -> DataFrame:
    """Distinct counts per ``keys`` and ``part``, and beside them how many ids are first met in that part.

    The latter, named ``<out>_first``, add up over the parts to the distinct count of ``keys`` alone. An id occurs
    once per part here, so the window holds at most as many rows as there are parts.
    """
    nth = F.row_number().over(Window.partitionBy(*keys, "_kind", "_id").orderBy(part))
    ids = _distinct_ids(df, [*keys, part], counted).withColumn("_is_first", nth == 1)
    counts = []
    for i, out in enumerate(counted):
        mine = F.col("_kind") == i
        counts += [F.count_if(mine).alias(out), F.count_if(mine & F.col("_is_first")).alias(f"{out}_first")]
    return ids.groupBy(*keys, part).agg(*counts)


def join_on_group(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of two per-group tables; a NULL key is a group like any other."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, condition, "left").drop(*[f"_r_{k}" for k in keys])
