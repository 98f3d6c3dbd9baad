"""Global positions and tiles without a single-partition window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampflow.session import cut_lineage


def global_positions(df: DataFrame, group: str, order: Sequence[Column]) -> DataFrame:
    """Adds ``position`` (0-based, within ``group``) and ``size`` (rows of the group).

    One range-partitioned sort numbers the rows inside each sorted block; the block sizes, a handful of rows per
    block, give the offsets. Rows are materialised in between so that both steps see the same blocks. A group that
    holds all the rows is still spread over all blocks.
    """
    ordered = cut_lineage(
        df.orderBy(F.col(group), *order)
        .withColumn("_block", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id())
    )
    blocks = ordered.groupBy(group, "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    earlier = F.sum("_n").over(Window.partitionBy(group).orderBy("_block")) - F.col("_n")
    offsets = blocks.select(
        group,
        "_block",
        (earlier - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy(group)).alias("size"),
    )
    return (
        ordered.join(F.broadcast(offsets), [group, "_block"])
        .withColumn("position", F.col("_row") + F.col("_shift"))
        .drop("_block", "_row", "_shift")
    )


def tile_of(position: Column, size: Column, tiles: int) -> Column:
    """1-based tile of a 0-based position; the first ``size % tiles`` tiles hold one row more."""
    small = F.floor(size / tiles)
    extra = size % tiles
    in_large = extra * (small + 1)
    return (
        F.when(position < in_large, F.floor(position / (small + 1)) + 1)
        .otherwise(extra + F.floor((position - in_large) / F.greatest(small, F.lit(1))) + 1)
        .cast("int")
    )


def with_tiles(df: DataFrame, key: str, measures: Mapping[str, str], tiles: int = 4) -> DataFrame:
    """Adds one tile column per measure (``measures`` maps output name to measure column).

    Ties are broken by ``key``, so the result is the same on every run. All measures share one sort.
    """
    cells = [
        F.struct(F.lit(out).alias("measure"), F.col(column).cast("double").alias("value"))
        for out, column in measures.items()
    ]
    ranked = global_positions(
        df.select(key, F.inline(F.array(*cells))),
        "measure",
        [F.col("value").asc_nulls_last(), F.col(key).asc_nulls_last()],
    )
    tile = tile_of(F.col("position"), F.col("size"), tiles)
    wide = ranked.groupBy(F.col(key).alias("_key")).agg(
        *[F.max(F.when(F.col("measure") == out, tile)).alias(out) for out in measures]
    )
    return df.join(wide, df[key].eqNullSafe(wide["_key"])).drop("_key")
