"""Joins whose skew adaptive execution cannot resolve by itself, and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ampflow.functions.measures import lookup_key

ROWS_PER_TASK = 5_000_000
KEY_BUCKETS = 1 << 14


def frequent_keys(df: DataFrame, key: str, rows_per_task: int, buckets: int = KEY_BUCKETS) -> DataFrame:
    """``(key, _slices)`` of every key with more than ``rows_per_task`` rows, counted exactly.

    Rows are first counted by a bucket of their key's hash, which combines on the map side. Only the keys of buckets with
    that many rows are counted one by one; most tables have no such bucket, and then no key is shuffled.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    keyed = df.where(F.col(key).isNotNull()).select(key, bucket.alias("_bucket"))
    full = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > rows_per_task)
    within = keyed.join(F.broadcast(full.select("_bucket")), "_bucket", "left_semi")
    counted = within.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    slices = F.ceil(F.col("_rows") / rows_per_task).cast("long")
    return counted.where(F.col("_rows") > rows_per_task).select(key, slices.alias("_slices"))


def left_join_many(left: DataFrame, right: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``left`` LEFT JOIN ``right`` USING (key), also when one key owns a large share of ``right``.

    Adaptive execution splits a skewed left side of a left outer join but not a skewed right side. So keys with more than
    ``rows_per_task`` right rows, however many they are, are dealt to slices: their right rows get one slice each, their
    left rows a copy for every slice, all other rows slice 0, and one join by key and slice serves all. A copy that meets
    nothing in its slice is no row without a match, as a hot key has right rows by definition, and is dropped.
    Each side is read once; the keys of ``right`` are counted before. ``right`` should be a table scan (or narrow over
    one), which re-reads its rows in the same order on a retry.
    """
    # One hot key takes rows_per_task rows at least: a trillion rows have 200,000 of them, a few megabytes.
    hot = F.broadcast(frequent_keys(right, key, rows_per_task))
    zero = F.lit(0).cast("long")
    dealt = right.join(hot, key, "left").withColumns(
        {"_slice": F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("_slices")), zero), "_met": F.lit(True)}
    )
    copies = F.explode(F.sequence(zero, F.coalesce(F.col("_slices"), F.lit(1)) - 1))
    asked = left.join(hot, key, "left").withColumn("_slice", copies)
    joined = asked.join(dealt.drop("_slices"), [key, "_slice"], "left")
    return joined.where(F.col("_slices").isNull() | F.col("_met")).drop("_slices", "_slice", "_met")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, matched by name. Pairs are united first: each union analyses its whole plan again."""
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return frames[0]


def with_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Adds the columns of ``row``, a frame of exactly one row such as a global aggregate, to every row of ``df``.

    A scalar subquery: ``row`` is computed once and ``df`` is only projected, not joined. More than one row is an
    error at run time.
    """
    packed = row.select(F.struct(*row.columns).alias("_row")).scalar()
    return df.withColumn("_row", packed).select(*df.columns, "_row.*")


def lookup_spelling(df: DataFrame, column: str, mapping: DataFrame, raw: str, standard: str) -> DataFrame:
    """Left join on the trimmed, lower-cased spelling; adds ``standard`` (NULL when unmapped).

    Two entries of ``mapping`` that differ only in case both match, as in the plain SQL join.
    """
    small = mapping.select(lookup_key(F.col(raw)).alias("_spelling"), F.col(standard))
    return df.join(small, lookup_key(F.col(column)) == F.col("_spelling"), "left").drop("_spelling")


def replace_values(df: DataFrame, column: str, mapping: DataFrame, old: str, new: str) -> DataFrame:
    """Exact value replacement by a lookup table; values without an entry stay."""
    pairs = mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    return (
        df.join(pairs, F.col(column) == F.col("_old"), "left")
        .withColumn(column, F.coalesce(F.col("_new"), F.col(column)))
        .drop("_old", "_new")
    )


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-NULL child keys without parent, with their row counts; hot keys combine before the shuffle."""
    counted = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return counted.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def differing(left: Column, right: Column) -> Column:
    """TRUE when both are present and unequal."""
    return F.coalesce(left != right, F.lit(False))
