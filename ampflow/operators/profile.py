"""Column statistics: counts, frequencies, histograms, summaries, profiles.

Frequencies of all columns come from one long (column, value) table, so that a value held by a third of the rows is
combined before the shuffle and no column's values meet in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampflow.functions.measures import is_true, rows_where
from ampflow.operators.joins import union_all, with_row
from ampflow.operators.quantiles import float_quantiles, long_quantiles
from ampflow.session import local_table

_QUARTERS = (0.25, 0.5, 0.75)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each non-NULL value, most frequent first."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), column)
    )


def counts_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequencies of several columns in long form: dimension, value, row_count."""
    cells = [F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns]
    return (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("value").isNotNull())
        .groupBy("dimension", "value")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("dimension", F.desc("row_count"), "value")
    )


def pair_counts(df: DataFrame, first: str, second: str) -> DataFrame:
    return (
        df.where(F.col(first).isNotNull() & F.col(second).isNotNull())
        .groupBy(first, second)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), first, second)
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_last())


def null_counts(df: DataFrame) -> DataFrame:
    """Type and number of missing values per column, in column order."""
    wide = df.agg(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.count_if(F.col(field.name).isNull()).alias("null_count"),
            ).alias(f"c{i}")
            for i, field in enumerate(df.schema.fields, 1)
        ]
    )
    return wide.select(F.inline(F.array(*wide.columns))).orderBy("position")


def predicate_counts(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Rows satisfying each named predicate, all in one pass."""
    wide = df.agg(
        *[
            F.struct(F.lit(name).alias("check_name"), rows_where(p).alias("row_count")).alias(f"c{i}")
            for i, (name, p) in enumerate(predicates.items())
        ]
    )
    return wide.select(F.inline(F.array(*wide.columns)))


def flag_crosstab(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows carrying both flags, for each unordered pair including a flag with itself; one pass."""
    pairs = [(flags[i], flags[j]) for i in range(len(flags)) for j in range(i + 1)]
    wide = df.agg(
        *[
            F.struct(
                F.lit(a).alias("row_issue"),
                F.lit(b).alias("col_issue"),
                rows_where(is_true(F.col(a)) & F.col(b)).alias("row_count"),
            ).alias(f"p{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return wide.select(F.inline(F.array(*wide.columns)))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins from minimum to maximum; the last bin is closed. Empty bins are listed with 0."""
    value = F.col(column).cast("double")
    ends = df.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    width = (F.col("high") - F.col("low")) / bins
    bin_of = F.when(width == 0, 0).otherwise(
        F.least(F.floor((F.col("value") - F.col("low")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))
    )
    counted = (
        with_row(df.select(value.alias("value")).where(F.col("value").isNotNull()), ends)
        .groupBy(bin_of.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    grid = ends.where(F.col("low").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        F.col("low"),
        width.alias("width"),
    )
    return (
        grid.join(counted, "bin", "left")
        .select(
            "bin",
            (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
            (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
        )
        .orderBy("bin")
    )


def _as_number(field: T.StructField) -> Column | None:
    """Numeric reading of a column: numbers as they are, times as seconds since 1970; None for categories."""
    column = F.col(field.name)
    if isinstance(field.dataType, T.NumericType):
        return column.cast("double")
    if isinstance(field.dataType, T.TimestampNTZType):
        day_seconds = F.unix_date(F.to_date(column)).cast("bigint") * 86400
        return (day_seconds + F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)).cast("double")
    if isinstance(field.dataType, T.DateType):
        return (F.unix_date(column).cast("bigint") * 86400).cast("double")
    return None


def _frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    return (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _numeric_rows(df: DataFrame, numbers: Mapping[str, Column], stats) -> DataFrame:
    """One aggregate over ``df``, turned into one row per numeric column."""
    wide = df.agg(
        *[
            F.struct(F.lit(name).alias("column_name"), *[s.alias(k) for k, s in stats(col).items()]).alias(f"c{i}")
            for i, (name, col) in enumerate(numbers.items())
        ]
    )
    return wide.select(F.inline(F.array(*wide.columns)))


def describe(df: DataFrame) -> DataFrame:
    """Summary per column: numbers and times get mean, deviation and quartiles; categories get unique, top, freq."""
    numbers = {f.name: n for f in df.schema.fields if (n := _as_number(f)) is not None}
    categories = [f.name for f in df.schema.fields if f.name not in numbers]
    parts = []
    if numbers:
        basic = _numeric_rows(
            df,
            numbers,
            lambda x: {
                "count": F.count(x),
                "mean": F.avg(x),
                "std": F.stddev_samp(x),
                "min": F.min(x),
                "max": F.max(x),
            },
        )
        row = float_quantiles(df, numbers, _QUARTERS)
        quartiles = row.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(name).alias("column_name"),
                            F.col(f"{name}_p0").alias("p25"),
                            F.col(f"{name}_p1").alias("p50"),
                            F.col(f"{name}_p2").alias("p75"),
                        )
                        for name in numbers
                    ]
                )
            )
        )
        parts.append(
            basic.join(quartiles, "column_name").select(
                "column_name",
                "count",
                F.lit(None).cast("bigint").alias("unique"),
                F.lit(None).cast("string").alias("top"),
                F.lit(None).cast("bigint").alias("freq"),
                "mean",
                "std",
                "min",
                "p25",
                "p50",
                "p75",
                "max",
            )
        )
    if categories:
        counted = _frequencies(df, categories)
        top = counted.groupBy("column_name").agg(
            F.sum("n").alias("count"),
            F.count(F.lit(1)).alias("unique"),
            F.max("n").alias("freq"),
        )
        first = (
            counted.join(F.broadcast(top.select("column_name", F.col("freq").alias("n"))), ["column_name", "n"])
            .groupBy("column_name")
            .agg(F.min("value").alias("top"))
        )
        empty = [F.lit(None).cast("double").alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")]
        parts.append(
            top.join(first, "column_name").select("column_name", "count", "unique", "top", "freq", *empty)
        )
    return union_all(parts)


def profile_numeric(df: DataFrame) -> DataFrame:
    """Moments of every numeric column in one pass. Skewness and kurtosis are bias-corrected."""
    numbers = {
        f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, T.NumericType)
    }
    total = F.count(F.lit(1))

    def stats(x: Column) -> dict[str, Column]:
        return {
            "n": F.count(x),
            "n_missing": total - F.count(x),
            "n_zeros": rows_where(x == 0),
            "n_negative": rows_where(x < 0),
            "sum": F.sum(x),
            "mean": F.avg(x),
            "variance": F.var_samp(x),
            "std": F.stddev_samp(x),
            "min": F.min(x),
            "max": F.max(x),
            "_g1": F.skewness(x),
            "_g2": F.kurtosis(x),
        }

    n = F.col("n").cast("double")
    skew = F.when(n > 2, F.col("_g1") * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))
    kurt = F.when(
        n > 3,
        (n - 1) * ((n + 1) * F.col("_g2") + 6) / F.nullif((n - 2) * (n - 3), F.lit(0.0)),
    )
    return (
        _numeric_rows(df, numbers, stats)
        .withColumns({"skewness": skew, "kurtosis": kurt, "range": F.col("max") - F.col("min")})
        .drop("_g1", "_g2")
    )


def profile_columns(df: DataFrame) -> DataFrame:
    """Missing, distinct and once-only values of every column, as counts and shares."""
    counted = (
        _frequencies(df, df.columns)
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("n_distinct"), F.count_if(F.col("n") == 1).alias("n_unique"))
    )
    rows = df.agg(F.count(F.lit(1)).alias("n_rows"))
    zero = F.lit(0).cast("bigint")
    return (
        with_row(null_counts(df), rows)
        .join(counted, "column_name", "left")
        .select(
            "position",
            "column_name",
            "data_type",
            "n_rows",
            F.col("null_count").alias("n_missing"),
            F.try_divide(F.col("null_count").cast("double"), F.col("n_rows").cast("double")).alias("p_missing"),
            F.coalesce("n_distinct", zero).alias("n_distinct"),
            F.coalesce("n_unique", zero).alias("n_unique"),
        )
        .orderBy("position")
    )


def profile_correlations(df: DataFrame) -> DataFrame:
    """Pearson correlation of every pair of numeric columns over their common rows; one pass."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    wide = df.agg(
        *[
            F.struct(
                F.lit(a).alias("column_a"),
                F.lit(b).alias("column_b"),
                F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("correlation"),
            ).alias(f"c{i}")
            for i, (a, b) in enumerate(combinations(names, 2))
        ]
    )
    return wide.select(F.inline(F.array(*wide.columns)))


def profile_duplicates(df: DataFrame) -> DataFrame:
    """Number of rows, and of rows that repeat an earlier one; copies combine before the shuffle."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("n_duplicates"),
    )


def profile_time_series(df: DataFrame, ts: str, lags: Sequence[int] = (1, 7)) -> DataFrame:
    """Time-series part of a profile, on the daily row counts: span, gaps and autocorrelation.

    The window runs over days, of which there are at most some thousands.
    """
    days = (
        df.where(F.col(ts).isNotNull())
        .groupBy(F.to_date(ts).alias("day"))
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    order = Window.orderBy("day")
    shifted = days.withColumns(
        {"_gap": F.datediff("day", F.lag("day").over(order))} | {f"_lag{k}": F.lag("n", k).over(order) for k in lags}
    )
    return shifted.agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.count(F.lit(1)).alias("days_with_rows"),
        F.coalesce(F.sum(F.col("_gap") - 1), F.lit(0)).alias("days_without_rows"),
        F.coalesce(F.max("_gap"), F.lit(0)).alias("longest_step_days"),
        *[F.corr("n", f"_lag{k}").alias(f"autocorrelation_{k}") for k in lags],
    )


def _kind(kind: T.DataType) -> str:
    if isinstance(kind, T.NumericType):
        return "number"
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return "time"
    return "flag" if isinstance(kind, T.BooleanType) else "text"


def _reading(column: str, kind: str) -> str:
    """The numeric reading of a column as SQL: numbers as doubles, times as seconds since 1970, none for others."""
    if kind == "time":
        instant = f"CAST({column} AS TIMESTAMP_NTZ)"
        return (
            f"CAST(UNIX_DATE(CAST({instant} AS DATE)) * 86400L + HOUR({instant}) * 3600 + MINUTE({instant}) * 60"
            f" + SECOND({instant}) AS DOUBLE)"
        )
    return f"CAST({column} AS DOUBLE)" if kind == "number" else "CAST(NULL AS DOUBLE)"


def profile_frames(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row for every column of every frame: missing, distinct, once-only and most frequent values, moments, quartiles,
    lengths.

    Each frame is summed up by one aggregate of mergeable states. The values of all columns of all frames are counted in
    one shuffle, where copies combine first; distinct, once-only and top values are read off these counts, so they are
    exact. The quartiles of all numbers and times share three passes over their distinct values.
    """
    fields = [(name, i, f.name, f.dataType) for name, df in frames.items() for i, f in enumerate(df.schema.fields, 1)]
    own = {name: [(n, f"`{c}`", _kind(t)) for n, (frame, _, c, t) in enumerate(fields) if frame == name] for name in frames}
    states, values, numbers = [], [], []
    for name, df in frames.items():
        structs, cells, readings = [], [], []
        for number, column, kind in own[name]:
            x = _reading(column, kind)
            # Only what the kind of a column has is summed up; the rest is a literal, not an aggregate of nothing.
            moments = {"mean": "AVG", "std": "STDDEV_SAMP", "min": "MIN", "max": "MAX", "g1": "SKEWNESS", "g2": "KURTOSIS"}
            moments = {m: f"{a}({x})" if kind in ("number", "time") else "CAST(NULL AS DOUBLE)" for m, a in moments.items()}
            signs = {m: f"COUNT_IF({x} {test} 0)" if kind == "number" else "0L" for m, test in (("n_zeros", "="), ("n_negative", "<"))}
            lengths = {"min_length": ("MIN", "INT"), "max_length": ("MAX", "INT"), "mean_length": ("AVG", "DOUBLE")}
            lengths = {m: f"{a}(LENGTH({column}))" if kind == "text" else f"CAST(NULL AS {t})" for m, (a, t) in lengths.items()}
            stats = {"number": number, "n_rows": "COUNT(1)", "n_missing": f"COUNT_IF({column} IS NULL)"} | signs | moments | lengths
            structs.append(f"named_struct({', '.join(f'{k!r}, {v}' for k, v in stats.items())})")
            shown = f"{column} + 0D" if "double" in df.schema[column.strip("`")].dataType.simpleString() else column
            cells.append(f"CASE WHEN {column} IS NOT NULL THEN named_struct('number', {number}, 'value', CAST({shown} AS STRING)) END")
            if kind in ("number", "time"):
                readings.append(f"named_struct('measure', {number}, 'value', {x})")
        states.append(df.selectExpr(f"ARRAY({', '.join(structs)}) AS states").selectExpr("INLINE(states)"))
        values.append(df.selectExpr(f"INLINE(ARRAY_COMPACT(ARRAY({', '.join(cells)})))"))
        if readings:
            numbers.append(df.selectExpr(f"INLINE(ARRAY({', '.join(readings)}))"))
    counted = union_all(values).groupBy("number", "value").agg(F.count(F.lit(1)).alias("n"))
    spread = counted.groupBy("number").agg(
        F.count(F.lit(1)).alias("n_distinct"), F.expr("COUNT_IF(n = 1)").alias("n_unique"), F.max("n").alias("freq")
    )
    # One row per column of the frames.
    most = F.broadcast(spread.select("number", F.col("freq").alias("n")))
    first = counted.join(most, ["number", "n"]).groupBy("number").agg(F.min("value").alias("first"))
    found = union_all(states).join(spread, "number", "left").join(first, "number", "left")
    if numbers:
        found = found.join(long_quantiles(union_all(numbers), _QUARTERS).withColumnRenamed("measure", "number"), "number", "left")
    else:
        found = found.selectExpr("*", *[f"CAST(NULL AS DOUBLE) AS p{i}" for i in range(3)])
    labels = local_table(
        next(iter(frames.values())).sparkSession,
        {
            "number": range(len(fields)),
            "frame_name": [f[0] for f in fields],
            "position": [f[1] for f in fields],
            "column_name": [f[2] for f in fields],
            "data_type": [f[3].simpleString() for f in fields],
            "kind": [_kind(f[3]) for f in fields],
        },
    )
    n = "CAST(n_rows - n_missing AS DOUBLE)"
    return labels.join(found, "number").selectExpr(
        "frame_name", "CAST(position AS INT) AS position", "column_name", "data_type", "kind", "n_rows", "n_missing",
        "TRY_DIVIDE(CAST(n_missing AS DOUBLE), CAST(n_rows AS DOUBLE)) AS p_missing",
        "COALESCE(n_distinct, 0L) AS n_distinct", "COALESCE(n_unique, 0L) AS n_unique",
        "IF(kind IN ('text', 'flag'), first, NULL) AS top", "freq",
        "IF(kind = 'number', n_zeros, NULL) AS n_zeros", "IF(kind = 'number', n_negative, NULL) AS n_negative",
        "mean", "std", "min", "p0 AS p25", "p1 AS p50", "p2 AS p75", "max",
        f"IF(kind = 'number' AND {n} > 2, g1 * SQRT({n} * ({n} - 1)) / NULLIF({n} - 2, 0D), NULL) AS skewness",
        f"IF(kind = 'number' AND {n} > 3, ({n} - 1) * (({n} + 1) * g2 + 6) / NULLIF(({n} - 2) * ({n} - 3), 0D), NULL) AS kurtosis",
        "min_length", "max_length", "mean_length",
    )
