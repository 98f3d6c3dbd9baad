"""Exact continuous quantiles by selection on integer keys: no value is gathered, sorted or written.

Every measure is read as a 64-bit integer whose order is that of the measure: units of fixed-point numbers, microseconds
of instants, and for floating-point numbers exponent and mantissa side by side. One pass finds count and range of all
measures. The range is halved into cells by bits: a histogram over the leading bits says which cell holds a wanted rank,
the next pass looks only inside that cell, down to single keys. Widths follow the range of the data, so the histograms of
a measure are as small as its values allow, and never larger than ``1 << MAX_BITS`` rows. They combine on the map side,
whatever the number of rows or the skew of the values. All measures share the passes, and everything is one lazy plan; only
:func:`long_quantiles` writes the distinct values of its measures once, so that no pass reads the frames again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampflow.operators.joins import with_row
from ampflow.session import cut_lineage

#: Bits that one pass resolves at most.
MAX_BITS = 22
QUARTILES = (0.25, 0.75)

_MANTISSA = 52
_ONE = 1 << _MANTISSA
_SPECIAL = 2047 * _ONE


@dataclass(frozen=True)
class Fixed:
    """A measure as an integer number of units, ``per_unit`` of them making one natural unit.

    ``units`` is an SQL expression. ``digits`` is how many digits the units are expected to have; it sets the number of
    passes, larger values only make the histograms larger.
    """

    units: str
    per_unit: int = 1
    digits: int = 10


def decimal_measure(column: str, precision: int, scale: int) -> Fixed:
    if precision <= 15:  # the nearest double times 10^scale is within rounding of the exact integer
        return Fixed(f"CAST(RINT(CAST({column} AS DOUBLE) * {10**scale}) AS BIGINT)", 10**scale, precision)
    return Fixed(f"CAST({column} * {10**scale} AS BIGINT)", 10**scale, precision)


def instant_measure(column: str) -> Fixed:
    """Instants by their microseconds since 1970."""
    return Fixed(f"UNIX_MICROS(CAST({column} AS TIMESTAMP))", 1_000_000, 17)


def with_sortable(df: DataFrame, names: Sequence[str], *others: str) -> DataFrame:
    """Doubles as integers of the same order: biased exponent, then mantissa; infinities and NaN follow all others.

    Worked out in steps, each a projection, so that no expression is written out several times. The logarithm is rounded,
    so the exponent may be off by one, which shows in what it leaves of the number.
    """
    steps = {
        "size": "IF(ABS({x}) < DOUBLE('Infinity'), ABS({x}), 0D)",
        "power": "GREATEST(-1022L, LEAST(1023L, COALESCE(FLOOR(LOG2({x}_size)), -1022L)))",
        "left": "{x}_size / POW(2D, {x}_power)",
        "fix": "CASE WHEN {x}_left >= 2 THEN 1 WHEN {x}_left < 1 AND {x}_power > -1022 THEN -1 ELSE 0 END",
        "key": (
            f"CASE WHEN ISNAN({{x}}) THEN {_SPECIAL + 1}L WHEN ABS({{x}}) = DOUBLE('Infinity') THEN {_SPECIAL}L ELSE "
            f"({{x}}_power + {{x}}_fix + 1022) * {_ONE}L + CAST({{x}}_left * POW(2D, -{{x}}_fix) * {_ONE}D AS BIGINT) END"
        ),
    }
    for step, text in steps.items():
        df = df.selectExpr("*", *[f"{text.format(x=n)} AS {n}_{step}" for n in names])
    return df.selectExpr(*others, *[f"CASE WHEN {n} < 0 THEN -{n}_key WHEN {n} IS NOT NULL THEN {n}_key END AS {n}" for n in names])


def from_sortable(key: str) -> str:
    """The double of such an integer, as SQL."""
    size, exponent = f"ABS({key})", f"SHIFTRIGHT(ABS({key}), {_MANTISSA})"
    mantissa = f"CAST({size} & {_ONE - 1}L AS DOUBLE)"
    return (
        f"IF({key} < 0, -1D, 1D) * CASE WHEN {size} = {_SPECIAL}L THEN DOUBLE('Infinity')"
        f" WHEN {size} > {_SPECIAL}L THEN DOUBLE('NaN') WHEN {exponent} = 0 THEN {mantissa} * 4.9E-324D"
        f" ELSE (1 + {mantissa} / {_ONE}D) * POW(2D, {exponent} - 1023) END"
    )


# A wanted rank is a column: per probability i the neighbours ``lo<i>`` and ``hi<i>`` of position ``p * (n - 1)``.
def _rank_names(probs: Sequence[float]) -> list[str]:
    return [f"{side}{i}" for i in range(len(probs)) for side in ("lo", "hi")]


def _ranges(df: DataFrame, keys: Sequence[str], probs: Sequence[float], passes: int) -> DataFrame:
    """One row per measure with values: its count, the bits of its range, the bits of a pass, and its wanted ranks."""
    wide = df.agg(
        *[F.expr(f"named_struct('measure', {i}, 'rows', COUNT({k}), 'low', MIN({k}), 'high', MAX({k}))").alias(k) for i, k in enumerate(keys)]
    )
    return _fitted(wide.selectExpr(f"INLINE(ARRAY({', '.join(keys)}))"), probs, passes)


def _fitted(ranges: DataFrame, probs: Sequence[float], passes: int) -> DataFrame:
    """Ranges (measure, rows, low, high) with the bits of a range and of a pass, and the wanted ranks."""
    ranks = [f"{end}({p!r}D * (rows - 1)) AS {side}{i}" for i, p in enumerate(map(float, probs)) for side, end in (("lo", "FLOOR"), ("hi", "CEIL"))]
    bits = "LENGTH(BIN(SHIFTRIGHT(high, 1) - SHIFTRIGHT(low, 1))) + 1"
    width = f"CAST(CEIL(({bits}) / {passes}) AS INT) AS width"
    return ranges.where("rows > 0").selectExpr("measure", "rows", f"{bits} AS bits", width, *ranks)


def _inside(rows: DataFrame, cells: DataFrame, step: int, probs: Sequence[float], weight: str = "1") -> DataFrame:
    """One pass: rows (measure, key) inside ``cells``, counted by the next bits; cells that hold a wanted rank.

    A rank is counted from the start of its cell and NULL in all others. ``cells`` has at most two rows per measure and
    probability, so it is safe to broadcast. A row stands for ``weight`` values.
    """
    names = _rank_names(probs)
    leading = "SHIFTRIGHT(key, GREATEST(0, bits - {} * width))"
    met = rows.join(F.broadcast(cells), "measure")
    if step:
        met = met.where(f"cell = {leading.format(step)}")
    here = ["measure", *(["cell"] if step else [])]
    carried = ["rows", "bits", "width", *names]
    counted = (
        met.selectExpr(*here, *carried, f"{leading.format(step + 1)} AS next", f"{weight} AS weight")
        .groupBy(*here, "next")
        .agg(F.expr("SUM(weight)").alias("n"), *[F.expr(f"MAX({c})").alias(c) for c in carried])
        .selectExpr("*", f"SUM(n) OVER (PARTITION BY {', '.join(here)} ORDER BY next) AS upto")
    )
    held = [f"CASE WHEN {r} >= upto - n AND {r} < upto THEN {r} - upto + n END AS {r}" for r in names]
    found = counted.selectExpr("measure", "rows", "bits", "width", "next AS cell", *held)
    return found.where(f"COALESCE({', '.join(names)}) IS NOT NULL")


def _selected(df: DataFrame, keys: Sequence[str], probs: Sequence[float], bits: int) -> DataFrame:
    """Cells (measure, rows, cell) whose ``cell`` is the key at a wanted rank; measures are numbered in order."""
    passes = -(-bits // MAX_BITS)
    cells = _ranges(df, keys, probs, passes)
    pairs = ", ".join(f"named_struct('measure', {i}, 'key', {k})" for i, k in enumerate(keys))
    rows = df.selectExpr(f"INLINE(ARRAY({pairs}))").where("key IS NOT NULL")
    for step in range(passes):
        cells = _inside(rows, cells, step, probs)
    return cells


def _one_row(cells: DataFrame, names: Sequence[str], probs: Sequence[float], value_of: Callable[[str], str]) -> DataFrame:
    """Interpolated quantiles as one row: ``<name>_n`` and ``<name>_p<i>`` (NULL without values)."""
    ends, values, out = [], [], []
    for number, name in enumerate(names):
        ends.append(F.expr(f"MAX(IF(measure = {number}, rows, NULL))").alias(f"rows{number}"))
        out.append(f"COALESCE(rows{number}, 0L) AS `{name}_n`")
        for i, p in enumerate(map(float, probs)):
            for side in ("lo", "hi"):
                end = f"{side}{number}_{i}"
                ends.append(F.expr(f"MAX(IF(measure = {number} AND {side}{i} IS NOT NULL, cell, NULL))").alias(end))
                values.append(f"{value_of(end)} AS {end}")
            low, high = f"lo{number}_{i}", f"hi{number}_{i}"
            position = f"{p!r}D * (rows{number} - 1)"
            part = f"({position} - FLOOR({position}))"
            out.append(f"CAST({low} AS DOUBLE) + IF({part} = 0, 0D, {part} * CAST({high} - {low} AS DOUBLE)) AS `{name}_p{i}`")
    return cells.agg(*ends).selectExpr(*[f"rows{i}" for i in range(len(names))], *values).selectExpr(*out)


def _numbered(df: DataFrame, measures: Sequence[Column]) -> tuple[DataFrame, list[str]]:
    names = [f"k{i}" for i in range(len(measures))]
    return df.select(*[m.alias(n) for n, m in zip(names, measures, strict=True)]), names


def fixed_quantiles(df: DataFrame, measures: Mapping[str, Fixed], probs: Sequence[float] = QUARTILES) -> DataFrame:
    """One row with the exact quantiles, in units, of all measures; each pass reads only their columns."""
    bits = max((2 * 10**m.digits).bit_length() for m in measures.values())
    keys, names = _numbered(df, [F.expr(m.units).cast("bigint") for m in measures.values()])
    return _one_row(_selected(keys, names, probs, bits), list(measures), probs, lambda key: key)


def float_quantiles(df: DataFrame, values: Mapping[str, Column], probs: Sequence[float] = QUARTILES) -> DataFrame:
    """One row with the exact quantiles of floating-point measures; NaN counts as larger than any number."""
    numbers, names = _numbered(df, [column.cast("double") for column in values.values()])
    return _one_row(_selected(with_sortable(numbers, names), names, probs, 64), list(values), probs, from_sortable)


def long_quantiles(rows: DataFrame, probs: Sequence[float] = QUARTILES) -> DataFrame:
    """Exact quantiles ``(measure, p0, p1, ..)`` of doubles in long form ``(measure, value)``, for any number of measures.

    ``rows`` is read once: equal values are counted in one shuffle, where copies combine first. A value is made a key once
    and written; the passes read the keys and their counts only.
    """
    passes = -(-64 // MAX_BITS)
    counted = rows.where("value IS NOT NULL").groupBy("measure", "value").agg(F.expr("COUNT(1)").alias("copies"))
    keyed = cut_lineage(with_sortable(counted, ["value"], "measure", "copies").withColumnRenamed("value", "key"))
    ranges = keyed.groupBy("measure").agg(F.sum("copies").alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"))
    cells = _fitted(ranges, probs, passes)
    for step in range(passes):
        cells = _inside(keyed, cells, step, probs, "copies")
    ends = [F.expr(f"MAX(IF({r} IS NOT NULL, cell, NULL))").alias(r) for r in _rank_names(probs)]
    found = cells.groupBy("measure").agg(F.max("rows").alias("rows"), *ends)
    found = found.selectExpr("measure", "rows", *[f"{from_sortable(r)} AS {r}" for r in _rank_names(probs)])
    out = []
    for i, p in enumerate(map(float, probs)):
        part = f"({p!r}D * (rows - 1) - FLOOR({p!r}D * (rows - 1)))"
        out.append(f"lo{i} + IF({part} = 0, 0D, {part} * (hi{i} - lo{i})) AS p{i}")
    return found.selectExpr("measure", *out)


@dataclass(frozen=True)
class IqrRule:
    """Outlier rule on one measure: outside ``[q1 - k * iqr, q3 + k * iqr]``.

    ``positive_only`` takes the quartiles from, and flags, positive values only; otherwise the whole series counts.
    """

    name: str
    measure: Fixed
    positive_only: bool = True
    k: float = 1.5

    @property
    def population(self) -> Fixed:
        units = self.measure.units
        kept = f"CASE WHEN {units} > 0 THEN {units} END" if self.positive_only else units
        return Fixed(kept, self.measure.per_unit, self.measure.digits)

    def outlier(self) -> Column:
        """Flag column; needs the ``<name>_lower_units`` and ``<name>_upper_units`` of :func:`iqr_bounds`."""
        units = F.expr(self.population.units)
        lower, upper = F.col(f"{self.name}_lower_units"), F.col(f"{self.name}_upper_units")
        return F.coalesce((units < lower) | (units > upper), F.lit(False))


def iqr_bounds(df: DataFrame, rules: Sequence[IqrRule]) -> DataFrame:
    """One row: quartiles, IQR and bounds per rule, in natural units and (for exact comparison) in units."""
    row = fixed_quantiles(df, {r.name: r.population for r in rules}, QUARTILES)
    out: list[Column] = []
    for rule in rules:
        q1, q3 = F.col(f"{rule.name}_p0"), F.col(f"{rule.name}_p1")
        reach = rule.k * (q3 - q1)
        per_unit = float(rule.measure.per_unit)
        out += [
            F.col(f"{rule.name}_n"),
            (q1 / per_unit).alias(f"{rule.name}_q1"),
            (q3 / per_unit).alias(f"{rule.name}_q3"),
            ((q3 - q1) / per_unit).alias(f"{rule.name}_iqr"),
            ((q1 - reach) / per_unit).alias(f"{rule.name}_lower_bound"),
            ((q3 + reach) / per_unit).alias(f"{rule.name}_upper_bound"),
            (q1 - reach).alias(f"{rule.name}_lower_units"),
            (q3 + reach).alias(f"{rule.name}_upper_units"),
        ]
    return row.select(*out)


def with_iqr_bounds(df: DataFrame, rules: Sequence[IqrRule], bounds: DataFrame | None = None) -> DataFrame:
    """``df`` with the bounds attached to each row.

    Pass ``bounds`` to reuse frozen bounds of an earlier run (incremental loads).
    """
    row = iqr_bounds(df, rules) if bounds is None else bounds
    return with_row(df, row)
