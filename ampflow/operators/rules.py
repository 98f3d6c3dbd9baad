"""Declarative data-quality rules; each counts the records a test query would return."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampflow.operators.joins import union_all
from ampflow.session import local_table

UNIQUE, NOT_NULL, ACCEPTED, RELATED = "unique", "not_null", "accepted_values", "relationships"


@dataclass(frozen=True)
class Rule:
    """One test on ``table``; ``column`` may be an SQL expression."""

    table: str
    kind: str
    column: str
    values: tuple = ()
    parent: str = ""
    parent_column: str = ""
    severity: str = "error"


def duplicated(df: DataFrame, expression: str) -> DataFrame:
    """Non-NULL values occurring more than once, with their row counts."""
    return (
        df.groupBy(F.expr(expression).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("value").isNotNull() & (F.col("row_count") > 1))
    )


def not_accepted(df: DataFrame, expression: str, values: Sequence) -> DataFrame:
    """Non-NULL values outside the list, with their row counts."""
    value = F.expr(expression)
    return df.where(~value.isin(list(values))).groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("row_count"))


def null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL counts of the listed columns, in one pass."""
    wide = df.agg(
        *[
            F.struct(F.lit(c).alias("column_name"), F.count_if(F.expr(c).isNull()).alias("failures")).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
    )
    return wide.select(F.inline(F.array(*wide.columns)))


def _text_of(value) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _cells(table: str, numbered: Sequence[tuple[int, Rule]]) -> dict[int, str]:
    """What the rows of a table say about the rules: text as SQL, NULL if nothing, by the number of the cell.

    A cell has the number of its rule, and that of a parent's key as much more as there are rules. Only failing rows speak
    for not-null and accepted-values rules. The keys of a relationship come from both tables.
    """
    out = {}
    for number, rule in numbered:
        column = rule.column
        if rule.table == table:
            listed = ", ".join(_quoted(_text_of(v)) for v in rule.values)
            text = f"CAST({column} AS STRING)"
            speaks = {NOT_NULL: f"IF(({column}) IS NULL, '', NULL)", ACCEPTED: f"IF({text} NOT IN ({listed}), {text}, NULL)"}
            out[number] = speaks.get(rule.kind, text)
        if rule.kind == RELATED and rule.parent == table:
            out[number + len(numbered)] = f"CAST({rule.parent_column} AS STRING)"
    return out


# What the values of a rule, with ``n`` rows each and ``held`` by a parent or not, come to as failures.
_FAILURES = {NOT_NULL: "sum(n)", RELATED: "sum(IF(held, 0, n))", UNIQUE: "count_if(n > 1)", ACCEPTED: "count(1)"}


def evaluate(rules: Sequence[Rule], tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per rule: table, rule, column, argument, severity, failures, status.

    Every table is read once, whatever the number of its rules, and the values of all rules are counted in one shuffle;
    copies of a value combine before it. The two columns of a relationship have one type. Cells are columns that are
    unpivoted, not an array to be exploded: Spark compiles the one and interprets the other for every row.
    """
    numbered = list(enumerate(rules))
    parts = []
    for name in dict.fromkeys([r.table for r in rules] + [r.parent for r in rules if r.parent]):
        cells = tables[name].selectExpr(*[f"{text} AS `{number}`" for number, text in _cells(name, numbered).items()])
        said = cells.unpivot([], cells.columns, "cell", "value").where("value IS NOT NULL")
        parts.append(said.selectExpr("CAST(cell AS INT) AS cell", "value"))
    number = f"cell % {len(rules)}"
    counted = union_all(parts).groupBy(F.expr(number).alias("rule"), "value").agg(
        F.expr(f"count_if(cell < {len(rules)})").alias("n"), F.expr(f"bool_or(cell >= {len(rules)})").alias("held")
    )
    counts = counted.groupBy("rule").agg(*[F.expr(text).alias(kind) for kind, text in _FAILURES.items()])

    labels = local_table(
        next(iter(tables.values())).sparkSession,
        {
            "rule": range(len(rules)),
            "table_name": [r.table for r in rules],
            "rule_name": [r.kind for r in rules],
            "column_name": [r.column for r in rules],
            "argument": [", ".join(map(_text_of, r.values)) or r.parent for r in rules],
            "severity": [r.severity for r in rules],
        },
    )
    failures = F.coalesce(*[F.when(F.col("rule_name") == kind, F.col(kind)) for kind in _FAILURES], F.lit(0))
    status = F.when(failures == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
    # A table without any value yields no count for its value rules; such a rule has no failures.
    return labels.join(counts, "rule", "left").select(
        "table_name",
        "rule_name",
        "column_name",
        "argument",
        "severity",
        failures.alias("failures"),
        status.alias("status"),
    )
