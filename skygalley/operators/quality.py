"""Data-quality rules as Spark aggregates: one row per rule with its number of failures.

All row-level rules of a table share one pass. Uniqueness and foreign keys group before they count,
so a key with a third of all rows is combined inside each task first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str
    where: str | None = None


@dataclass(frozen=True)
class Unique:
    """No value twice. One column: nulls are ignored. Several: a null part counts as a value.

    ``combination``: a single column is treated as several are.
    """

    table: str
    columns: tuple[str, ...]
    combination: bool = False

    @property
    def single(self) -> bool:
        return len(self.columns) == 1 and not self.combination


@dataclass(frozen=True)
class Relationship:
    table: str
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Accepted:
    """Failures are the distinct unwanted values."""

    table: str
    column: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class Expression:
    """The predicate must not be false; an unknown result passes."""

    table: str
    predicate: str


@dataclass(frozen=True)
class NoRows:
    """No row may satisfy the condition."""

    table: str
    name: str
    condition: str


Rule = NotNull | Unique | Relationship | Accepted | Expression | NoRows


def label(rule: Rule) -> tuple[str, str]:
    """Kind of a rule, and what it is about."""
    if isinstance(rule, NotNull):
        return "not_null", rule.column
    if isinstance(rule, Unique):
        return ("unique" if rule.single else "unique_combination"), ",".join(rule.columns)
    if isinstance(rule, Relationship):
        return "relationship", f"{rule.column}->{rule.parent}.{rule.parent_column}"
    if isinstance(rule, Accepted):
        return "accepted_values", rule.column
    if isinstance(rule, Expression):
        return "expression", rule.predicate
    return "no_rows", rule.name


def _row_failure(rule: Rule) -> Column | None:
    """Condition that a failing row meets, for rules that look at one row at a time."""
    if isinstance(rule, NotNull):
        bad = F.col(rule.column).isNull()
        return bad & F.expr(rule.where) if rule.where else bad
    if isinstance(rule, Expression):
        return ~F.expr(rule.predicate)
    if isinstance(rule, NoRows):
        return F.expr(rule.condition)
    return None


def _report(df: DataFrame, rule: Rule) -> DataFrame:
    kind, about = label(rule)
    return df.select(
        F.lit(rule.table).alias("table_name"),
        F.lit(kind).alias("rule"),
        F.lit(about).alias("subject"),
        F.col("failures").cast("bigint").alias("failures"),
    )


def _row_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All row-level rules of one table in a single aggregate, turned into one row per rule."""
    counts = [
        F.count(F.when(_row_failure(rule), F.lit(1))).alias(f"c{i}") for i, rule in enumerate(rules)
    ]
    entries = [
        F.struct(
            F.lit(rule.table).alias("table_name"),
            F.lit(label(rule)[0]).alias("rule"),
            F.lit(label(rule)[1]).alias("subject"),
            F.col(f"c{i}").alias("failures"),
        )
        for i, rule in enumerate(rules)
    ]
    return df.agg(*counts).select(F.inline(F.array(*entries)))


# Types that text tells apart exactly as equality does.
_TEXT_LIKE = (T.StringType, T.IntegralType, T.DecimalType, T.DateType, T.BooleanType)


def _short_key(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """What to group a combination by: the 16 bytes of an md5, as the surrogate keys of the tables are, over its lengths and
    values; a missing part is a value of its own. Short numbers alone, and types that text does not tell apart, stay as they are.
    """
    types = [df.schema[c].dataType for c in columns]
    if not any(isinstance(t, T.StringType) for t in types) or not all(isinstance(t, _TEXT_LIKE) for t in types):
        return [F.col(c) for c in columns]
    parts = []
    for c in columns:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return [F.unhex(F.md5(F.concat(*parts).cast("binary"))).alias("_key")]


def _unique(df: DataFrame, rule: Unique) -> DataFrame:
    if rule.single:
        df = df.where(F.col(rule.columns[0]).isNotNull())
        keys = [F.col(rule.columns[0])]
    else:
        keys = _short_key(df, rule.columns)
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _report(copies.agg(F.count(F.lit(1)).alias("failures")), rule)


def _relationship(df: DataFrame, parent: DataFrame, rule: Relationship) -> DataFrame:
    """Counted per value first: the join sees each value once however many rows hold it."""
    values = df.where(F.col(rule.column).isNotNull()).groupBy(F.col(rule.column).alias("v"))
    values = values.agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(rule.parent_column).alias("v"))
    orphans = values.join(known, "v", "left_anti")
    return _report(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures")), rule)


def _accepted(df: DataFrame, rule: Accepted) -> DataFrame:
    unwanted = df.select(rule.column).where(~F.col(rule.column).isin(*rule.values)).distinct()
    return _report(unwanted.agg(F.count(F.lit(1)).alias("failures")), rule)


def check_rules(tables: Callable[[str], DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """Failures of every rule as (table_name, rule, subject, failures), lazily."""
    frames: list[DataFrame] = []
    by_table: dict[str, list[Rule]] = {}
    for rule in rules:
        if _row_failure(rule) is not None:
            by_table.setdefault(rule.table, []).append(rule)
        elif isinstance(rule, Unique):
            frames.append(_unique(tables(rule.table), rule))
        elif isinstance(rule, Relationship):
            frames.append(_relationship(tables(rule.table), tables(rule.parent), rule))
        else:
            frames.append(_accepted(tables(rule.table), rule))
    frames = [_row_rules(tables(t), row_rules) for t, row_rules in by_table.items()] + frames
    return reduce(DataFrame.unionByName, frames)


def failing_rows(df: DataFrame, rule: NotNull | Expression | NoRows) -> DataFrame:
    """The rows that break a row-level rule."""
    return df.where(_row_failure(rule))
