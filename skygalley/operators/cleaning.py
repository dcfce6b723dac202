from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns by name; absent names are ignored."""
    return df.drop(*names)


def required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in every listed column; separate tests, so that each reaches the scan."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def non_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows where every column is zero or more; a null is not, so it goes too."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c) >= 0 for c in columns]))


def date_window(df: DataFrame, start: str, end: str, column: str = "date") -> DataFrame:
    """Both ends included."""
    return df.where(F.col(column).between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def distinct_rows(df: DataFrame, deal: Sequence[str] | None = None) -> DataFrame:
    """Whole-row duplicates collapse inside each task first, so a hot group of copies is no hot task.

    With ``deal`` rows are dealt by these columns instead, and a grouping by them (or more) that follows needs no second shuffle.
    Copies then meet before they collapse: one task reads them all, though it holds but one.
    """
    return df.repartition(*deal).distinct() if deal else df.distinct()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in a stated order.

    ``row_number() = 1`` lets Spark keep one row per key inside each task before the shuffle
    (WindowGroupLimit), so a key with a third of all rows ships a row per task, not its rows.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def non_empty_columns(df: DataFrame) -> list[str]:
    """Columns that hold a value in some row; one pass counts them all."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if counts[c] > 0]


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that hold no value at all."""
    return df.select(*non_empty_columns(df))


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")
