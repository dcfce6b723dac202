from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_group_max(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """The maximum of a whole group on each of its rows.

    The maximum is combined inside each task and joined back: unlike a window over the group, no
    task has to hold a hot group.
    """
    top = df.groupBy(*keys).agg(F.max(column).alias("_max"))
    top = top.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_max")
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    joined = df.join(top, same, "left").drop(*[f"_k_{k}" for k in keys])
    return joined.withColumn(out, F.col("_max")).drop("_max")


def with_sequence(
    df: DataFrame, keys: Sequence[str], first: str, then: Sequence[str | Column], out: str
) -> DataFrame:
    """Number the rows of each group, ordered by ``first`` and then by ``then``.

    Groups are split by the values of ``first``: rows are numbered inside a value, and the number of
    rows before that value comes from a running sum over counts. ``first`` must not be null.
    """
    parts = [*keys, first]
    counts = df.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*parts, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*parts).orderBy(*then))
    numbered = df.withColumn(out, inside).join(offsets, parts)
    return numbered.withColumn(out, (F.col(out) + F.col("_before")).cast("int")).drop("_before")
