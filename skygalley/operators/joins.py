from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygalley.config import UNKNOWN
from skygalley.operators.cleaning import first_per_key


def with_lookup(
    df: DataFrame,
    key: Column,
    lookup: DataFrame,
    lookup_key: str,
    lookup_value: str,
    out: str,
    default: str = UNKNOWN,
) -> DataFrame:
    """Add the looked-up value, or a default where the key has none.

    No broadcast hint: Spark broadcasts the lookup while its measured size allows it and falls back
    to a shuffled join beyond that.
    """
    side = lookup.select(F.col(lookup_key).alias("_key"), F.col(lookup_value).alias("_value"))
    joined = df.withColumn("_wanted", key).join(side, F.col("_wanted") == F.col("_key"), "left")
    return joined.withColumn(out, F.coalesce("_value", F.lit(default))).drop(
        "_wanted", "_key", "_value"
    )


def only_in_left(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``; a missing part equals a missing part."""
    side = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(side, match, "left_anti")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi join where a missing key part matches a missing key part; the key appears once."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, match, how).drop(*[f"_r_{k}" for k in keys])


def map_key(
    df: DataFrame, dim: DataFrame, dim_key: str, dim_value: str, out: str, on: str | None = None
) -> DataFrame:
    """Replace a natural key by the key of a dimension; null where the dimension has no row.

    The dimension must hold each natural key once. A missing key matches nothing, so rows without one are dealt by a number
    of their own, and payments without a card, however many, never meet in one task. Natural keys are compared as text.
    """
    side = dim.select(F.col(dim_key).cast("string").alias("_key"), F.col(dim_value).alias(out))
    own = F.concat(F.lit("\0"), F.monotonically_increasing_id().cast("string"))
    keyed = df.withColumn("_wanted", F.coalesce(F.col(on or dim_key).cast("string"), own))
    return keyed.join(side, F.col("_wanted") == F.col("_key"), "left").drop("_wanted", "_key")


def fill_from_first(
    df: DataFrame, source: DataFrame, keys: Sequence[str], value: str, order: Sequence[Column]
) -> DataFrame:
    """Add ``value`` of the first ``source`` row per key."""
    first = first_per_key(source.select(*keys, value), keys, order)
    return df.join(first, list(keys), "left")
