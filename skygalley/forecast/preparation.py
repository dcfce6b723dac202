"""From the fresh-food mart to a checked feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygalley.config import ForecastConfig
from skygalley.errors import ValidationError
from skygalley.functions import bucket, half_even, ratio
from skygalley.operators.cleaning import drop_empty_rows, first_per_key, non_empty_columns
from skygalley.operators.joins import join_null_safe

GRAIN = ["flight_key", "item_id"]
# From the most specific level to the fallback.
LEVELS = (
    ("item_id", "route", "day_period"),
    ("item_id", "route", "is_night"),
    ("item_id", "day_period"),
    ("item_id",),
)
COMBINATION = ["item_id", "route", "day_period", "is_night"]
LOOKUP_KEY = ["item_id", "route", "day_period"]


def error_counts(df: DataFrame) -> DataFrame:
    """How often each error flag occurs."""
    flagged = df.where(F.col("potential_error").isNotNull())
    return flagged.groupBy("potential_error").agg(F.count(F.lit(1)).alias("n"))


def without_errors(df: DataFrame) -> DataFrame:
    """Rows without an error flag, once per flight and item.

    Copies of a flight and item may differ in nothing but what the order below states.
    """
    rest = [c for c in df.columns if c not in GRAIN]
    return first_per_key(
        df.where(F.col("potential_error").isNull()), GRAIN, [F.asc_nulls_last(c) for c in rest]
    )


def clean_data(df: DataFrame) -> DataFrame:
    """``without_errors``, then drop columns and rows that hold nothing; an empty result is an error."""
    df = without_errors(df)
    filled = non_empty_columns(df)
    if not filled:
        raise ValidationError("no rows are left after cleaning")
    return drop_empty_rows(df.select(*filled))


def pax_bin(passengers: Column, cfg: ForecastConfig, serving: bool = False) -> Column:
    """Passenger class. Training closes the intervals on the right, serving on the left."""
    return bucket(
        passengers, cfg.pax_edges, cfg.pax_labels, include_lowest=True, left_closed=serving
    )


def route() -> Column:
    return F.concat("origin", F.lit(" _ "), "destination")


def pick_level(values: Sequence[tuple[Column, Column]], min_samples: int, fallback: bool) -> list[Column]:
    """The first level with enough samples; with ``fallback`` the last level needs none."""
    average, level = F.lit(None).cast("double"), F.lit(None).cast("int")
    for i in range(len(values), 0, -1):
        total, n = values[i - 1]
        enough = n >= (0 if fallback and i == len(values) else min_samples)
        average = F.when(enough, ratio(total, n)).otherwise(average)
        level = F.when(enough, F.lit(i)).otherwise(level)
    return [average.alias("hist_avg"), level.alias("hist_level_used")]


def with_hist_avg(df: DataFrame, min_samples: int, target: str = "sold_quantity") -> DataFrame:
    """Add the historical average of the most specific level that has enough samples.

    The data is grouped once, to item x route x period x night; every level is a sum over that small
    table, and one join brings the answer back. A hot item is combined inside each task, and the
    join side is as small as the set of combinations. A level with a missing key part has no value.
    """
    combos = df.groupBy(*COMBINATION).agg(F.sum(target).alias("total"), F.count(target).alias("n"))
    values = []
    for keys in LEVELS:
        window = Window.partitionBy(*keys)
        complete = ~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
        values.append(
            (F.when(complete, F.sum("total").over(window)), F.when(complete, F.sum("n").over(window)))
        )
    average, level = pick_level(values, min_samples, fallback=True)
    side = combos.select(
        *COMBINATION, half_even(average, 2).alias("hist_avg"), level
    )
    return join_null_safe(df, side, COMBINATION)


def build_features(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    df = df.withColumn("pax_bin", pax_bin(F.col("number_of_passengers"), cfg))
    return with_hist_avg(df.withColumn("route", route()), cfg.min_samples, cfg.target)


def hist_lookup(features: DataFrame) -> DataFrame:
    """What serving needs: the average per item, route and day period."""
    rows = features.select(*LOOKUP_KEY, "hist_avg", "hist_level_used").distinct()
    return first_per_key(rows, LOOKUP_KEY, [F.col("hist_level_used"), F.col("hist_avg")])


def validate(df: DataFrame, cfg: ForecastConfig) -> None:
    """Raise at the first broken rule. All values are gathered in one pass."""
    missing = [c for c in cfg.required_columns if c not in df.columns]
    if missing:
        raise ValidationError(f"required columns are absent: {missing}")
    numeric = isinstance(df.schema[cfg.target].dataType, T.NumericType)
    level_ok = F.coalesce(F.col("hist_level_used").between(1, cfg.hist_levels), F.lit(False))
    found = df.agg(
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in cfg.required_columns],
        (F.count(F.when(F.col(cfg.target) < 0, 1)) if numeric else F.lit(0)).alias("negative"),
        F.count(F.when(F.col("hist_avg").isNull(), 1)).alias("no_average"),
        F.count(F.when(~level_ok, 1)).alias("bad_level"),
        F.min("date").cast("date").alias("first"),
        F.max("date").cast("date").alias("last"),
    ).first()
    nulls = {c: found[f"null_{c}"] for c in cfg.required_columns if found[f"null_{c}"]}
    if nulls:
        raise ValidationError(f"required columns hold missing values: {nulls}")
    if not numeric:
        raise ValidationError(f"the target {cfg.target} is no number")
    if found["negative"]:
        raise ValidationError(f"the target {cfg.target} falls below zero")
    if found["no_average"]:
        raise ValidationError("rows without a historical average")
    if found["bad_level"]:
        raise ValidationError(f"levels outside 1 to {cfg.hist_levels}")
    for day in (found["first"], found["last"]):
        if not cfg.start_date <= str(day) <= cfg.end_date:
            raise ValidationError(f"{day} is not within {cfg.start_date} to {cfg.end_date}")


def validation_report(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """The counts behind ``validate`` as one row, for data that should be looked at, not refused."""
    level_ok = F.coalesce(F.col("hist_level_used").between(1, cfg.hist_levels), F.lit(False))
    return df.agg(
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in cfg.required_columns],
        F.count(F.when(F.col(cfg.target) < 0, 1)).alias("negative_target"),
        F.count(F.when(F.col("hist_avg").isNull(), 1)).alias("no_average"),
        F.count(F.when(~level_ok, 1)).alias("bad_level"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )
