"""Time splits: the last weeks as a test set, and blocked folds with an expanding history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygalley.forecast.preparation import COMBINATION, LEVELS, pick_level
from skygalley.functions import ratio
from skygalley.operators.joins import join_null_safe


def cutoff(df: DataFrame, weeks: int) -> Column:
    """Last day of the training part, as a scalar subquery of whatever plan uses it."""
    return F.date_sub(df.agg(F.max("date")).scalar(), 7 * weeks)


def train_part(df: DataFrame, weeks: int) -> DataFrame:
    return df.where(F.col("date") <= cutoff(df, weeks))


def test_part(df: DataFrame, weeks: int) -> DataFrame:
    return df.where(F.col("date") > cutoff(df, weeks))


def with_blocks(df: DataFrame, days: int) -> DataFrame:
    """Number the blocks of ``days`` days from the first date on."""
    first = df.agg(F.min("date")).scalar()
    return df.withColumn("block", F.floor(F.datediff("date", first) / days).cast("int"))


def with_folds(df: DataFrame, days: int = 14) -> DataFrame:
    """Add ``block`` and ``fold_num``. The first block only trains, so it has no fold.

    Folds count existing blocks. A block that would start on the very last day is no fold.
    """
    blocks = with_blocks(df, days)
    span = df.agg(F.datediff(F.max("date"), F.min("date"))).scalar()
    # A handful of rows, one per block of the period: the window without a partition is safe here.
    numbers = (
        blocks.where((F.col("block") >= 1) & (F.col("block") * days < span))
        .select("block")
        .distinct()
        .withColumn("fold_num", F.row_number().over(Window.orderBy("block")))
    )
    return blocks.join(numbers, "block", "left")


def fold_sizes(folded: DataFrame) -> DataFrame:
    """Per fold: the period and size of its validation block and of the history before it."""
    blocks = folded.groupBy("block", "fold_num").agg(
        F.count(F.lit(1)).alias("val_size"),
        F.min("date").alias("val_first"),
        F.max("date").alias("val_last"),
    )
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocks.withColumn("train_size", F.sum("val_size").over(before))
        .withColumn("train_last", F.max("val_last").over(before))
        .where("fold_num is not null")
        .select("fold_num", "train_size", "train_last", "val_first", "val_last", "val_size")
    )


def expanding_hist_avg(
    folded: DataFrame, min_samples: int = 5, target: str = "sold_quantity"
) -> DataFrame:
    """Historical averages of the validation rows from *earlier blocks only*, three levels deep.

    One grouping by block and combination; each level is a running sum over earlier blocks of that
    small table. No self join and no fold is computed on its own.
    """
    parts = folded.groupBy("block", *COMBINATION).agg(
        F.sum(target).alias("total"), F.count(target).alias("n")
    )
    values = []
    for keys in LEVELS[:3]:
        window = (
            Window.partitionBy(*keys).orderBy("block").rangeBetween(Window.unboundedPreceding, -1)
        )
        complete = ~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
        values.append(
            (F.when(complete, F.sum("total").over(window)), F.when(complete, F.sum("n").over(window)))
        )
    side = parts.select("block", *COMBINATION, *pick_level(values, min_samples, fallback=False))
    rows = folded.where("fold_num is not null").drop("hist_avg", "hist_level_used")
    return join_null_safe(rows, side, ["block", *COMBINATION])


def fold_coverage(validated: DataFrame) -> DataFrame:
    """Share of rows with an average, and rows per level, for each fold."""
    at = [F.count(F.when(F.col("hist_level_used") == i, 1)).alias(f"level_{i}") for i in (1, 2, 3)]
    return validated.groupBy("fold_num").agg(
        (100 * ratio(F.count("hist_avg"), F.count(F.lit(1)))).alias("coverage_pct"), *at
    )
