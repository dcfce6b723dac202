"""Exploratory statistics, each one aggregate over the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skygalley.functions import half_even, ratio

PERCENTILES = (0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)

# Ranges that the distinct values are dealt over, a power of two; each is numbered by itself.
RANGES = 256


def _rows(one_row: DataFrame, entries: Sequence[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*entries)))


def summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Type, missing values and distinct values of each column.

    Each column is grouped on its own: counting many columns' distinct values in one aggregate
    would copy every row once per column.
    """
    types = dict(df.dtypes)
    out = None
    for c in columns or df.columns:
        values = df.groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        one = values.agg(
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("v").alias("distinct_values"),
        ).select(
            F.lit(c).alias("column_name"), F.lit(types[c]).alias("type"), "nulls", "distinct_values"
        )
        out = one if out is None else out.unionByName(one)
    return out


def _value_counts(df: DataFrame, columns: Sequence[str], **counts: Column) -> DataFrame:
    """Rows (c, value, and the counts named) for each distinct value of each column; c is the column's place.

    One scan for all columns: a row is copied per column, but equal values are summed inside each task first.
    """
    extra = list(counts)
    marks = [condition.alias(f"_{e}") for e, condition in counts.items()]
    rows = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)], *marks)
    entries = [
        F.struct(F.lit(i).alias("c"), F.col(f"_{i}").alias("value"), *[F.col(f"_{e}").alias(e) for e in extra])
        for i in range(len(columns))
    ]
    rows = rows.select(F.inline(F.array(*entries)))
    sums = [F.count(F.when(F.col(e), F.lit(1))).alias(e) for e in extra]
    return rows.where("value is not null").groupBy("c", "value").agg(*sums)


def _place(borders: Column, value: Column) -> Column:
    """The number of sorted borders below a value, by halving steps: eight looks at 255 borders."""
    steps = F.array(*[F.lit(RANGES >> i) for i in range(1, RANGES.bit_length())])
    return F.reduce(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.element_at(borders, at + step) < value, at + step).otherwise(at),
    )


def _ranked(counts: DataFrame, n: str) -> DataFrame:
    """Adds ``before``, the sum of ``n`` over smaller values of the same column, and ``total``, its sum over all.

    Values are dealt over ranges of about equally many distinct values, whose borders come from a sketch of fixed
    size. Counts are summed up within each range, and once over the ranges, so no task or driver holds all values.
    The borders only deal; the result is exact. What is broadcast is bounded by the number of columns: a row of
    255 borders each, and a row per range.
    """
    inner = F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)])
    borders = counts.groupBy("c").agg(F.approx_percentile("value", inner, 10 * RANGES).alias("borders"))
    dealt = counts.join(F.broadcast(borders), "c")
    dealt = dealt.withColumn("range", _place(F.col("borders"), F.col("value"))).drop("borders")
    # at most RANGES rows a column: these windows are small by construction
    sizes = dealt.groupBy("c", "range").agg(F.sum(n).alias("size"))
    earlier = F.sum("size").over(Window.partitionBy("c").orderBy("range")) - F.col("size")
    total = F.sum("size").over(Window.partitionBy("c"))
    sizes = sizes.select("c", "range", earlier.alias("earlier"), total.alias("total"))
    inside = F.sum(n).over(Window.partitionBy("c", "range").orderBy("value")) - F.col(n)
    ranked = dealt.withColumn("inside", inside).join(F.broadcast(sizes), ["c", "range"])
    return ranked.withColumn("before", F.col("earlier") + F.col("inside")).drop("earlier", "inside", "range")


def percentiles(df: DataFrame, columns: Sequence[str], points: Sequence[float]) -> DataFrame:
    """One row per column that has values: its place ``c`` and the array ``q`` of exact, interpolated quantiles."""
    ranked = _ranked(_value_counts(df, columns, n=F.lit(True)), "n")
    picks, values = [], []
    for i, p in enumerate(points):
        at = F.lit(p) * (F.col("total") - 1)
        for end, rank in (("low", F.floor(at)), ("high", F.ceil(at))):
            hit = (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))
            picks.append(F.max(F.when(hit, F.col("value"))).alias(f"{end}{i}"))
        picks.append(F.max(at - F.floor(at)).alias(f"share{i}"))
        low, high, share = F.col(f"low{i}"), F.col(f"high{i}"), F.col(f"share{i}")
        values.append(low * (1 - share) + high * share)
    return ranked.groupBy("c").agg(*picks).select("c", F.array(*values).alias("q"))


def _by_column(found: DataFrame) -> Column:
    """The quantiles of all columns as one map, place to array; it has a row per stated column."""
    return found.agg(F.map_from_entries(F.collect_list(F.struct("c", "q")))).scalar()


def _percentiles(df: DataFrame, column: str, points: Sequence[float]) -> DataFrame:
    """One row with the array ``q``; its entries are null without values."""
    none = F.array(*[F.lit(None).cast("double") for _ in points])
    return percentiles(df, [column], points).agg(F.coalesce(F.first("q"), none).alias("q"))


def auc(df: DataFrame, score: str, positive: Column) -> DataFrame:
    """One row ``auc``: the share of pairs (positive, other) that the score ranks right, ties counting half.

    Exact over all distinct scores. Rows without a score take no part; null where either kind is missing.
    """
    counts = _value_counts(
        df, [score], pos=F.coalesce(positive, F.lit(False)), neg=~F.coalesce(positive, F.lit(False))
    )
    pos, neg, before = (F.col(c).cast("double") for c in ("pos", "neg", "before"))
    right = F.sum(pos * (before + neg / 2))
    return _ranked(counts, "neg").agg(ratio(right, F.sum(pos) * F.sum(neg)).alias("auc"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles (interpolated) of each numeric column."""
    quartiles = _by_column(percentiles(df, columns, (0.25, 0.5, 0.75)))
    aggs, entries = [], []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [
            F.count(c).alias(f"{c}_n"),
            F.avg(x).alias(f"{c}_mean"),
            F.stddev_samp(x).alias(f"{c}_std"),
            F.min(x).alias(f"{c}_min"),
            F.max(x).alias(f"{c}_max"),
        ]
        own = F.try_element_at(F.col("quartiles"), F.lit(i))
        entries.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"{c}_n").alias("n"),
                F.col(f"{c}_mean").alias("mean"),
                F.col(f"{c}_std").alias("std"),
                F.col(f"{c}_min").alias("min"),
                own[0].alias("q25"),
                own[1].alias("median"),
                own[2].alias("q75"),
                F.col(f"{c}_max").alias("max"),
            )
        )
    return _rows(df.agg(*aggs).withColumn("quartiles", quartiles), entries)


def skewness(column: str) -> Column:
    """Bias-corrected skewness; null under three values."""
    n = F.count(column).cast("double")
    raw = F.skewness(F.col(column).cast("double"))
    return F.when(n > 2, raw * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))


def kurtosis(column: str) -> Column:
    """Bias-corrected excess kurtosis; null under four values."""
    n = F.count(column).cast("double")
    raw = F.kurtosis(F.col(column).cast("double"))
    below = F.nullif((n - 2) * (n - 3), F.lit(0.0))
    return F.when(n > 3, ((n + 1) * raw + 6) * (n - 1) / below)


def shape(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    aggs, entries = [], []
    for c in columns:
        aggs += [skewness(c).alias(f"{c}_s"), kurtosis(c).alias(f"{c}_k")]
        entries.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"{c}_s").alias("skewness"),
                F.col(f"{c}_k").alias("kurtosis"),
            )
        )
    return _rows(df.agg(*aggs), entries)


def quantiles(df: DataFrame, column: str, points: Sequence[float] = PERCENTILES) -> DataFrame:
    """Exact, interpolated quantiles, one row each."""
    one = _percentiles(df, column, points)
    entries = [
        F.struct(F.lit(p).alias("point"), F.col("q")[i].alias("value")) for i, p in enumerate(points)
    ]
    return _rows(one, entries)


def iqr_bounds(df: DataFrame, column: str) -> DataFrame:
    one = _percentiles(df, column, (0.25, 0.75))
    spread = F.col("q")[1] - F.col("q")[0]
    return one.select(
        (F.col("q")[0] - 1.5 * spread).alias("lower"), (F.col("q")[1] + 1.5 * spread).alias("upper")
    )


def outliers(df: DataFrame, column: str) -> DataFrame:
    """Rows outside the bounds; the bounds are scalar subqueries of the same plan."""
    bounds = iqr_bounds(df, column)
    low, high = bounds.select("lower").scalar(), bounds.select("upper").scalar()
    return df.where((F.col(column) < low) | (F.col(column) > high))


def outlier_share(df: DataFrame, column: str) -> DataFrame:
    bounds = iqr_bounds(df, column)
    low, high = bounds.select("lower").scalar(), bounds.select("upper").scalar()
    out = (F.col(column) < low) | (F.col(column) > high)
    return (
        df.agg(F.count(F.when(out, F.lit(1))).alias("outliers"), F.count(F.lit(1)).alias("n"))
        .withColumn("share", ratio(F.col("outliers"), F.col("n")))
        .withColumn("lower", low)
        .withColumn("upper", high)
    )


def zero_share(df: DataFrame, column: str) -> DataFrame:
    zero, positive = F.col(column) == 0, F.col(column) > 0
    one = df.agg(
        F.count(F.when(zero, F.lit(1))).alias("zeros"),
        F.count(F.when(positive, F.lit(1))).alias("non_zeros"),
        F.count(F.lit(1)).alias("n"),
    )
    return one.select(
        "zeros",
        "non_zeros",
        ratio(F.col("zeros"), F.col("n")).alias("zero_share"),
        ratio(F.col("non_zeros"), F.col("n")).alias("non_zero_share"),
    )


def correlations(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of each column with the target, over rows where both are present."""
    y = F.col(target).cast("double")
    one = df.agg(*[F.corr(F.col(c).cast("double"), y).alias(c) for c in columns])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("correlation")) for c in columns]
    return _rows(one, entries)


def group_stats(df: DataFrame, key: str | Column, target: str, name: str) -> DataFrame:
    """Mean (rounded), sum and count of the target per group; rows without a group drop out."""
    column = F.col(key) if isinstance(key, str) else key
    groups = df.where(column.isNotNull()).groupBy(column.alias(name))
    total, n = F.sum(target), F.count(target)
    return groups.agg(
        half_even(ratio(total, n), 2).alias("mean"), total.alias("total"), n.alias("observations")
    )


def flight_rank(df: DataFrame, place: Column, name: str, target: str, rows: int = 10) -> DataFrame:
    """The places with the largest total, with distinct flights and the average per flight.

    Flights are counted in two grouping steps: a hub on a third of all flights is spread by flight.
    """
    per_flight = df.where(place.isNotNull()).groupBy(place.alias(name), "flight_key")
    flights = per_flight.agg(F.sum(target).alias("total"))
    out = flights.groupBy(name).agg(
        F.sum("total").alias("total_qty"), F.count("flight_key").alias("num_flights")
    )
    mean = half_even(ratio(F.col("total_qty"), F.col("num_flights")), 2)
    return (
        out.select(name, mean.alias("avg_qty_per_flight"), "total_qty", "num_flights")
        .orderBy(F.desc("total_qty"), F.asc(name))
        .limit(rows)
    )


def level_coverage(df: DataFrame, levels: Sequence[Sequence[str]], enough: int) -> DataFrame:
    """Per level: its groups, those with too few samples, and the share with enough."""
    out = None
    for i, keys in enumerate(levels, start=1):
        groups = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("sold_quantity").alias("n"))
        few = F.count(F.when(F.col("n") < enough, F.lit(1)))
        one = groups.agg(F.count(F.lit(1)).alias("total_groups"), few.alias("groups_below")).select(
            F.lit(i).alias("level"),
            "total_groups",
            "groups_below",
            (100.0 - 100.0 * ratio(F.col("groups_below"), F.col("total_groups"))).alias("coverage_pct"),
        )
        out = one if out is None else out.unionByName(one)
    return out
