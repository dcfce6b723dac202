"""Feature points: distinct features with a weight, and categories as smoothed means that are joined to them.

Rows that agree in every feature and in the label are one row with a weight, so a model sees each combination once, however
many flights share it. Category values are numbers by a grouped table of means; no list of values is held on the driver.

Trees compare values with a few thresholds only, so points between the same thresholds with the same label are one cell with
their weight (``fit_cells``). A fit passes over its rows for every level of every tree: over cells, whose number the thresholds
bound, not over the points.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygalley.config import ForecastConfig
from skygalley.operators.joins import join_null_safe
from skygalley.session import new_table_root
from skygalley.sources.sinks import overwrite

# Below every real average: rows without history form the lowest group, as in the published model.
NO_HISTORY = -1.0
# One more row of a category is weighed like this many rows of the overall mean.
SMOOTHING = 1.0
# Points of one task while fitting: a job per level of each tree pays for every task, so once all cores are busy tasks
# grow, up to as many points as an executor holds with ease.
TASK_POINTS = 20_000
MOST_TASK_POINTS = 200_000


def feature_columns(cfg: ForecastConfig) -> list[str]:
    return [*cfg.categorical, *cfg.numerical]


def weighted_points(rows: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """One row per distinct combination of ``columns`` and label, with the number of rows it stands for."""
    return rows.groupBy(*columns, label).agg(F.count(F.lit(1)).cast("double").alias("weight"))


@dataclass(frozen=True)
class CategoryMeans:
    """Mean label of every category value, drawn to the overall mean where a value has few rows.

    ``table`` has (feature, value, mean), and the overall mean under feature ``*``, which unknown values get.
    """

    table: DataFrame

    @staticmethod
    def fit(points: DataFrame, categorical: Sequence[str], label: str, path: str) -> CategoryMeans:
        total, rows = F.sum(F.col(label) * F.col("weight")), F.sum("weight")
        parts = [
            points.groupBy(F.col(c).cast("string").alias("value")).agg(total.alias("total"), rows.alias("n")).select(
                F.lit(c).alias("feature"), "value", "total", "n"
            )
            for c in categorical
        ]
        every = points.agg(F.coalesce(total / rows, F.lit(0.0)).alias("mean"))
        sums = reduce(DataFrame.unionByName, parts)
        smoothed = (F.col("total") + SMOOTHING * every.scalar()) / (F.col("n") + SMOOTHING)
        table = sums.select("feature", "value", smoothed.alias("mean")).unionByName(
            every.select(F.lit("*").alias("feature"), F.lit(None).cast("string").alias("value"), "mean")
        )
        return CategoryMeans(overwrite(table, path))

    def join(self, points: DataFrame, categorical: Sequence[str]) -> DataFrame:
        """Add ``<c>_mean`` for every category; a null value has a mean of its own, an unknown one the overall mean."""
        overall = self.table.where("feature = '*'").select("mean").scalar()
        out = points
        for c in categorical:
            side = self.table.where(F.col("feature") == c).select(F.col("value").alias(c), F.col("mean").alias(f"{c}_mean"))
            out = join_null_safe(out, side, [c])
            out = out.withColumn(f"{c}_mean", F.coalesce(f"{c}_mean", overall))
        return out


def _number(c: str) -> Column:
    return F.coalesce(F.col(c).cast("double"), F.lit(NO_HISTORY))


def number_columns(cfg: ForecastConfig) -> list[str]:
    return [*[f"{c}_mean" for c in cfg.categorical], *[f"{c}_num" for c in cfg.numerical]]


def with_numbers(points: DataFrame, means: CategoryMeans, cfg: ForecastConfig) -> DataFrame:
    """Add the means of the categories and the numbers, under ``number_columns``."""
    out = means.join(points, cfg.categorical)
    return out.select("*", *[_number(c).alias(f"{c}_num") for c in cfg.numerical])


def with_vector(points: DataFrame, means: CategoryMeans, cfg: ForecastConfig) -> DataFrame:
    """Add ``features``: the means of the categories, then the numbers."""
    inputs = number_columns(cfg)
    out = with_numbers(points, means, cfg)
    return VectorAssembler(inputCols=inputs, outputCol="features").transform(out).drop(*inputs)


def fit_tasks(points: int, cores: int) -> int:
    """Tasks to deal the points of a fit over."""
    return max(1, min(-(-points // TASK_POINTS), max(cores, -(-points // MOST_TASK_POINTS))))


def _dealt(stored: DataFrame, path: str) -> DataFrame:
    tasks = fit_tasks(stored.count(), stored.sparkSession.sparkContext.defaultParallelism)
    return overwrite(stored.repartition(tasks), path)


def encode_points(points: DataFrame, means: CategoryMeans, cfg: ForecastConfig, columns: Sequence[str]) -> DataFrame:
    """Points as a written table of few, even files: a fit reads it hundreds of times, and each task costs its start."""
    root = new_table_root(points.sparkSession)
    stored = overwrite(with_vector(points, means, cfg).select("features", *columns), f"{root}/points")
    return _dealt(stored, f"{root}/dealt_points")


# --- cells --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Bins:
    """The thresholds that trees choose from, per feature in the order of ``feature_columns``.

    A value's bin is the number of thresholds below it. A tree that asks whether a value is at most the k-th threshold asks
    whether its bin is less than k, so trees over bins are the trees over values.
    """

    thresholds: tuple[tuple[float, ...], ...]

    @staticmethod
    def find(data: DataFrame, estimator) -> Bins:
        """Those that the estimator would find itself on ``features`` and weights: Spark's own split finder, asked alone."""
        java, jvm = _java_params(estimator), data.sparkSession._jvm
        none, empty = _scala(jvm.scala, "None"), _scala(jvm.scala.collection.immutable, "Map").empty()
        points = _scala(jvm.org.apache.spark.ml.util, "DatasetUtils").extractInstances(java, data._jdf, none)
        algo = jvm.org.apache.spark.mllib.tree.configuration.Algo.Regression()  # every tree of a boosted fit is one
        strategy = java.getOldBoostingStrategy(empty, algo).treeStrategy()
        impl = jvm.org.apache.spark.ml.tree.impl
        metadata = impl.DecisionTreeMetadata.buildMetadata(points, strategy, 1, estimator.getFeatureSubsetStrategy())
        found = _scala(impl, "RandomForest").findSplits(points, metadata, estimator.getSeed())
        return Bins(tuple(tuple(split.threshold() for split in feature) for feature in found))

    def add(self, df: DataFrame, cfg: ForecastConfig, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
        """Add a bin for each feature of ``columns``, which names the column it is in and the one its bin goes to."""
        at = {f: self.thresholds[i] for i, f in enumerate(feature_columns(cfg)) if f in columns}
        cut = [f for f in columns if at[f]]
        out = df
        if cut:
            # a bucket holds its lower end but not its upper one, so a threshold itself lies below the cut
            cuts = [[-math.inf, *[math.nextafter(t, math.inf) for t in at[f]], math.inf] for f in cut]
            found, into = [columns[f][0] for f in cut], [f"{columns[f][1]}_bucket" for f in cut]
            buckets = Bucketizer(splitsArray=cuts, inputCols=found, outputCols=into, handleInvalid="keep")
            out = buckets.transform(df)
        # what is no number lies in the last bin, as trees have it; a new column, which is no category to the trees
        bins = [
            (F.least(F.col(f"{to}_bucket"), F.lit(float(len(at[f])))) if f in cut else F.lit(0.0)).alias(to)
            for f, (_, to) in columns.items()
        ]
        return out.select(*df.columns, *bins)

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, k, t) for i, feature in enumerate(self.thresholds) for k, t in enumerate([math.nan, *feature])]
        overwrite(spark.createDataFrame(rows, "feature int, position int, threshold double").coalesce(1), path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Bins:
        found: dict[int, list[tuple]] = {}
        for r in spark.read.parquet(path).collect():  # tens of rows a feature
            found.setdefault(r.feature, []).append((r.position, r.threshold))
        return Bins(tuple(tuple(t for k, t in sorted(found[i]) if k) for i in sorted(found)))


def _scala(package, name: str):
    """A Scala object of a package of the JVM."""
    return getattr(getattr(package, f"{name}$"), "MODULE$")


def _java_params(estimator):
    estimator._transfer_params_to_java()
    return estimator._java_obj


def bin_columns(cfg: ForecastConfig, prefix: str = "") -> list[str]:
    return [f"{prefix}{c}_bin" for c in feature_columns(cfg)]


def with_bins(
    df: DataFrame, means: CategoryMeans, bins: Bins, cfg: ForecastConfig, features: Sequence[str], prefix: str = ""
) -> DataFrame:
    """Add the bins of the named features as ``<prefix><feature>_bin``."""
    inputs = {f: n for f, n in zip(feature_columns(cfg), number_columns(cfg)) if f in features}
    out = means.join(df, [c for c in cfg.categorical if c in features])
    out = out.select("*", *[_number(c).alias(inputs[c]) for c in cfg.numerical if c in features])
    out = bins.add(out, cfg, {f: (n, f"{prefix}{f}_bin") for f, n in inputs.items()})
    return out.drop(*inputs.values())


def with_bin_vector(df: DataFrame, cfg: ForecastConfig, prefix: str = "") -> DataFrame:
    """Add ``features`` out of bins that are there."""
    return VectorAssembler(inputCols=bin_columns(cfg, prefix), outputCol="features").transform(df)


def split_points(points: DataFrame, means: CategoryMeans, cfg: ForecastConfig, columns: Sequence[str]) -> DataFrame:
    """Encoded points as a written table for a pass or two: up to ``MOST_TASK_POINTS`` dealt as for a fit, as a sample of the
    rows in their order gives the thresholds; more stay as they were written."""
    root = new_table_root(points.sparkSession)
    stored = overwrite(with_vector(points, means, cfg).select("features", *columns), f"{root}/points")
    return _dealt(stored, f"{root}/dealt_points") if stored.count() <= MOST_TASK_POINTS else stored


def cells(encoded: DataFrame, bins: Bins, cfg: ForecastConfig, label: str) -> DataFrame:
    """Rows (bins, label, weight): one per combination of bins and label, with the weight of all its points, for ``fit_cells``."""
    names = feature_columns(cfg)
    values = vector_to_array("features")
    rows = encoded.select(label, "weight", values.alias("_values"))
    rows = rows.select(label, "weight", *[F.col("_values")[i].alias(f"{c}_num") for i, c in enumerate(names)])
    rows = bins.add(rows, cfg, {c: (f"{c}_num", f"{c}_bin") for c in names})
    return rows.groupBy(*bin_columns(cfg), label).agg(F.sum("weight").alias("weight"))


def fit_cells(rows: DataFrame, cfg: ForecastConfig, label: str) -> DataFrame:
    """Cells as a written table of few, even files with ``features``: a fit reads it hundreds of times."""
    root = new_table_root(rows.sparkSession)
    dealt = _dealt(overwrite(rows, f"{root}/cells"), f"{root}/dealt_cells")
    return with_bin_vector(dealt, cfg).select("features", label, "weight")
