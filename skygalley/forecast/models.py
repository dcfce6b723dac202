"""Two-stage model on Spark ML: does the item sell at all, and if so how many.

Both stages are fitted on weighted feature points and stop early; both score distinct feature points only.
"""

from __future__ import annotations

import dataclasses
import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial, reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygalley.config import BoostingConfig, ForecastConfig
from skygalley.forecast import rounds
from skygalley.forecast.encoding import (
    Bins,
    CategoryMeans,
    bin_columns,
    cells,
    encode_points,
    feature_columns,
    fit_cells,
    split_points,
    weighted_points,
    with_bin_vector,
    with_bins,
    with_vector,
)
from skygalley.forecast.folds import cutoff, test_part, train_part
from skygalley.functions import floor_threshold, non_negative_int
from skygalley.operators.joins import join_null_safe
from skygalley.session import new_table_root
from skygalley.sources.sinks import overwrite


# Spark squares the number of bins as an int.
MOST_BINS = 46_340


@dataclass(frozen=True)
class StageModel:
    """Trees over the bins of encoded points, the means that encode the points, and the thresholds of the bins."""

    trees: GBTClassificationModel | GBTRegressionModel
    means: CategoryMeans
    bins: Bins

    def save(self, path: str) -> None:
        self.trees.write().overwrite().save(f"{path}/trees")
        overwrite(self.means.table, f"{path}/means")
        self.bins.save(self.means.table.sparkSession, f"{path}/bins")

    def with_bins(self, df: DataFrame, cfg: ForecastConfig, features: Sequence[str], prefix: str = "") -> DataFrame:
        return with_bins(df, self.means, self.bins, cfg, features, prefix)


@dataclass(frozen=True)
class TwoStageModel:
    classifier: StageModel
    regressor: StageModel

    def save(self, path: str) -> None:
        self.classifier.save(f"{path}/classifier")
        self.regressor.save(f"{path}/regressor")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TwoStageModel:
        kinds = {"classifier": GBTClassificationModel, "regressor": GBTRegressionModel}
        stages = {
            name: StageModel(
                kind.load(f"{path}/{name}/trees"),
                CategoryMeans(spark.read.parquet(f"{path}/{name}/means")),
                Bins.load(spark, f"{path}/{name}/bins"),
            )
            for name, kind in kinds.items()
        }
        return TwoStageModel(**stages)


def _boosting(kind: type, cfg: BoostingConfig, label: str):
    return kind(
        featuresCol="features",
        labelCol=label,
        weightCol="weight",
        maxIter=cfg.iterations,
        stepSize=cfg.learning_rate,
        maxDepth=cfg.depth,
        seed=cfg.random_seed,
        # cut the lineage of the growing ensemble in the shared checkpoint folder
        checkpointInterval=10,
    )


def held_back_points(rows: DataFrame, cfg: ForecastConfig, label: str, weeks: int | None) -> DataFrame:
    """Weighted points of the rows; those of the last weeks are ``held_back`` to tell when to stop."""
    late = F.col("date") > cutoff(rows, weeks) if weeks else F.lit(False)
    return weighted_points(rows.withColumn("held_back", late), [*feature_columns(cfg), "held_back"], label)


def best_rounds(losses: Sequence[float]) -> int:
    """The first number of rounds with the least loss; ``losses`` are those after 1, 2, ... rounds."""
    return min(range(len(losses)), key=losses.__getitem__) + 1


def _over_cells(estimator, cells: DataFrame):
    """The estimator for a fit over cells: it looks at all of them, not at a sample, to see which bins there are."""
    most = math.isqrt(max(cells.count() - 1, 0)) + 1
    return estimator.setMaxBins(max(estimator.getMaxBins(), min(most, MOST_BINS)))


def search_rounds(points: DataFrame, cfg: ForecastConfig, kind: type, settings: BoostingConfig, label: str) -> int:
    """How many rounds fit the weeks held back best, after a fit on the points before them.

    The search looks back after doubling numbers of rounds, until the best one lies ``early_stop_patience`` rounds back: less
    than four times the rounds that are needed, however many the maximum is.
    """
    early, late, sums = held_back_cells(points, cfg, kind, settings, label)
    if sums is not None:
        classifies, columns = kind is GBTClassifier, bin_columns(cfg)
        done = partial(_search_ends, most=settings.iterations, patience=settings.early_stop_patience)
        plan = rounds.losses_by_round(sums, columns, 0, classifies, settings.learning_rate, settings.depth, done)
        return best_rounds([r.loss for r in sorted(plan.collect(), key=lambda r: r["round"])])
    tried = settings.early_stop_patience + 1
    while True:
        tried = min(tried, settings.iterations)
        estimator = _boosting(kind, dataclasses.replace(settings, iterations=tried), label)
        trees = _over_cells(estimator, early).fit(early)
        losses = trees.evaluateEachIteration(late, *(["squared"] if kind is GBTRegressor else []))
        if _search_ends(losses, settings.iterations, settings.early_stop_patience):
            return best_rounds(losses)
        tried = 2 * tried


def _search_ends(losses: Sequence[float], most: int, patience: int) -> bool:
    """Whether the rounds so far are all, or are one of the doubling numbers with the best ``patience`` rounds back."""
    n, doubled = len(losses), patience + 1
    while doubled < n:
        doubled *= 2
    return n >= most or (n == doubled and best_rounds(losses) + patience <= n)


def held_back_cells(
    points: DataFrame, cfg: ForecastConfig, kind: type, settings: BoostingConfig, label: str
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Cells of the points to learn from and of those held back, as fits read them, and their sums.

    Means and thresholds come from the points to learn from alone. There are no sums where they are too many for a task.
    """
    root = new_table_root(points.sparkSession)
    early, late = points.where("not held_back"), points.where("held_back")
    means = CategoryMeans.fit(early, cfg.categorical, label, f"{root}/means")
    encoded = split_points(early, means, cfg, [label, "weight"])
    bins = Bins.find(encoded, _boosting(kind, settings, label))
    parts = ((encoded, False), (with_vector(late, means, cfg), True))
    both = [cells(part, bins, cfg, label).withColumn("held_back", F.lit(held)) for part, held in parts]
    stored = overwrite(both[0].unionByName(both[1]), f"{root}/cells")
    sums = overwrite(rounds.cell_sums(stored, bin_columns(cfg), label), f"{root}/cell_sums")
    if sums.count() <= rounds.MOST_TASK_CELLS:
        return stored.where("not held_back"), stored.where("held_back"), sums
    return *(fit_cells(stored.where(part), cfg, label) for part in ("not held_back", "held_back")), None


def bins_and_cells(
    points: DataFrame, means: CategoryMeans, cfg: ForecastConfig, kind: type, settings: BoostingConfig, label: str
) -> tuple[Bins, DataFrame]:
    """The thresholds that a fit on the points chooses from, and the cells between them that stand for the points."""
    encoded = split_points(points, means, cfg, [label, "weight"])
    bins = Bins.find(encoded, _boosting(kind, settings, label))
    return bins, fit_cells(cells(encoded, bins, cfg, label), cfg, label)


def fit_stage(rows: DataFrame, cfg: ForecastConfig, kind: type, settings: BoostingConfig, label: str) -> StageModel:
    """Fit one stage on rows with features, date and label, with as many rounds as the held-back weeks ask for.

    The search learns its means and trees from the weeks before those only; the model is then fitted on all rows. Where
    the rows lie within the held-back weeks or none is to be held back, all rounds run.
    """
    root = new_table_root(rows.sparkSession)
    points = overwrite(held_back_points(rows, cfg, label, settings.early_stop_weeks), f"{root}/weighted_points")
    if points.select("held_back").distinct().count() == 2:
        settings = dataclasses.replace(settings, iterations=search_rounds(points, cfg, kind, settings, label))
    points = points.groupBy(*feature_columns(cfg), label).agg(F.sum("weight").alias("weight"))
    points = overwrite(points, f"{root}/all_points")
    means = CategoryMeans.fit(points, cfg.categorical, label, f"{root}/means")
    bins, data = bins_and_cells(points, means, cfg, kind, settings, label)
    return StageModel(_over_cells(_boosting(kind, settings, label), data).fit(data), means, bins)


def fit_classifier(train: DataFrame, cfg: ForecastConfig) -> StageModel:
    data = train.withColumn("sells", (F.col(cfg.target) > 0).cast("double")).where("sells is not null")
    return fit_stage(data, cfg, GBTClassifier, cfg.classifier, "sells")


def fit_regressor(train: DataFrame, cfg: ForecastConfig) -> StageModel:
    """Quantities of the rows that sold something."""
    data = train.where(F.col(cfg.target) > 0).withColumn("quantity", F.col(cfg.target).cast("double"))
    return fit_stage(data, cfg, GBTRegressor, cfg.regressor, "quantity")


def fit_two_stage(features: DataFrame, cfg: ForecastConfig) -> TwoStageModel:
    """Train on everything but the last weeks."""
    train = train_part(features, cfg.test_weeks)
    return TwoStageModel(fit_classifier(train, cfg), fit_regressor(train, cfg))


def _point_probabilities(points: DataFrame, model: StageModel, cfg: ForecastConfig) -> DataFrame:
    binned = model.with_bins(points, cfg, feature_columns(cfg))
    return probabilities(binned, model, cfg).select(*points.columns, "sale_probability")


def _point_quantities(points: DataFrame, model: StageModel, cfg: ForecastConfig) -> DataFrame:
    binned = model.with_bins(points, cfg, feature_columns(cfg))
    return quantities(binned, model, cfg).select(*points.columns, "raw_quantity")


def probabilities(binned: DataFrame, model: StageModel, cfg: ForecastConfig, prefix: str = "") -> DataFrame:
    """Add ``sale_probability`` to rows that have the bins of the features."""
    out = model.trees.transform(with_bin_vector(binned, cfg, prefix))
    return out.select(*binned.columns, vector_to_array("probability")[1].alias("sale_probability"))


def quantities(binned: DataFrame, model: StageModel, cfg: ForecastConfig, prefix: str = "") -> DataFrame:
    """Add ``raw_quantity`` to rows that have the bins of the features."""
    out = model.trees.transform(with_bin_vector(binned, cfg, prefix))
    return out.select(*binned.columns, F.col("prediction").alias("raw_quantity"))


def score_points(points: DataFrame, model: TwoStageModel, cfg: ForecastConfig) -> DataFrame:
    """Add ``sale_probability`` and ``raw_quantity`` to rows that have the features; each row is scored by itself."""
    return _point_quantities(_point_probabilities(points, model.classifier, cfg), model.regressor, cfg)


def _per_point(df: DataFrame, cfg: ForecastConfig, score) -> DataFrame:
    """Score each distinct feature point once and join the scores back; a missing feature meets a missing one."""
    keys = feature_columns(cfg)
    return join_null_safe(df, score(df.select(*keys).distinct()), keys)


def sale_probabilities(df: DataFrame, model: StageModel, cfg: ForecastConfig) -> DataFrame:
    return _per_point(df, cfg, lambda points: _point_probabilities(points, model, cfg))


def raw_quantities(df: DataFrame, model: StageModel, cfg: ForecastConfig) -> DataFrame:
    return _per_point(df, cfg, lambda points: _point_quantities(points, model, cfg))


def raw_predictions(df: DataFrame, model: TwoStageModel, cfg: ForecastConfig) -> DataFrame:
    """Add ``sale_probability`` and ``raw_quantity``."""
    return _per_point(df, cfg, lambda points: score_points(points, model, cfg))


def decide(raw: DataFrame, threshold: float) -> DataFrame:
    """Nothing below the threshold, else the rounded quantity."""
    sells = F.col("sale_probability") >= threshold
    return raw.withColumn("predicts_sale", sells.cast("int")).withColumn(
        "predicted", F.when(sells, non_negative_int(F.col("raw_quantity"))).otherwise(0)
    )


def feature_importance(model: TwoStageModel, cfg: ForecastConfig, df: DataFrame) -> DataFrame:
    """One row per feature; ``df`` only lends its session."""
    names = [*cfg.categorical, *cfg.numerical]
    cls = model.classifier.trees.featureImportances.toArray()
    reg = model.regressor.trees.featureImportances.toArray()
    rows = [(n, float(c), float(r)) for n, c, r in zip(names, cls, reg)]
    return df.sparkSession.createDataFrame(
        rows, "feature_name string, classifier_importance double, regressor_importance double"
    )


# --- baselines ----------------------------------------------------------------------------------


def predict_hist_avg(df: DataFrame) -> DataFrame:
    """The rounded historical average as a forecast."""
    return df.withColumn("predicted", non_negative_int(F.col("hist_avg")))


@dataclass(frozen=True)
class PoissonModel:
    regression: PipelineModel
    means: CategoryMeans


def fit_poisson(train: DataFrame, cfg: ForecastConfig, max_iter: int = 25) -> PoissonModel:
    data = train.where(F.col(cfg.target).isNotNull()).withColumn("quantity", F.col(cfg.target).cast("double"))
    root = new_table_root(train.sparkSession)
    points = overwrite(weighted_points(data, feature_columns(cfg), "quantity"), f"{root}/weighted_points")
    means = CategoryMeans.fit(points, cfg.categorical, "quantity", f"{root}/means")
    glm = GeneralizedLinearRegression(
        family="poisson",
        link="log",
        featuresCol="scaled",
        labelCol="quantity",
        weightCol="weight",
        maxIter=max_iter,
        regParam=0.01,
    )
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    data = encode_points(points, means, cfg, ["quantity", "weight"])
    return PoissonModel(Pipeline(stages=[scaler, glm]).fit(data), means)


def predict_poisson(df: DataFrame, model: PoissonModel, cfg: ForecastConfig, threshold: float = 0.5):
    def score(points: DataFrame) -> DataFrame:
        out = model.regression.transform(with_vector(points, model.means, cfg))
        return out.select(*points.columns, floor_threshold(F.col("prediction"), threshold).alias("predicted"))

    return _per_point(df, cfg, score)


def boosting_grid() -> list[BoostingConfig]:
    """The 27 settings named for tuning."""
    return [
        BoostingConfig(iterations=i, learning_rate=r, depth=d)
        for i in (300, 500, 700)
        for r in (0.03, 0.05, 0.1)
        for d in (4, 6, 8)
    ]


def tune(
    features: DataFrame, cfg: ForecastConfig, grid: Sequence[BoostingConfig] | None = None, threads: int = 3
) -> DataFrame:
    """Classifier log loss of each setting on the last weeks of the *training* part.

    Boosting adds one tree after the other, so the first trees of a long fit are the fit of fewer rounds: settings that
    differ in their rounds alone share one fit, and its loss is read off after each number of rounds. The fits run on one
    table of cells: a task each where a task can hold the cells, else as Spark's fits, up to ``threads`` at a time.
    """
    train = train_part(features, cfg.test_weeks)
    rows = train.withColumn("sells", (F.col(cfg.target) > 0).cast("double")).where("sells is not null")
    root = new_table_root(features.sparkSession)
    points = overwrite(held_back_points(rows, cfg, "sells", cfg.test_weeks), f"{root}/weighted_points")
    grid = list(grid or boosting_grid())
    early, late, sums = held_back_cells(points, cfg, GBTClassifier, grid[0], "sells")
    fits: dict[BoostingConfig, list[int]] = defaultdict(list)
    for setting in grid:
        fits[dataclasses.replace(setting, iterations=0, early_stop_weeks=None)].append(setting.iterations)
    if sums is not None:
        return _grid_of_tasks(sums, cfg, fits)

    @inheritable_thread_target(features.sparkSession)
    def fit(item: tuple[BoostingConfig, list[int]]) -> list[tuple]:
        setting, numbers = item
        longest = _boosting(GBTClassifier, dataclasses.replace(setting, iterations=max(numbers)), "sells")
        losses = log_losses(_over_cells(longest, early).fit(early), late)
        return [(n, setting.learning_rate, setting.depth, losses[n - 1]) for n in numbers]

    with ThreadPool(max(1, min(threads, len(fits)))) as pool:
        found = [row for rows in pool.map(fit, fits.items()) for row in rows]
    return features.sparkSession.createDataFrame(found, _GRID)


_GRID = "iterations int, learning_rate double, depth int, log_loss double"


def _run_all(losses: Sequence[float], most: int) -> bool:
    return len(losses) >= most


def _grid_of_tasks(sums: DataFrame, cfg: ForecastConfig, fits: dict[BoostingConfig, list[int]]) -> DataFrame:
    """One job with a task per fit; the longest first, as a cluster may have fewer cores than there are fits."""
    longest_first = sorted(fits.items(), key=lambda item: -item[0].depth * max(item[1]))
    plans = [
        rounds.losses_by_round(
            sums, bin_columns(cfg), i, True, setting.learning_rate, setting.depth, partial(_run_all, most=max(numbers))
        )
        for i, (setting, numbers) in enumerate(longest_first)
    ]
    wanted = [
        (i, n, setting.learning_rate, setting.depth) for i, (setting, numbers) in enumerate(longest_first) for n in numbers
    ]
    losses = {(r.number, r.round): r.loss / 2 for r in reduce(DataFrame.unionByName, plans).collect()}
    rows = [(n, rate, depth, losses[i, n]) for i, n, rate, depth in wanted]
    return sums.sparkSession.createDataFrame(rows, _GRID)


def log_losses(model: GBTClassificationModel, points: DataFrame, label: str = "sells") -> list[float]:
    """Weighted log loss after each round: one pass over the points, whose trees add up round by round."""
    # a tree's vote counts with its weight; twice the sum is the log odds
    return [loss / 2 for loss in model.evaluateEachIteration(points)]
