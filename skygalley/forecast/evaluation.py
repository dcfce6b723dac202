"""Quality of forecasts: everything is a conditional count in one pass over the predictions."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skygalley.errors import ValidationError
from skygalley.functions import absolute_error, half_even, non_negative_int, ratio
from skygalley.operators.cleaning import first_per_key
from skygalley.operators.stats import auc
from skygalley.sources.sinks import folder_exists, overwrite, table_exists


def _n(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def classifier_metrics(fact: Column, predicts: Column) -> list[Column]:
    """Precision, recall, F1 and accuracy of "sells at all"; an empty denominator gives 0."""
    true, false = fact > 0, fact <= 0
    yes, no = predicts == 1, predicts == 0
    precision = _or_zero(ratio(_n(true & yes), _n(yes)))
    recall = _or_zero(ratio(_n(true & yes), _n(true)))
    f1 = _or_zero(ratio(2 * _n(true & yes), _n(yes) + _n(true)))
    accuracy = ratio(_n(true & yes) + _n(false & no), F.count(fact))
    return [
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        accuracy.alias("accuracy"),
    ]


def business_metrics(fact: Column, predicted: Column) -> list[Column]:
    """Exact forecasts, too many (waste) and too few (lost sale), as counts and shares."""
    n = F.count(F.lit(1))
    out = []
    for name, condition in (
        ("accurate", predicted == fact),
        ("waste", predicted > fact),
        ("lost_sale", predicted < fact),
    ):
        out.append(_n(condition).alias(name))
        out.append(half_even(ratio(_n(condition), n), 2).alias(f"{name}_share"))
    return out


def mean_absolute_error(fact: Column, predicted: Column) -> Column:
    return F.avg(absolute_error(fact, predicted))


def root_mean_square_error(fact: Column, predicted: Column) -> Column:
    error = fact.cast("double") - predicted.cast("double")
    return F.sqrt(F.avg(error * error))


def error_profile(df: DataFrame, target: str = "sold_quantity") -> DataFrame:
    """Count, share and mean deviation of exact, wasteful and lossy forecasts."""
    diff = F.col(target).cast("double") - F.col("predicted")
    kind = (
        F.when(diff == 0, "accurate_prediction")
        .when(diff < 0, "potential_waste")
        .when(diff > 0, "potential_lost_sale")
    )
    n = F.count(F.lit(1))
    whole = df.agg(n).scalar()
    return df.groupBy(kind.alias("category")).agg(
        n.alias("records"),
        half_even(100 * ratio(n, whole), 1).alias("share_pct"),
        F.avg(diff).alias("mean_deviation"),
    )


def evaluate(decided: DataFrame, target: str = "sold_quantity") -> DataFrame:
    """All eleven metrics of one decided forecast as one row."""
    fact, predicted = F.col(target), F.col("predicted")
    return decided.agg(
        *classifier_metrics(fact, F.col("predicts_sale")),
        mean_absolute_error(fact, predicted).alias("mae"),
        *business_metrics(fact, predicted),
    )


def evaluate_by_item(decided: DataFrame, target: str = "sold_quantity") -> DataFrame:
    fact, predicted = F.col(target), F.col("predicted")
    return decided.groupBy("item_id").agg(
        _n(predicted == fact).alias("accurate"),
        _n(predicted > fact).alias("waste"),
        _n(predicted < fact).alias("lost_sale"),
    )


def compare_thresholds(
    raw: DataFrame, thresholds: Sequence[float], target: str = "sold_quantity"
) -> DataFrame:
    """The metrics at several thresholds, from one pass over the raw predictions."""
    rows = raw.select(
        F.col(target).alias("fact"),
        "sale_probability",
        "raw_quantity",
        F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold"),
    )
    sells = F.col("sale_probability") >= F.col("threshold")
    rows = rows.withColumn("predicts_sale", sells.cast("int")).withColumn(
        "predicted", F.when(sells, non_negative_int(F.col("raw_quantity"))).otherwise(0)
    )
    fact, predicted = F.col("fact"), F.col("predicted")
    return rows.groupBy("threshold").agg(
        *classifier_metrics(fact, F.col("predicts_sale")),
        mean_absolute_error(fact, predicted).alias("mae"),
        *business_metrics(fact, predicted),
    )


def deep_report(decided: DataFrame, target: str = "sold_quantity") -> DataFrame:
    """Confusion matrix, and how close the quantities are on zeros, on sales and where both agree."""
    fact, predicted, yes = F.col(target), F.col("predicted"), F.col("predicts_sale") == 1
    error = absolute_error(fact, predicted)
    sold, hit = fact > 0, (fact > 0) & yes
    return decided.agg(
        _n(~sold & ~yes).alias("true_negatives"),
        _n(~sold & yes).alias("false_positives"),
        _n(sold & ~yes).alias("false_negatives"),
        _n(hit).alias("true_positives"),
        _n(hit & (error == 0)).alias("hit_exact"),
        _n(hit & (error <= 1)).alias("hit_within_1"),
        _n(hit & (error <= 2)).alias("hit_within_2"),
        F.avg(F.when(hit, error)).alias("hit_mae"),
        _n(~sold & (predicted == 0)).alias("zeros_exact"),
        _n(sold & (error == 0)).alias("sales_exact"),
        _n(sold & (error <= 1)).alias("sales_within_1"),
        _n(sold & (error <= 2)).alias("sales_within_2"),
        F.avg(F.when(sold, error)).alias("sales_mae"),
        _n(error == 0).alias("exact"),
        F.avg(error).alias("mae"),
    )


def roc_auc(raw: DataFrame, target: str = "sold_quantity") -> DataFrame:
    """One row ``auc``: how well the probability ranks rows with a sale above those without; a plan, not yet run."""
    return auc(raw, "sale_probability", F.col(target) > 0)


# --- stored runs --------------------------------------------------------------------------------

# Which part of the model a stored metric belongs to, in stored order.
METRIC_MODEL = {
    "precision": "classifier",
    "recall": "classifier",
    "f1": "classifier",
    "accuracy": "classifier",
    "mae": "regressor",
    "accurate": "regressor",
    "accurate_share": "regressor",
    "waste": "regressor",
    "waste_share": "regressor",
    "lost_sale": "regressor",
    "lost_sale_share": "regressor",
}


def metric_rows(metrics: DataFrame) -> DataFrame:
    """One evaluated row as eleven (model, metric, value) rows."""
    entries = [
        F.struct(
            F.lit(model).alias("model_type"),
            F.lit(name).alias("metric_name"),
            F.col(name).cast("double").alias("metric_value"),
        )
        for name, model in METRIC_MODEL.items()
    ]
    return metrics.select(F.inline(F.array(*entries)))


def loss(previous, current):
    """Share of the previous accuracy that is lost; of two numbers or of two columns."""
    return (previous - current) / previous


def degraded(previous: Column, current: Column, allowed: float) -> Column:
    """Whether the loss is above the allowed share; never without a previous accuracy, or after zero."""
    return F.coalesce(loss(F.nullif(previous, F.lit(0.0)), current) > allowed, F.lit(False))


def is_degraded(previous: float | None, current: float, allowed: float) -> tuple[bool, str]:
    """The same rule for two numbers, with a note for the log."""
    if not previous:
        return False, "nothing to compare with"
    lost = loss(previous, current)
    note = f"accuracy {current:.3f} after {previous:.3f}, a loss of {lost:.1%} (allowed: {allowed:.1%})"
    return lost > allowed, note


def latest_accuracy(
    metrics: DataFrame, runs: DataFrame | None = None, threshold_type: str | None = None
) -> float | None:
    """Accuracy of the latest stored run; with ``runs`` of the latest among those, and of one kind by ``threshold_type``."""
    rows = metrics.where("metric_name = 'accuracy'")
    if runs is not None:
        complete = runs if threshold_type is None else runs.where(F.col("threshold_type") == threshold_type)
        rows = rows.join(complete, "run_id", "left_semi")
    last = rows.orderBy(F.desc("run_id")).select("metric_value").first()
    return last[0] if last else None


# Results of a run, and the table whose rows are the manifests: a run exists once its manifest does.
RESULT_TABLES = ("model_metrics", "feature_importance", "model_metrics_by_item")
MANIFESTS = "model_runs"
COMMIT = "commit_id"


def new_commit() -> str:
    """An id that no other writer has."""
    return uuid.uuid4().hex


def _folder(root: str, table: str, commit: str) -> str:
    # the letter keeps an id of digits from being read as a number
    return f"{root.rstrip('/')}/{table}/{COMMIT}=c{commit}"


def store_run(
    root: str,
    commit: str,
    version: str,
    threshold_type: str,
    threshold: float,
    metrics: DataFrame,
    by_item: DataFrame,
    importance: DataFrame,
) -> bool:
    """Store the results of a run under its commit id, then its manifest; whether this call completed the run.

    Writers share nothing but the root: each commit has folders of its own, so several may write at once, and none waits
    for or counts the others. A call that is repeated under the id of a run that ended half-way replaces what was
    left; under the id of a complete run it writes nothing.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", commit):
        raise ValidationError(f"no commit id: {commit!r}")
    spark = metrics.sparkSession
    if table_exists(spark, _folder(root, MANIFESTS, commit)):
        return False
    for table, rows in zip(RESULT_TABLES, (metric_rows(metrics), importance, by_item)):
        overwrite(rows, _folder(root, table, commit))
    manifest = spark.range(1).select(
        F.lit(version).alias("model_version"),
        F.lit(threshold_type).alias("threshold_type"),
        F.lit(float(threshold)).alias("threshold_value"),
        F.current_timestamp().alias("created_at"),
    )
    overwrite(manifest, _folder(root, MANIFESTS, commit))
    return True


_MANIFEST = f"model_version string, threshold_type string, threshold_value double, created_at timestamp, {COMMIT} string"


def stored_runs(spark: SparkSession, root: str) -> DataFrame:
    """The complete runs under a root, numbered from 1 in the order in which they were completed; none without any."""
    folder = f"{root.rstrip('/')}/{MANIFESTS}"
    if not folder_exists(spark, folder):
        return spark.createDataFrame([], f"run_id int, {_MANIFEST}")
    runs = spark.read.schema(_MANIFEST).parquet(folder)
    # a row per run: a short series
    order = Window.orderBy("created_at", COMMIT)
    return runs.withColumn("run_id", F.row_number().over(order)).select("run_id", *runs.columns)


def run_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Results of the complete runs, with their run ids; what a run left that has no manifest is passed over."""
    rows = spark.read.parquet(f"{root.rstrip('/')}/{table}")
    return rows.join(stored_runs(spark, root).select("run_id", COMMIT), COMMIT).drop(COMMIT)


def estimated_accuracy(by_item: DataFrame, runs: DataFrame) -> DataFrame:
    """Per item, the share of exact forecasts in the latest run that covers it."""
    stored = by_item.join(runs.select("run_id"), "run_id", "left_semi")
    last = first_per_key(stored, ["item_id"], [F.desc("run_id")])
    whole = F.col("accurate") + F.col("waste") + F.col("lost_sale")
    return last.select("item_id", ratio(F.col("accurate"), whole).alias("estimated_accuracy"))
