"""Batch scoring: requests (route, day period, expected passengers) against the fresh products.

A score depends on the product, the route, the day period and the passenger class alone. Each such point is scored once, and
requests are joined to the scores; sums over products are taken on the points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygalley.config import ForecastConfig
from skygalley.errors import ValidationError
from skygalley.forecast.encoding import feature_columns
from skygalley.forecast.models import TwoStageModel, decide, probabilities, quantities
from skygalley.forecast.preparation import LOOKUP_KEY, pax_bin
from skygalley.operators.joins import join_null_safe
from skygalley.session import new_table_root
from skygalley.sources.sinks import overwrite

REQUEST = ["request_id", "route", "day_period", "expected_pax"]


def with_products(
    rows: DataFrame, products: DataFrame, keys: list[str], slices: int | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Every row, distinct in ``keys``, with every fresh product: a forecast covers the whole catalog. ``carry`` names more
    columns of the products to take along.

    An equi join on a slice number: Spark broadcasts a small catalog, and shuffles even slices of a
    large one. No side is assumed to be small. Rows spread over ``slices`` (the session's shuffle
    partitions unless stated), and each slice meets the catalog it is given: filter that first.
    """
    n = slices or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = rows.withColumn("_slice", F.pmod(F.xxhash64(*keys), F.lit(n)))
    every = F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))
    catalog = products.select("item_id", "category", *carry, every.alias("_slice"))
    return sliced.join(catalog, "_slice").drop("_slice")


CONTEXT = ["route", "day_period", "pax_bin"]


def with_context(requests: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Requests with their served passenger class."""
    return requests.select(*REQUEST).withColumn("pax_bin", pax_bin(F.col("expected_pax"), cfg, serving=True))


def contexts(requests: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """The distinct (route, day period, passenger class) of the requests: all of a request that a score depends on."""
    return with_context(requests, cfg).select(*CONTEXT).distinct()


def point_inputs(
    requests: DataFrame, products: DataFrame, lookup: DataFrame, cfg: ForecastConfig
) -> DataFrame:
    """One row per context and fresh product, with the historical average; no row per request.

    Its size is routes x day periods x passenger classes x products, however many flights ask.
    """
    rows = with_products(contexts(requests, cfg), products, CONTEXT)
    return rows.join(lookup.select(*LOOKUP_KEY, "hist_avg"), LOOKUP_KEY, "left")


def score_inputs(
    requests: DataFrame, products: DataFrame, lookup: DataFrame, cfg: ForecastConfig
) -> DataFrame:
    """Requests expanded to products, with the served passenger class and historical average."""
    return join_null_safe(with_context(requests, cfg), point_inputs(requests, products, lookup, cfg), CONTEXT, "inner")


# The bins of the two stages of a model, side by side.
_CLASSIFIER, _REGRESSOR = "cls_", "reg_"


def binned_inputs(
    requests: DataFrame, products: DataFrame, lookup: DataFrame, model: TwoStageModel, cfg: ForecastConfig
) -> DataFrame:
    """``point_inputs`` with the bins of both stages.

    A product and a context are looked up and binned once each, before they are paired; only what depends on both, the
    average, is found per pair, and that before passenger classes multiply the pairs of route and period.
    """
    root, columns = new_table_root(requests.sparkSession), feature_columns(cfg)
    met, catalog = contexts(requests, cfg), products.select("item_id", "category")
    of_context, of_product = ([c for c in columns if c in df.columns] for df in (met, catalog))
    rest = [c for c in columns if c not in of_context + of_product]
    stages = ((_CLASSIFIER, model.classifier), (_REGRESSOR, model.regressor))
    for prefix, stage in stages:
        met = stage.with_bins(met, cfg, of_context, prefix)
        catalog = stage.with_bins(catalog, cfg, of_product, prefix)
    met, catalog = overwrite(met, f"{root}/contexts"), overwrite(catalog, f"{root}/catalog")
    place = [c for c in LOOKUP_KEY if c in CONTEXT]
    rows = with_products(met.select(*place).distinct(), catalog, place, carry=catalog.columns[2:])
    rows = rows.join(lookup.select(*LOOKUP_KEY, "hist_avg"), LOOKUP_KEY, "left")
    rows = join_null_safe(rows, met, place, "inner")
    for prefix, stage in stages:
        rows = stage.with_bins(rows, cfg, rest, prefix)
    return rows


def score_table(
    requests: DataFrame,
    products: DataFrame,
    lookup: DataFrame,
    model: TwoStageModel,
    threshold_type: str,
    cfg: ForecastConfig,
) -> DataFrame:
    """The predicted quantity of every context and product, scored once and written; requests are joined to it."""
    if threshold_type not in cfg.thresholds:
        raise ValidationError(f"Unknown threshold type: {threshold_type}")
    rows = binned_inputs(requests, products, lookup, model, cfg)
    raw = quantities(probabilities(rows, model.classifier, cfg, _CLASSIFIER), model.regressor, cfg, _REGRESSOR)
    out = decide(raw, cfg.thresholds[threshold_type]).select(
        *CONTEXT, "item_id", "category", "hist_avg", F.col("predicted").alias("predicted_quantity")
    )
    return overwrite(out, f"{new_table_root(requests.sparkSession)}/score_table")


def _for_requests(requests: DataFrame, table: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """A missing route or period meets a missing one. A hot context is many requests and few rows of the table."""
    return join_null_safe(with_context(requests, cfg), table, CONTEXT, "inner")


def score(requests: DataFrame, table: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Predicted quantity of every product for every request."""
    return _for_requests(requests, table, cfg).select(
        "request_id", "route", "day_period", "item_id", "category", "hist_avg", "predicted_quantity"
    )


def score_item(
    requests: DataFrame, table: DataFrame, item_id: str, accuracy: DataFrame, cfg: ForecastConfig
) -> DataFrame:
    """One product's scores with its average (0 without history) and estimated accuracy."""
    rows = table.where(F.col("item_id") == item_id).join(accuracy, "item_id", "left")
    return _for_requests(requests, rows, cfg).select(
        "request_id",
        "item_id",
        "predicted_quantity",
        F.coalesce("hist_avg", F.lit(0.0)).alias("historical_average"),
        "estimated_accuracy",
    )


def score_category(requests: DataFrame, table: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Predicted quantity per request and category, summed over the products before any request is met."""
    sums = table.groupBy(*CONTEXT, F.col("category").alias("category_name")).agg(
        F.sum("predicted_quantity").alias("predicted_quantity")
    )
    return _for_requests(requests, sums, cfg).select("request_id", "category_name", "predicted_quantity")
