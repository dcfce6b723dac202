"""Forecast: preparation, folds, models, evaluation and scoring on the fresh-food mart.

Queries with SQL are exact. Of models the inputs and the facts that any fit must keep are stated in SQL; settings are the
engine's defaults and the data is always whole.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygalley.config import ForecastConfig
from skygalley.forecast import evaluation as ev
from skygalley.forecast import folds, models, neighbours, preparation, scoring
from skygalley.functions import absolute_error, floor_threshold, half_even
from skygalley.plans.warehouse import fresh_products
from skygalley.registry.base import Lab, plain, query
from skygalley.registry.oracle import double, rint
from skygalley.sources.sinks import overwrite


def mart(lab: Lab) -> DataFrame:
    return lab.wh.ref("mart_fresh_food_order_sale")


def cleaned(lab: Lab) -> DataFrame:
    """Written once: the features read it twice."""
    return lab.keep(
        "clean", lambda: overwrite(preparation.without_errors(mart(lab)), f"{lab.root}/clean")
    )


def features(lab: Lab) -> DataFrame:
    """The feature table, written once like every table that several jobs read."""

    def build() -> DataFrame:
        return overwrite(preparation.build_features(cleaned(lab), lab.forecast), f"{lab.root}/features")

    return lab.keep("features", build)


def folded(lab: Lab) -> DataFrame:
    return folds.with_folds(features(lab), lab.forecast.block_days)


# --- preparation --------------------------------------------------------------------------------


@query("agg_value_counts", "SELECT potential_error, count(*) AS n FROM mart_fresh_food_order_sale WHERE potential_error IS NOT NULL GROUP BY 1")
def _errors(lab: Lab):
    return preparation.error_counts(mart(lab))


@query(
    "fc_clean",
    """SELECT flight_key, flight_number, origin, destination, date, day_period, is_night, number_of_passengers,
       item_id, category, sold_quantity FROM fc_clean""",
)
def _clean(lab: Lab):
    out = preparation.clean_data(mart(lab))
    return out.select(
        "flight_key",
        "flight_number",
        "origin",
        "destination",
        "date",
        "day_period",
        "is_night",
        "number_of_passengers",
        "item_id",
        "category",
        "sold_quantity",
    )


@query("feat_pax_bin", "SELECT pax_bin, count(*) AS n FROM fc_binned GROUP BY pax_bin")
def _bin(lab: Lab):
    label = preparation.pax_bin(F.col("number_of_passengers"), lab.forecast)
    return cleaned(lab).groupBy(label.alias("pax_bin")).agg(F.count(F.lit(1)).alias("n"))


@query("feat_route", "SELECT flight_key, item_id, route FROM fc_binned")
def _route(lab: Lab):
    return cleaned(lab).select("flight_key", "item_id", preparation.route().alias("route"))


@query("feat_hist_avg", f"SELECT * REPLACE ({double('price')}) FROM fc_features")
def _features(lab: Lab):
    return plain(preparation.build_features(cleaned(lab), lab.forecast))


@query(
    "feat_lookup",
    """SELECT DISTINCT item_id, route, day_period, hist_avg, hist_level_used FROM (
       SELECT *, row_number() OVER (PARTITION BY item_id, route, day_period ORDER BY hist_level_used, hist_avg) AS rn
       FROM fc_features) WHERE rn = 1""",
)
def _lookup(lab: Lab):
    return preparation.hist_lookup(features(lab))


# --- folds --------------------------------------------------------------------------------------


@query("cv_blocks", "SELECT block, fold_num, count(*) AS n, min(date) AS first_date, max(date) AS last_date FROM fc_folds GROUP BY block, fold_num")
def _blocks(lab: Lab):
    return folded(lab).groupBy("block", "fold_num").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


@query(
    "cv_fold_sizes",
    """SELECT v.fold_num, (SELECT count(*) FROM fc_folds t WHERE t.block < v.block) AS train_size,
       (SELECT max(date) FROM fc_folds t WHERE t.block < v.block) AS train_last, min(v.date) AS val_first,
       max(v.date) AS val_last, count(*) AS val_size
       FROM fc_folds v WHERE v.fold_num IS NOT NULL GROUP BY v.fold_num, v.block""",
)
def _sizes(lab: Lab):
    return folds.fold_sizes(folded(lab))


@query("cv_hist_avg", "SELECT flight_key, item_id, fold_num, hist_avg, hist_level_used FROM fc_validated")
def _expanding(lab: Lab):
    out = folds.expanding_hist_avg(folded(lab), lab.forecast.min_samples)
    return out.select("flight_key", "item_id", "fold_num", "hist_avg", "hist_level_used")


@query(
    "win_expanding_prior",
    """SELECT v.item_id, v.block, sum(t.s) AS prior_total FROM
       (SELECT DISTINCT item_id, block FROM fc_folds) v JOIN
       (SELECT item_id, block, CAST(sum(sold_quantity) AS BIGINT) AS s FROM fc_folds GROUP BY 1, 2) t
         ON v.item_id = t.item_id AND t.block < v.block GROUP BY v.item_id, v.block""".replace(
        "sum(t.s)", "CAST(sum(t.s) AS BIGINT)"
    ),
)
def _prior(lab: Lab):
    from pyspark.sql import Window

    before = Window.partitionBy("item_id").orderBy("block")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    parts = folds.with_blocks(features(lab), lab.forecast.block_days).groupBy("item_id", "block")
    parts = parts.agg(F.sum("sold_quantity").alias("s"))
    prior = parts.select("item_id", "block", F.sum("s").over(before).alias("prior_total"))
    return prior.where("prior_total is not null")


@query(
    "cv_coverage",
    """SELECT fold_num, 100 * (CAST(count(hist_avg) AS DOUBLE) / count(*)) AS coverage_pct,
       count(*) FILTER (hist_level_used = 1) AS level_1, count(*) FILTER (hist_level_used = 2) AS level_2,
       count(*) FILTER (hist_level_used = 3) AS level_3 FROM fc_validated GROUP BY fold_num""",
)
def _coverage(lab: Lab):
    return folds.fold_coverage(folds.expanding_hist_avg(folded(lab), lab.forecast.min_samples))


@query(
    "split_time",
    """SELECT 'train' AS part, count(*) AS n, min(date) AS first_date, max(date) AS last_date FROM fc_train
       UNION ALL SELECT 'test', count(*), min(date), max(date) FROM fc_test""",
)
def _split(lab: Lab):
    out = None
    for name, take in (("train", folds.train_part), ("test", folds.test_part)):
        one = take(features(lab), lab.forecast.test_weeks).agg(
            F.count(F.lit(1)).alias("n"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        )
        one = one.select(F.lit(name).alias("part"), "n", "first_date", "last_date")
        out = one if out is None else out.unionByName(one)
    return out


# --- exact evaluation, on the historical-average baseline -------------------------------------------


def baseline(lab: Lab) -> DataFrame:
    """The baseline as a decided forecast: it predicts a sale where it predicts a quantity."""
    test = folds.test_part(features(lab), lab.forecast.test_weeks)
    out = models.predict_hist_avg(test)
    return out.withColumn("predicts_sale", (F.col("predicted") > 0).cast("int"))


@query("base_hist_avg", "SELECT flight_key, item_id, sold_quantity, hist_avg, predicted FROM fc_baseline")
def _baseline(lab: Lab):
    return baseline(lab).select("flight_key", "item_id", "sold_quantity", "hist_avg", "predicted")


_TP = "count(*) FILTER (sold_quantity > 0 AND predicted > 0)"
_YES, _POS = "count(*) FILTER (predicted > 0)", "count(*) FILTER (sold_quantity > 0)"
_TN = "count(*) FILTER (sold_quantity <= 0 AND predicted = 0)"


@query(
    "eval_cls",
    f"""SELECT coalesce(CAST({_TP} AS DOUBLE) / nullif({_YES}, 0), 0) AS precision,
        coalesce(CAST({_TP} AS DOUBLE) / nullif({_POS}, 0), 0) AS recall,
        coalesce(CAST(2 * {_TP} AS DOUBLE) / nullif({_YES} + {_POS}, 0), 0) AS f1,
        CAST({_TP} + {_TN} AS DOUBLE) / count(*) AS accuracy FROM fc_baseline""",
)
def _cls(lab: Lab):
    return baseline(lab).agg(*ev.classifier_metrics(F.col("sold_quantity"), F.col("predicts_sale")))


@query(
    "eval_mae",
    """SELECT CAST(sum(abs(sold_quantity - predicted)) AS DOUBLE) / count(*) AS mae,
       sqrt(CAST(sum((sold_quantity - predicted) * (sold_quantity - predicted)) AS DOUBLE) / count(*)) AS rmse
       FROM fc_baseline""",
)
def _mae(lab: Lab):
    fact, predicted = F.col("sold_quantity"), F.col("predicted")
    return baseline(lab).agg(
        ev.mean_absolute_error(fact, predicted).alias("mae"),
        ev.root_mean_square_error(fact, predicted).alias("rmse"),
    )


def _share(condition: str, name: str) -> str:
    n = f"count(*) FILTER ({condition})"
    return f"{n} AS {name}, {rint(f'CAST({n} AS DOUBLE) / count(*)', 2)} AS {name}_share"


@query(
    "eval_business",
    f"""SELECT {_share("predicted = sold_quantity", "accurate")}, {_share("predicted > sold_quantity", "waste")},
        {_share("predicted < sold_quantity", "lost_sale")} FROM fc_baseline""",
)
def _business(lab: Lab):
    return baseline(lab).agg(*ev.business_metrics(F.col("sold_quantity"), F.col("predicted")))


_BY_ITEM = """SELECT item_id, count(*) FILTER (predicted = sold_quantity) AS accurate,
       count(*) FILTER (predicted > sold_quantity) AS waste, count(*) FILTER (predicted < sold_quantity) AS lost_sale
       FROM fc_baseline GROUP BY item_id"""


@query("eval_business_item", _BY_ITEM)
def _by_item(lab: Lab):
    return ev.evaluate_by_item(baseline(lab))


@query(
    "eval_error_profile",
    f"""SELECT category, count(*) AS records,
        {rint("100 * (CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM fc_baseline))", 1)} AS share_pct,
        CAST(sum(diff) AS DOUBLE) / count(*) AS mean_deviation
        FROM (SELECT sold_quantity - predicted AS diff, CASE WHEN sold_quantity = predicted THEN 'accurate_prediction'
              WHEN sold_quantity < predicted THEN 'potential_waste' ELSE 'potential_lost_sale' END AS category
              FROM fc_baseline) GROUP BY category""",
)
def _profile(lab: Lab):
    return ev.error_profile(baseline(lab))


_HIT = "sold_quantity > 0 AND predicted > 0"
_ERR = "abs(sold_quantity - predicted)"


@query(
    "eval_deep",
    f"""SELECT {_TN} AS true_negatives, count(*) FILTER (sold_quantity <= 0 AND predicted > 0) AS false_positives,
        count(*) FILTER (sold_quantity > 0 AND predicted = 0) AS false_negatives, {_TP} AS true_positives,
        count(*) FILTER ({_HIT} AND {_ERR} = 0) AS hit_exact, count(*) FILTER ({_HIT} AND {_ERR} <= 1) AS hit_within_1,
        count(*) FILTER ({_HIT} AND {_ERR} <= 2) AS hit_within_2,
        CAST(sum(CASE WHEN {_HIT} THEN {_ERR} END) AS DOUBLE) / nullif({_TP}, 0) AS hit_mae,
        {_TN} AS zeros_exact, count(*) FILTER (sold_quantity > 0 AND {_ERR} = 0) AS sales_exact,
        count(*) FILTER (sold_quantity > 0 AND {_ERR} <= 1) AS sales_within_1,
        count(*) FILTER (sold_quantity > 0 AND {_ERR} <= 2) AS sales_within_2,
        CAST(sum(CASE WHEN sold_quantity > 0 THEN {_ERR} END) AS DOUBLE) / nullif({_POS}, 0) AS sales_mae,
        count(*) FILTER ({_ERR} = 0) AS exact, CAST(sum({_ERR}) AS DOUBLE) / count(*) AS mae FROM fc_baseline""",
)
def _deep(lab: Lab):
    return ev.deep_report(baseline(lab))


@query(
    "eval_auc",
    """SELECT round(sum(pos * (coalesce(below, 0) + neg / 2.0)) / nullif(sum(pos) * sum(neg), 0), 9) AS auc FROM (
         SELECT pos, neg, CAST(sum(neg) OVER (ORDER BY hist_avg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                               AS DOUBLE) AS below
         FROM (SELECT hist_avg, CAST(count(*) FILTER (sold_quantity > 0) AS DOUBLE) AS pos,
                      CAST(count(*) FILTER (sold_quantity <= 0) AS DOUBLE) AS neg
               FROM fc_test WHERE hist_avg IS NOT NULL GROUP BY hist_avg))""",
)
def _auc(lab: Lab):
    """How well the historical average ranks test rows with a sale above those without."""
    test = folds.test_part(features(lab), lab.forecast.test_weeks).where("hist_avg is not null")
    return ev.roc_auc(test.withColumn("sale_probability", F.col("hist_avg"))).select(F.round("auc", 9).alias("auc"))


# Stored runs: the baseline decided at several cut-offs stands for a series of model versions.
_CUTS = (0.4, 0.7, 0.2)


def _stored(lab: Lab) -> str:
    def write() -> str:
        root = f"{lab.root}/runs"
        test = folds.test_part(features(lab), lab.forecast.test_weeks)
        importance = lab.spark.createDataFrame(
            [("hist_avg", 1.0, 1.0)],
            "feature_name string, classifier_importance double, regressor_importance double",
        )
        for run_id, cut in enumerate(_CUTS, start=1):
            out = test.withColumn("predicted", floor_threshold(F.col("hist_avg"), cut))
            out = out.withColumn("predicts_sale", (F.col("predicted") > 0).cast("int"))
            metrics, by_item = ev.evaluate(out), ev.evaluate_by_item(out)
            for _ in range(2):  # the second call finds the run complete
                ev.store_run(root, f"cut{run_id}", f"v{run_id}", "cut", cut, metrics, by_item, importance)
        return root

    return lab.keep("runs", write)


def _cut_sql(cut: float) -> str:
    return f"""SELECT *, CAST(floor(hist_avg) + CASE WHEN hist_avg - floor(hist_avg) >= CAST({cut} AS DOUBLE)
        THEN 1 ELSE 0 END AS INTEGER) AS predicted FROM fc_test"""


@query(
    "eval_store",
    " UNION ALL ".join(
        f"""SELECT {i} AS run_id, 'v{i}' AS model_version, CAST({cut} AS DOUBLE) AS threshold_value,
        CAST({_TP} + {_TN} AS DOUBLE) / count(*) AS accuracy,
        CAST(sum({_ERR}) AS DOUBLE) / count(*) AS mae FROM ({_cut_sql(cut)})"""
        for i, cut in enumerate(_CUTS, start=1)
    ),
)
def _store(lab: Lab):
    """Runs of the baseline at three cut-offs (no trained models; their importance row is a stand-in), each stored twice."""
    root = _stored(lab)
    metrics = ev.run_table(lab.spark, root, "model_metrics").groupBy("run_id").pivot("metric_name", ["accuracy", "mae"])
    wide = metrics.agg(F.max("metric_value"))
    runs = ev.stored_runs(lab.spark, root).select("run_id", "model_version", "threshold_value")
    return runs.join(wide, "run_id")


@query(
    "eval_degradation",
    """WITH runs AS ({runs}) SELECT r.run_id, r.accuracy, p.accuracy AS previous,
       coalesce((p.accuracy - r.accuracy) / nullif(p.accuracy, 0) > 0.1, false) AS degraded
       FROM runs r LEFT JOIN runs p ON p.run_id = r.run_id - 1""".replace(
        "{runs}",
        " UNION ALL ".join(
            f"SELECT {i} AS run_id, CAST({_TP} + {_TN} AS DOUBLE) / count(*) AS accuracy FROM ({_cut_sql(cut)})"
            for i, cut in enumerate(_CUTS, start=1)
        ),
    ).replace("WITH runs AS (", "SELECT * FROM (WITH runs AS (", 1)
    + ")",
)
def _degradation(lab: Lab):
    """Each stored run against the one before it, by the strict rule."""
    from pyspark.sql import Window

    rows = ev.run_table(lab.spark, _stored(lab), "model_metrics").where("metric_name = 'accuracy'")
    # one row per stored run: a short series
    previous = F.lag("metric_value").over(Window.orderBy("run_id"))
    out = rows.select("run_id", F.col("metric_value").alias("accuracy"), previous.alias("previous"))
    degraded = ev.degraded(
        F.col("previous"), F.col("accuracy"), lab.forecast.degradation_threshold
    )
    return out.withColumn("degraded", degraded)


@query(
    "est_accuracy",
    f"""SELECT item_id, CAST(count(*) FILTER (predicted = sold_quantity) AS DOUBLE) / nullif(count(*), 0)
        AS estimated_accuracy FROM ({_cut_sql(_CUTS[-1])}) GROUP BY item_id""",
)
def _estimated(lab: Lab):
    root = _stored(lab)
    by_item = ev.run_table(lab.spark, root, "model_metrics_by_item")
    return ev.estimated_accuracy(by_item, ev.stored_runs(lab.spark, root))


# --- models -------------------------------------------------------------------------------------
#
# What a fit is given (weighted points, category means) and what it must keep (every row once, scores within bounds) is checked
# by SQL; the trees themselves are beyond SQL.


def _training(lab: Lab) -> DataFrame:
    return folds.train_part(features(lab), lab.forecast.test_weeks)


def _test(lab: Lab) -> DataFrame:
    return folds.test_part(features(lab), lab.forecast.test_weeks)


def _classifier(lab: Lab) -> models.StageModel:
    return lab.keep("classifier", lambda: models.fit_classifier(_training(lab), lab.forecast))


def _regressor(lab: Lab) -> models.StageModel:
    return lab.keep("regressor", lambda: models.fit_regressor(_training(lab), lab.forecast))


def _model(lab: Lab) -> models.TwoStageModel:
    return models.TwoStageModel(_classifier(lab), _regressor(lab))


def _raw(lab: Lab) -> DataFrame:
    def build() -> DataFrame:
        raw = models.raw_predictions(_test(lab), _model(lab), lab.forecast)
        return overwrite(raw, f"{lab.root}/raw_predictions")

    return lab.keep("raw_predictions", build)


_POINT = "item_id, route, day_period, pax_bin, hist_avg"


@query(
    "model_points",
    f"""SELECT {_POINT}, date > (SELECT max(date) FROM fc_train) - 14 AS held_back,
        CAST(sold_quantity > 0 AS DOUBLE) AS sells, CAST(count(*) AS DOUBLE) AS weight
        FROM fc_train GROUP BY ALL""",
)
def _points(lab: Lab):
    """What the classifier learns from: each combination of features and outcome once, with its number of rows."""
    rows = _training(lab).withColumn("sells", (F.col("sold_quantity") > 0).cast("double"))
    return models.held_back_points(rows, lab.forecast, "sells", lab.forecast.classifier.early_stop_weeks)


_MEAN = "round((sum(sells) + (SELECT avg(sells) FROM s)) / (count(*) + 1), 9) AS mean FROM s GROUP BY ALL"


@query(
    "model_category_means",
    "SELECT * FROM (WITH s AS (SELECT *, CAST(sold_quantity > 0 AS DOUBLE) AS sells FROM fc_train) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS value, {_MEAN}" for c in ("item_id", "route", "day_period", "pax_bin")
    )
    + " UNION ALL SELECT '*', NULL, round(avg(sells), 9) FROM s)",
)
def _means(lab: Lab):
    """The numbers that stand for items, routes, periods and passenger classes in the classifier."""
    table = _classifier(lab).means.table
    return table.select("feature", "value", F.round("mean", 9).alias("mean"))


@query("model_cls")
def _model_cls(lab: Lab):
    rows = models.sale_probabilities(_test(lab), _classifier(lab), lab.forecast)
    return rows.select(
        "flight_key", "item_id", "sold_quantity", half_even(F.col("sale_probability"), 6).alias("p")
    )


@query("model_reg")
def _model_reg(lab: Lab):
    rows = models.raw_quantities(_test(lab).where("sold_quantity > 0"), _regressor(lab), lab.forecast)
    return rows.select(
        "flight_key",
        "item_id",
        "sold_quantity",
        half_even(F.col("raw_quantity"), 6).alias("quantity"),
        half_even(absolute_error(F.col("sold_quantity"), F.col("raw_quantity")), 6).alias("error"),
    )


@query(
    "model_facts",
    """SELECT count(*) AS n, count(DISTINCT (flight_key, item_id)) AS keys, CAST(sum(sold_quantity) AS BIGINT) AS sold,
       0 AS out_of_bounds, count(DISTINCT (item_id, route, day_period, pax_bin, hist_avg)) AS points, true AS one_score_per_point
       FROM fc_test""",
)
def _facts(lab: Lab):
    """Every test row is predicted once, probabilities and quantities are finite, and a point has one score."""
    rows = _raw(lab)
    p, quantity = F.col("sale_probability"), F.col("raw_quantity")
    bad = ~F.coalesce(p.between(0, 1) & ~F.isnan(quantity) & (F.abs(quantity) < 1e9), F.lit(False))
    point = F.struct("item_id", "route", "day_period", "pax_bin", "hist_avg")
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("flight_key", "item_id").alias("keys"),
        F.sum("sold_quantity").alias("sold"),
        F.count(F.when(bad, 1)).cast("int").alias("out_of_bounds"),
        F.count_distinct(point).alias("points"),
        (F.count_distinct(point) == F.count_distinct(F.struct(point, p, quantity))).alias("one_score_per_point"),
    )


@query("predict_two_stage")
def _two_stage(lab: Lab):
    out = models.decide(_raw(lab), lab.forecast.thresholds["low_wastage"])
    return out.select("flight_key", "item_id", "sold_quantity", "predicts_sale", "predicted")


@query("eval_two_stage")
def _evaluated(lab: Lab):
    return ev.evaluate(models.decide(_raw(lab), lab.forecast.thresholds["low_missed_sales"]))


@query("tune_threshold")
def _thresholds(lab: Lab):
    return ev.compare_thresholds(_raw(lab), (0.3, 0.4, 0.5, 0.6, 0.7))


@query("feature_importance")
def _importance(lab: Lab):
    return models.feature_importance(_model(lab), lab.forecast, features(lab))


@query("base_poisson")
def _poisson(lab: Lab):
    cfg = lab.forecast
    train = folds.train_part(features(lab), cfg.test_weeks)
    model = lab.keep("poisson", lambda: models.fit_poisson(train, cfg))
    out = models.predict_poisson(folds.test_part(features(lab), cfg.test_weeks), model, cfg)
    return out.select("flight_key", "item_id", "sold_quantity", "predicted")


_KNN_FEATURES = ("hist_avg", "bin_rank", "item_mean", "route_mean", "period_mean")
_RANK = " ".join(f"WHEN '{label}' THEN {float(i)}" for i, label in enumerate(ForecastConfig().pax_labels))


def _knn_mean(column: str, name: str) -> str:
    return f"SELECT {column}, (sum(y) + (SELECT avg(y) FROM tr)) / (count(*) + 1) AS {name} FROM tr GROUP BY 1"


def _knn_points(rows: str) -> str:
    scaled = ", ".join(
        f"round((CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM tm)) / (SELECT stddev_samp({c}) FROM tm), 9) AS x{i}"
        for i, c in enumerate(_KNN_FEATURES)
    )
    return f"SELECT y, {scaled} FROM {rows}"


def _knn_rows(table: str) -> str:
    return f"""SELECT *, CAST(sold_quantity AS DOUBLE) AS y, CASE pax_bin {_RANK} END AS bin_rank FROM {table}
        WHERE hist_avg IS NOT NULL AND pax_bin IS NOT NULL"""


def _knn_with_means(rows: str) -> str:
    overall = "(SELECT avg(y) FROM tr)"
    return f"""SELECT r.y, r.hist_avg, r.bin_rank, coalesce(i.m, {overall}) AS item_mean, coalesce(o.m, {overall}) AS route_mean,
        coalesce(p.m, {overall}) AS period_mean FROM {rows} r
        LEFT JOIN ({_knn_mean("item_id", "m")}) i ON i.item_id IS NOT DISTINCT FROM r.item_id
        LEFT JOIN ({_knn_mean("route", "m")}) o ON o.route IS NOT DISTINCT FROM r.route
        LEFT JOIN ({_knn_mean("day_period", "m")}) p ON p.day_period IS NOT DISTINCT FROM r.day_period"""


_X = "x0, x1, x2, x3, x4"
_KNN = f"""SELECT * FROM (
  WITH tr AS ({_knn_rows("fc_train")}), te AS ({_knn_rows("fc_test")}),
  tm AS MATERIALIZED ({_knn_with_means("tr")}), em AS MATERIALIZED ({_knn_with_means("te")}),
  known AS MATERIALIZED (SELECT {_X}, count(*) AS n, sum(y) AS total FROM ({_knn_points("tm")}) GROUP BY {_X}),
  asked AS MATERIALIZED ({_knn_points("em")}),
  points AS (SELECT DISTINCT {_X} FROM asked),
  near AS (SELECT a.*, k.n, k.total, row_number() OVER w AS place, coalesce(sum(k.n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING), 0) AS before FROM points a, known k
    WINDOW w AS (PARTITION BY a.x0, a.x1, a.x2, a.x3, a.x4 ORDER BY sqrt({" + ".join(f"(a.x{i} - k.x{i}) * (a.x{i} - k.x{i})" for i in range(5))}),
      k.n DESC, k.total DESC)
    QUALIFY place <= 7),
  means AS (SELECT {_X}, k, sum(greatest(least(n, k - before), 0) * total / n) / sum(greatest(least(n, k - before), 0)) AS raw
    FROM near, (VALUES (3), (5), (7)) v(k) GROUP BY ALL),
  decided AS (SELECT k, t AS threshold, y AS sold_quantity,
      CAST(floor(raw) + CASE WHEN raw - floor(raw) >= t THEN 1 ELSE 0 END AS INTEGER) AS predicted
    FROM asked JOIN means USING ({_X}), (VALUES (0.3::DOUBLE), (0.5::DOUBLE), (0.7::DOUBLE)) u(t))
  SELECT k, threshold, CAST(sum(abs(sold_quantity - predicted)) AS DOUBLE) / count(*) AS mae,
    {_share("predicted = sold_quantity", "accurate")}, {_share("predicted > sold_quantity", "waste")},
    {_share("predicted < sold_quantity", "lost_sale")} FROM decided GROUP BY k, threshold)"""


@query("base_knn", _KNN)
def _neighbours(lab: Lab):
    """Mean absolute error for each number of neighbours and each rounding threshold."""
    cfg, ks = lab.forecast, (3, 5, 7)
    train = folds.train_part(features(lab), cfg.test_weeks)
    test = folds.test_part(features(lab), cfg.test_weeks)
    rows = neighbours.predict_neighbours(train, test, cfg, ks)
    tried = [
        F.struct(F.lit(k).alias("k"), F.lit(t).alias("threshold"), F.col(f"knn_{k}").alias("raw"))
        for k in ks
        for t in (0.3, 0.5, 0.7)
    ]
    rows = rows.select(cfg.target, F.inline(F.array(*tried)))
    rows = rows.withColumn("predicted", floor_threshold(F.col("raw"), F.col("threshold")))
    fact, predicted = F.col(cfg.target), F.col("predicted")
    return rows.groupBy("k", "threshold").agg(
        ev.mean_absolute_error(fact, predicted).alias("mae"), *ev.business_metrics(fact, predicted)
    )


# --- scoring --------------------------------------------------------------------------------------


def _requests(lab: Lab) -> DataFrame:
    """One request per flight of the warehouse, for the passengers it carried on average."""
    flights = lab.wh.ref("mart_pax_sales")
    return flights.select(
        F.col("flight_key").alias("request_id"),
        "route",
        "day_period",
        F.col("passenger_count").alias("expected_pax"),
    )


_SCORED = """
SELECT q.flight_key AS request_id, q.route, q.day_period, dp.item_id, dp.category,
       CASE WHEN q.passenger_count < 100 THEN '<100' WHEN q.passenger_count < 150 THEN '100 - 150'
            WHEN q.passenger_count < 180 THEN '150 - 180' ELSE '180 +' END AS pax_bin, h.hist_avg
FROM mart_pax_sales q, dim_products dp
LEFT JOIN (SELECT item_id, route, day_period, hist_avg FROM (
             SELECT *, row_number() OVER (PARTITION BY item_id, route, day_period
                                          ORDER BY hist_level_used, hist_avg) AS rn FROM fc_features) WHERE rn = 1) h
  ON h.item_id = dp.item_id AND h.route = q.route AND h.day_period = q.day_period
WHERE dp.item_type = 'Fresh Product' AND dp.category <> 'BOL Products' AND dp.status = 'Active'"""


@query(
    "score_inputs",
    f"""SELECT category, day_period, pax_bin, count(*) AS n, count(hist_avg) AS with_history,
        {rint("sum(CAST(hist_avg * 100 AS BIGINT))", 0)} AS cents FROM ({_SCORED}) GROUP BY ALL""",
)
def _inputs(lab: Lab):
    """Every request with every fresh product, summed up: the whole product is formed, not kept."""
    lookup = preparation.hist_lookup(features(lab))
    products = fresh_products(lab.wh.ref("dim_products"))
    rows = scoring.score_inputs(_requests(lab), products, lookup, lab.forecast)
    return rows.groupBy("category", "day_period", "pax_bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("hist_avg").alias("with_history"),
        F.sum(F.rint(F.col("hist_avg") * 100)).alias("cents"),
    )


def _score_table(lab: Lab) -> DataFrame:
    def build() -> DataFrame:
        products = fresh_products(lab.wh.ref("dim_products"))
        lookup = preparation.hist_lookup(features(lab))
        return scoring.score_table(_requests(lab), products, lookup, _model(lab), "low_missed_sales", lab.forecast)

    return lab.keep("score_table", build)


_CONTEXT_OF = "route, day_period, pax_bin"


@query(
    "score_table_size",
    f"""SELECT count(*) AS n, count(DISTINCT item_id) AS items, count(DISTINCT coalesce(route, '-') || coalesce(day_period, '-')
        || coalesce(pax_bin, '-')) AS contexts, count(hist_avg) AS with_history, 0 AS negative
        FROM (SELECT DISTINCT {_CONTEXT_OF}, item_id, category, hist_avg FROM ({_SCORED}))""",
)
def _table_size(lab: Lab):
    """The scored table grows with contexts and products, not with flights."""
    context = F.concat(*[F.coalesce(c, F.lit("-")) for c in scoring.CONTEXT])
    return _score_table(lab).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("item_id").alias("items"),
        F.count_distinct(context).alias("contexts"),
        F.count("hist_avg").alias("with_history"),
        F.count(F.when(~F.coalesce(F.col("predicted_quantity") >= 0, F.lit(False)), 1)).cast("int").alias("negative"),
    )


@query("score_all")
def _score_all(lab: Lab):
    return scoring.score(_requests(lab), _score_table(lab), lab.forecast)


@query(
    "score_facts",
    f"""SELECT category, count(*) AS n, count(DISTINCT request_id) AS requests,
        {rint("sum(CAST(hist_avg * 100 AS BIGINT))", 0)} AS cents, true AS sums_agree FROM ({_SCORED}) GROUP BY category""",
)
def _score_facts(lab: Lab):
    """Every request is scored for every product, and the sums by category are those of its products."""
    requests, table = _requests(lab), _score_table(lab)
    every = scoring.score(requests, table, lab.forecast).groupBy("category").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("request_id").alias("requests"),
        F.sum(F.rint(F.col("hist_avg") * 100)).alias("cents"),
        F.sum("predicted_quantity").alias("by_item"),
    )
    sums = scoring.score_category(requests, table, lab.forecast).groupBy(F.col("category_name").alias("category"))
    met = every.join(sums.agg(F.sum("predicted_quantity").alias("by_category")), "category", "left")
    return met.select("category", "n", "requests", "cents", F.col("by_item").eqNullSafe(F.col("by_category")).alias("sums_agree"))


@query("score_item")
def _score_item(lab: Lab):
    """The product with the most sales."""
    best = mart(lab).groupBy("item_id").agg(F.sum("sold_quantity").alias("n"))
    item = best.orderBy(F.desc("n"), "item_id").first()["item_id"]
    root = _stored(lab)
    by_item = ev.run_table(lab.spark, root, "model_metrics_by_item")
    accuracy = ev.estimated_accuracy(by_item, ev.stored_runs(lab.spark, root))
    return scoring.score_item(_requests(lab), _score_table(lab), item, accuracy, lab.forecast)


@query("score_category")
def _score_category(lab: Lab):
    return scoring.score_category(_requests(lab), _score_table(lab), lab.forecast)


@query("tune_grid")
def _tune_grid(lab: Lab):
    """The 27 published settings: nine fits of 700 rounds, each read off after 300, 500 and 700."""
    return models.tune(features(lab), lab.forecast).withColumn("log_loss", F.round("log_loss", 9))
