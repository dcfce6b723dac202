import dataclasses
import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from skygalley.config import BoostingConfig, ForecastConfig
from skygalley.errors import ValidationError
from skygalley.forecast import evaluation as ev
from skygalley.forecast import encoding, folds, models, neighbours, preparation, rounds, scoring
from skygalley.forecast.run import run_forecast
from skygalley.operators import joins

CFG = ForecastConfig()
D0 = datetime.date(2025, 11, 1)
SALES = "item_id string, route string, day_period string, is_night boolean, sold_quantity int"


def hist(spark, rows, least):
    out = preparation.with_hist_avg(spark.createDataFrame(rows, SALES), least).collect()
    return {(r.item_id, r.route, r.day_period): (r.hist_level_used, r.hist_avg) for r in out}


def test_level_one_when_enough(spark):
    got = hist(spark, [("i", "r", "Day", False, 3)] * 5, 3)
    assert got == {("i", "r", "Day"): (1, 3.0)}


def test_fallback_to_item(spark):
    rows = [("i", "r1", "Day", False, 10), ("i", "r2", "Night", True, 20), ("i", "r3", "Morning", False, 30)]
    assert set(hist(spark, rows, 5).values()) == {(4, 20.0)}


def test_middle_levels(spark):
    rows = [("i", "r", "Day", False, 1)] * 2 + [("i", "r", "Morning", False, 4)] * 3
    got = hist(spark, rows, 3)
    assert got[("i", "r", "Morning")] == (1, 4.0)
    assert got[("i", "r", "Day")] == (2, 2.8)
    rows = [("i", f"r{n}", "Day", False, n) for n in range(4)]
    assert set(hist(spark, rows, 4).values()) == {(3, 1.5)}


def test_missing_key_part_skips_its_levels(spark):
    rows = [("i", None, "Day", False, 2)] * 9 + [("i", "r", None, False, 4)] * 9
    got = hist(spark, rows, 5)
    assert got[("i", None, "Day")] == (3, 2.0)
    assert got[("i", "r", None)] == (2, 4.0)


def test_hot_item_against_brute_force(spark):
    """One item on most rows; every average is recomputed in plain Python."""
    rows = []
    for n in range(3000):
        hot = n % 3 != 0
        item = "hot" if hot else f"i{n % 50}"
        rows.append((item, f"r{n % 17}", ("Day", "Night", "Morning")[n % 3], n % 3 == 1, n % 7))
    got = hist(spark, rows, 5)

    def level(row, keys):
        same = [r[4] for r in rows if all(r[k] == row[k] for k in keys)]
        return len(same), sum(same) / len(same)

    for row in rows[:200]:
        for i, keys in enumerate(((0, 1, 2), (0, 1, 3), (0, 2), (0,)), start=1):
            n, mean = level(row, keys)
            if n >= 5 or i == 4:
                assert got[row[:3]][0] == i
                assert math.isclose(got[row[:3]][1], round(mean, 2), abs_tol=0.0051)
                break


def dated(spark, days):
    rows = [(D0 + datetime.timedelta(days=d), "i", "r", "Day", False, d) for d in days]
    return spark.createDataFrame(rows, "date date, " + SALES)


def test_folds_skip_first_block_and_lone_last_day(spark):
    got = folds.with_folds(dated(spark, range(0, 29)), 14).select("block", "fold_num").distinct().collect()
    # day 28 opens block 2 and is the last day: no fold for it
    assert sorted((r.block, r.fold_num) for r in got if r.fold_num) == [(1, 1)]
    got = folds.with_folds(dated(spark, range(0, 30)), 14).select("block", "fold_num").distinct().collect()
    assert sorted((r.block, r.fold_num) for r in got if r.fold_num) == [(1, 1), (2, 2)]


def test_folds_count_existing_blocks(spark):
    got = folds.with_folds(dated(spark, [0, 1, 40, 50]), 14).select("block", "fold_num").distinct().collect()
    assert sorted((r.block, r.fold_num) for r in got if r.fold_num) == [(2, 1), (3, 2)]


def test_history_is_earlier_blocks_only(spark):
    out = folds.expanding_hist_avg(folds.with_folds(dated(spark, range(0, 30)), 14), 5)
    got = {r.fold_num: (r.hist_avg, r.hist_level_used) for r in out.collect()}
    assert got == {1: (sum(range(14)) / 14, 1), 2: (sum(range(28)) / 28, 1)}


def test_split(spark):
    df = dated(spark, range(0, 30))
    assert folds.train_part(df, 2).count() == 16 and folds.test_part(df, 2).count() == 14


def mart(spark):
    return spark.createDataFrame(
        [("f", "i", None, 1), ("f", "i", None, 1), ("g", "i", "no_pax_data", 2)],
        "flight_key string, item_id string, potential_error string, sold_quantity int",
    )


def test_clean(spark):
    out = preparation.clean_data(mart(spark))
    assert out.columns == ["flight_key", "item_id", "sold_quantity"] and out.count() == 1
    assert {tuple(r) for r in preparation.error_counts(mart(spark)).collect()} == {("no_pax_data", 1)}
    with pytest.raises(ValidationError, match="no rows"):
        preparation.clean_data(mart(spark).where("flight_key = 'g'"))


def valid(spark, **change):
    row = {
        "flight_key": "f",
        "origin": "a",
        "destination": "b",
        "date": D0,
        "item_id": "i",
        "sold_quantity": 1,
        "number_of_passengers": 100,
        "is_night": False,
        "hist_avg": 1.0,
        "hist_level_used": 1,
    } | change
    kinds = (
        "flight_key string, origin string, destination string, date date, item_id string, sold_quantity int,"
        " number_of_passengers int, is_night boolean, hist_avg double, hist_level_used int"
    )
    return spark.createDataFrame([tuple(row.values())], kinds)


@pytest.mark.parametrize(
    ("change", "message"),
    [
        ({"origin": None}, "missing values"),
        ({"sold_quantity": -1}, "below zero"),
        ({"hist_avg": None}, "without a historical"),
        ({"hist_level_used": 5}, "levels outside"),
        ({"hist_level_used": None}, "levels outside"),
        ({"date": datetime.date(2025, 10, 31)}, "is not within"),
        ({"date": datetime.date(2026, 3, 1)}, "is not within"),
    ],
)
def test_validation(spark, change, message):
    preparation.validate(valid(spark), CFG)
    with pytest.raises(ValidationError, match=message):
        preparation.validate(valid(spark, **change), CFG)


def test_validation_of_columns_and_types(spark):
    with pytest.raises(ValidationError, match="absent"):
        preparation.validate(valid(spark).drop("origin"), CFG)
    text = valid(spark).withColumn("sold_quantity", F.col("sold_quantity").cast("string"))
    with pytest.raises(ValidationError, match="no number"):
        preparation.validate(text, CFG)


@pytest.mark.parametrize(
    ("previous", "current", "degraded"),
    [(0.85, 0.84, False), (0.90, 0.80, True), (0.90, 0.81, False), (None, 0.5, False), (0.8, 0.9, False), (0.0, 0.5, False)],
)
def test_degradation(previous, current, degraded):
    assert ev.is_degraded(previous, current, 0.1)[0] is degraded


def test_evaluation_counts(spark):
    rows = [("i", 0, 0, 0), ("i", 1, 1, 1), ("j", 2, 0, 0), ("j", 1, 3, 1)]
    df = spark.createDataFrame(rows, "item_id string, sold_quantity int, predicted int, predicts_sale int")
    got = ev.evaluate(df).first()
    assert (got.precision, got.accuracy, got.mae) == (1.0, 0.75, 1.0)
    assert math.isclose(got.recall, 2 / 3) and math.isclose(got.f1, 0.8)
    assert (got.accurate, got.waste, got.lost_sale, got.accurate_share) == (2, 1, 1, 0.5)
    assert ev.metric_rows(ev.evaluate(df)).count() == 11
    none = df.withColumn("predicts_sale", F.lit(0))
    assert ev.evaluate(none).first().precision == 0.0


def test_every_request_meets_every_product(spark):
    requests = spark.range(100).select(F.col("id").cast("string").alias("request_id"))
    products = spark.createDataFrame([(f"p{i}", "c") for i in range(7)], "item_id string, category string")
    out = scoring.with_products(requests, products, ["request_id"])
    assert out.count() == 700 and out.distinct().count() == 700


REQUESTS = "request_id string, route string, day_period string, expected_pax int"


def test_scores_are_joined_from_few_points(spark):
    """A thousand requests in three contexts, one of them without a route, meet 3 x 5 scored points."""
    rows = [(f"q{n}", None if n % 3 == 2 else "r", "Day", 50 if n % 3 else 170) for n in range(1000)]
    requests = spark.createDataFrame(rows, REQUESTS)
    products = spark.createDataFrame([(f"p{i}", f"c{i % 2}") for i in range(5)], "item_id string, category string")
    lookup = spark.createDataFrame(
        [("p1", "r", "Day", 2.5, 1)], "item_id string, route string, day_period string, hist_avg double, hist_level_used int"
    )
    points = scoring.point_inputs(requests, products, lookup, CFG)
    assert points.count() == 15 and points.where("hist_avg = 2.5").count() == 2
    table = points.drop("expected_pax").withColumn("predicted_quantity", F.length("item_id") + F.length("pax_bin"))
    scores = scoring.score(requests, table, CFG)
    assert scores.count() == 5000 and scores.select("request_id", "item_id").distinct().count() == 5000
    by_category = scoring.score_category(requests, table, CFG)
    assert by_category.count() == 2000
    wanted = scores.groupBy("request_id", "category").agg(F.sum("predicted_quantity").alias("n"))
    assert sorted(map(tuple, by_category.collect())) == sorted(map(tuple, wanted.collect()))
    accuracy = spark.createDataFrame([("p1", 0.5)], "item_id string, estimated_accuracy double")
    one = scoring.score_item(requests, table, "p1", accuracy, CFG)
    assert one.count() == 1000 and one.where("historical_average = 2.5").count() == sum(r[1] is not None for r in rows)


FEATURES = "item_id string, route string, day_period string, pax_bin string, hist_avg double, sold_quantity int, date date"


def learnable(spark, n=400, days=60):
    """Item a sells nearly always, item b nearly never, and the quantity follows the average."""
    rng = random.Random(11)
    rows = []
    for k in range(n):
        item = "ab"[k % 2]
        sells = rng.random() < (0.9 if item == "a" else 0.1)
        hist = float(k % 5)
        day = D0 + datetime.timedelta(days=k % days)
        quantity = int(hist) + 1 if sells else 0
        rows.append((item, f"r{k % 3}" if k % 7 else None, "Day", "<100", hist if k % 11 else None, quantity, day))
    return spark.createDataFrame(rows, FEATURES)


def test_category_means(spark, tmp_path):
    points = spark.createDataFrame(
        [("a", 1.0, 3.0), ("a", 0.0, 1.0), ("b", 0.0, 4.0), (None, 1.0, 2.0)], "c string, y double, weight double"
    )
    means = encoding.CategoryMeans.fit(points, ["c"], "y", str(tmp_path / "means"))
    asked = spark.createDataFrame([("a",), ("b",), (None,), ("new",)], "c string")
    got = {r.c: r.c_mean for r in means.join(asked, ["c"]).collect()}
    assert {k: round(v, 9) for k, v in got.items()} == {"a": 0.7, "b": 0.1, None: round(2.5 / 3, 9), "new": 0.5}


def test_points_stand_for_their_rows(spark):
    rows = learnable(spark).withColumn("sells", (F.col("sold_quantity") > 0).cast("double"))
    points = models.held_back_points(rows, CFG, "sells", 2)
    assert points.agg(F.sum("weight")).first()[0] == 400 and points.count() < 250
    late = rows.where(F.col("date") > folds.cutoff(rows, 2)).count()
    assert points.where("held_back").agg(F.sum("weight")).first()[0] == late


def test_models_learn_and_stop(spark):
    """The rounds end long before the maximum, and both stages find what is in the data."""
    cfg = dataclasses.replace(
        CFG,
        classifier=BoostingConfig(learning_rate=0.3, depth=2, early_stop_patience=3),
        regressor=BoostingConfig(iterations=6, learning_rate=0.5, depth=3, early_stop_weeks=None),
    )
    rows = learnable(spark)
    model = models.TwoStageModel(models.fit_classifier(rows, cfg), models.fit_regressor(rows, cfg))
    assert 1 <= model.classifier.trees.getNumTrees < 100
    assert model.regressor.trees.getNumTrees == 6
    got = models.raw_predictions(rows, model, cfg)
    assert got.count() == 400 and got.columns == [*rows.columns, "sale_probability", "raw_quantity"]
    p = {r.item_id: r.p for r in got.groupBy("item_id").agg(F.avg("sale_probability").alias("p")).collect()}
    assert p["a"] > 0.6 > 0.4 > p["b"]
    error = got.where("sold_quantity > 0 and hist_avg is not null")
    assert error.agg(F.avg(F.abs(F.col("raw_quantity") - F.col("sold_quantity")))).first()[0] < 0.5
    points = got.select("item_id", "route", "day_period", "pax_bin", "hist_avg")
    assert got.select(points.columns + ["sale_probability", "raw_quantity"]).distinct().count() == points.distinct().count()
    importance = models.feature_importance(model, cfg, rows).collect()
    assert max(importance, key=lambda r: r.classifier_importance).feature_name == "item_id"


def test_models_are_saved_and_loaded(spark, tmp_path):
    rounds = BoostingConfig(iterations=2, depth=2, early_stop_weeks=None)
    cfg = dataclasses.replace(CFG, classifier=rounds, regressor=rounds)
    rows = learnable(spark, 60)
    model = models.TwoStageModel(models.fit_classifier(rows, cfg), models.fit_regressor(rows, cfg))
    model.save(str(tmp_path))
    again = models.TwoStageModel.load(spark, str(tmp_path))
    first, second = (models.raw_predictions(rows, m, cfg).collect() for m in (model, again))
    assert sorted(map(str, first)) == sorted(map(str, second))


def test_short_histories_run_all_rounds(spark):
    """All rows within the weeks to hold back: nothing is held back."""
    rounds = BoostingConfig(iterations=3, depth=2)
    cfg = dataclasses.replace(CFG, classifier=rounds)
    assert models.fit_classifier(learnable(spark, 60, days=5), cfg).trees.getNumTrees == 3


def test_first_rounds_of_a_long_fit_are_a_short_fit(spark):
    rows = learnable(spark)
    grid = [BoostingConfig(iterations=n, learning_rate=r, depth=2) for n in (2, 5) for r in (0.1, 0.4)]
    together = {tuple(r)[:3]: r.log_loss for r in models.tune(rows, CFG, grid).collect()}
    assert len(together) == 4
    for setting in grid:
        alone = models.tune(rows, CFG, [setting]).first()
        assert math.isclose(alone.log_loss, together[(setting.iterations, setting.learning_rate, 2)], rel_tol=1e-9)


def test_whole_run_stores_results(spark, lab, tmp_path):
    rounds = BoostingConfig(iterations=2, depth=3)
    cfg = dataclasses.replace(CFG, classifier=rounds, regressor=rounds)
    root = str(tmp_path)
    run_forecast(lab.wh.ref("mart_fresh_food_order_sale"), root, "v1", cfg)
    runs = ev.stored_runs(spark, root).orderBy("run_id").collect()
    assert [(r.run_id, r.threshold_type) for r in runs][:1] == [(1, "low_missed_sales")]
    metrics = ev.run_table(spark, root, "model_metrics")
    assert metrics.count() == 11 * len(runs)
    assert ev.run_table(spark, root, "feature_importance").count() == 5 * len(runs)
    assert spark.read.parquet(f"{root}/lookup_hist_avg").count() > 0
    assert ev.latest_accuracy(metrics) is not None


@pytest.mark.parametrize("slice_points", [20_000, 40])
def test_neighbours_against_brute_force(spark, monkeypatch, slice_points):
    """All distances computed in plain Python; small slices force many slice pairs."""
    monkeypatch.setattr(neighbours, "SLICE_POINTS", slice_points)
    monkeypatch.setattr(neighbours, "CELL_POINTS", 16 if slice_points == 40 else 512)
    rng = random.Random(7)
    # distinct distances nearly surely; one point holds a third of the rows
    train = [([rng.random(), rng.random()], rng.randrange(9)) for _ in range(200)]
    train += [(train[0][0], rng.randrange(9)) for _ in range(100)]
    test = [([rng.random(), rng.random()],) for _ in range(90)]
    known = spark.createDataFrame(train, "point array<double>, y int")
    asked = spark.createDataFrame(test, "point array<double>")
    found = neighbours.nearest_means(known, asked, (3, 5), "y").collect()
    got = {k: {tuple(r.point): r[f"knn_{k}"] for r in found} for k in (3, 5)}
    assert len(found) == 90
    by_point = {}
    for p, y in train:
        by_point.setdefault(tuple(p), []).append(y)
    for k in (3, 5):
        for (q,) in test:
            need, total = k, 0.0
            for p, ys in sorted(by_point.items(), key=lambda e: math.dist(e[0], q)):
                used = min(need, len(ys))
                total += used * sum(ys) / len(ys)
                need -= used
                if not need:
                    break
            assert math.isclose(got[k][tuple(q)], total / k, rel_tol=1e-9)


@pytest.mark.parametrize("slice_points", [20_000, 1])
def test_equally_far_points_do_not_depend_on_slices(spark, monkeypatch, slice_points):
    """Of four points at one distance the one with most rows comes first, then the one with the larger sum."""
    monkeypatch.setattr(neighbours, "SLICE_POINTS", slice_points)
    rows = [([1.0, 0.0], 1), ([0.0, 1.0], 5), ([-1.0, 0.0], 2)] + [([0.0, -1.0], 10)] * 2 + [([3.0, 3.0], None)]
    known = spark.createDataFrame(rows, "point array<double>, y int")
    asked = spark.createDataFrame([([0.0, 0.0],)], "point array<double>")
    got = neighbours.nearest_means(known, asked, (1, 2, 3), "y").first()
    assert (got.knn_1, got.knn_2) == (10.0, 10.0)
    assert math.isclose(got.knn_3, 25 / 3)


def test_far_cells_are_not_searched(spark, monkeypatch):
    """Points in ten clumps: a point meets its own clump, not the other nine."""
    monkeypatch.setattr(neighbours, "CELL_POINTS", 25)
    rng = random.Random(2)
    known = [([10.0 * (i % 10) + rng.random(), rng.random()], 1, float(i)) for i in range(400)]
    known = spark.createDataFrame(known, "point array<double>, n bigint, total double")
    asked = spark.createDataFrame([([10.0 * (i % 10) + rng.random(), rng.random()],) for i in range(100)], "point array<double>")
    placed, cells = neighbours.build_cells(known)
    assert placed.count() == 400 and len(cells.low) == 16
    own = neighbours._with_cell(asked, cells.axis, cells.border).withColumn("bound", F.lit(1.5))
    assert neighbours._other_cells(own, cells).count() < 5 * 100
    assert neighbours._other_cells(own.withColumn("bound", F.lit(None).cast("double")), cells).count() == 15 * 100
    near = neighbours.nearest_points(known, asked, 3).collect()
    best = {}
    for r in near:
        best.setdefault(tuple(r.point), []).append(r.distance)
    rows = [r.point for r in known.collect()]
    for (q,) in asked.collect():
        assert sorted(best[tuple(q)])[:3] == [math.sqrt(s) for s in sorted(sum((a - b) ** 2 for a, b in zip(p, q)) for p in rows)[:3]]


def run_parts(spark, accuracy):
    rows = [("i", 1, 1, 1)] * accuracy + [("i", 1, 0, 0)] * (10 - accuracy)
    df = spark.createDataFrame(rows, "item_id string, sold_quantity int, predicted int, predicts_sale int")
    importance = spark.createDataFrame([("f", 1.0)], "feature_name string, classifier_importance double")
    return ev.evaluate(df), ev.evaluate_by_item(df), importance


def test_half_written_runs_are_passed_over(spark, tmp_path, monkeypatch):
    """A run that dies before its manifest is no run; the same id completes it, and once more changes nothing."""
    root = str(tmp_path)
    assert ev.stored_runs(spark, root).count() == 0
    assert ev.store_run(root, "a", "v1", "low_wastage", 0.7, *run_parts(spark, 5))
    overwrite = ev.overwrite

    def dies(df, path):
        if "by_item" in path:
            raise RuntimeError("lost")
        return overwrite(df, path)

    monkeypatch.setattr(ev, "overwrite", dies)
    with pytest.raises(RuntimeError):
        ev.store_run(root, "b", "v2", "low_wastage", 0.7, *run_parts(spark, 9))
    monkeypatch.setattr(ev, "overwrite", overwrite)

    def metrics():
        return ev.run_table(spark, root, "model_metrics")

    assert metrics().count() == 11 and ev.latest_accuracy(metrics(), ev.stored_runs(spark, root)) == 0.5
    assert ev.store_run(root, "b", "v2", "low_wastage", 0.7, *run_parts(spark, 9))
    assert not ev.store_run(root, "b", "v2", "low_wastage", 0.7, *run_parts(spark, 1))
    runs = ev.stored_runs(spark, root)
    assert metrics().count() == 22 and ev.latest_accuracy(metrics(), runs) == 0.9
    assert ev.latest_accuracy(metrics(), runs, "other") is None
    with pytest.raises(ValidationError):
        ev.store_run(root, "no/id", "v", "t", 0.1, *run_parts(spark, 1))


def test_two_writers_do_not_meet(spark, tmp_path, monkeypatch):
    """A second writer stores its whole run between the tables of the first."""
    root, overwrite, inside = str(tmp_path), ev.overwrite, []

    def interleaved(df, path):
        if "feature_importance" in path and not inside:
            inside.append("second")
            ev.store_run(root, "12", "v2", "low_wastage", 0.7, *run_parts(spark, 7))
        return overwrite(df, path)

    monkeypatch.setattr(ev, "overwrite", interleaved)
    assert ev.store_run(root, "11", "v1", "low_wastage", 0.7, *run_parts(spark, 4))
    got = ev.run_table(spark, root, "model_metrics").where("metric_name = 'accuracy'").collect()
    runs = {r.run_id: r.model_version for r in ev.stored_runs(spark, root).collect()}
    assert {runs[r.run_id]: r.metric_value for r in got} == {"v1": 0.4, "v2": 0.7} and sorted(runs) == [1, 2]
    assert runs[2] == "v1"  # completed last


def test_tuning_ranks_settings(spark, lab):
    assert len(models.boosting_grid()) == 27
    features = preparation.build_features(
        preparation.without_errors(lab.wh.ref("mart_fresh_food_order_sale")), CFG
    )
    grid = [BoostingConfig(iterations=1, depth=2), BoostingConfig(iterations=2, depth=2)]
    got = models.tune(features, CFG, grid).collect()
    assert [r.iterations for r in got] == [1, 2] and all(r.log_loss > 0 for r in got)


def test_published_rounds_are_the_default(spark):
    cfg = ForecastConfig()
    published = BoostingConfig(iterations=500, learning_rate=0.05, depth=6, random_seed=42)
    assert cfg.classifier == cfg.regressor == published
    assert models._boosting(models.GBTClassifier, cfg.classifier, "sells").getMaxIter() == 500


def test_tasks_of_a_fit():
    """Few points are dealt by 20,000, many over the cores, very many by 200,000: tasks cost a start per level and tree."""
    from skygalley.forecast.encoding import fit_tasks

    assert [fit_tasks(n, 12) for n in (0, 1, 20_000, 20_001, 240_000)] == [1, 1, 1, 2, 12]
    assert [fit_tasks(n, 12) for n in (1_000_000, 2_400_000, 8_000_000)] == [12, 12, 40]


def many_averages(spark, n=3000):
    """As many averages as rows, so that hardly two rows are one point."""
    rng = random.Random(3)
    rows = [
        (rng.choice("abc"), f"r{k % 5}" if k % 9 else None, "Day", "<100", k / n if k % 13 else None,
         int(rng.random() * 3 * (0.2 + k / n)), D0 + datetime.timedelta(days=rng.randrange(60)))
        for k in range(n)
    ]
    return spark.createDataFrame(rows, FEATURES)


def test_fits_pass_over_cells_not_points(spark, monkeypatch):
    """What a fit is given does not grow with the points, and stands for all of them."""
    given = []
    for kind in (models.GBTClassifier, models.GBTRegressor):
        fit = kind.fit
        monkeypatch.setattr(kind, "fit", lambda self, df, fit=fit: given.append(df) or fit(self, df))
    cfg = dataclasses.replace(CFG, **dict.fromkeys(("classifier", "regressor"), BoostingConfig(iterations=3, depth=2, early_stop_patience=2)))
    rows = many_averages(spark)
    models.fit_classifier(rows, cfg), models.fit_regressor(rows, cfg)
    most = 3 * 6 * 32
    assert [df.agg(F.sum("weight")).first()[0] for df in given] == [3000, rows.where("sold_quantity > 0").count()]
    assert given[0].count() <= 2 * most < 2500 and given[1].count() <= 2 * most


def test_trees_over_bins_are_trees_over_values(spark, tmp_path):
    """Thresholds are Spark's own, so are the predictions; a value at a threshold lies below it, what is no number above all."""
    cfg = dataclasses.replace(CFG, classifier=BoostingConfig(iterations=4, depth=3, early_stop_weeks=None))
    rows = many_averages(spark)
    model = models.fit_classifier(rows, cfg)
    sells = rows.withColumn("sells", (F.col("sold_quantity") > 0).cast("double"))
    points = models.held_back_points(sells, cfg, "sells", None)
    encoded = encoding.encode_points(points, model.means, cfg, ["sells", "weight"])
    plain = models._boosting(models.GBTClassifier, cfg.classifier, "sells").fit(encoded)
    asked = rows.select(*encoding.feature_columns(cfg)).distinct()
    wanted = plain.transform(encoding.with_vector(asked, model.means, cfg))
    wanted = wanted.select(*asked.columns, models.vector_to_array("probability")[1].alias("p"))
    got = models.sale_probabilities(asked, model, cfg)
    pairs = joins.join_null_safe(got, wanted, asked.columns)
    assert pairs.count() == asked.count() > 2500
    assert pairs.agg(F.max(F.abs(F.col("p") - F.col("sale_probability")))).first()[0] < 1e-12
    bins = encoding.Bins(((), (), (), (), (0.0, 1.5)))
    at = spark.createDataFrame([(v,) for v in (-1.0, -0.0, 0.0, 0.1, 1.5, 1.6, float("nan"))], "v double")
    assert [r.b for r in bins.add(at, cfg, {"hist_avg": ("v", "b")}).collect()] == [0, 0, 0, 1, 1, 2, 2]
    bins.save(spark, str(tmp_path))
    assert encoding.Bins.load(spark, str(tmp_path)) == bins


@pytest.mark.parametrize("label", ["sells", "quantity"])
def test_losses_of_rounds_are_those_of_a_fit(spark, label):
    """One task over added-up cells finds the losses that Spark's fit has after each round."""
    kind = {"sells": models.GBTClassifier, "quantity": models.GBTRegressor}[label]
    setting = BoostingConfig(iterations=6, learning_rate=0.3, depth=3)
    rows = many_averages(spark).withColumn("sells", (F.col("sold_quantity") > 0).cast("double"))
    rows = rows.withColumn("quantity", F.col("sold_quantity").cast("double"))
    points = models.held_back_points(rows, CFG, label, 2)
    early, late, sums = models.held_back_cells(points, CFG, kind, setting, label)
    plan = rounds.losses_by_round(
        sums, encoding.bin_columns(CFG), 0, label == "sells", 0.3, 3, lambda found: len(found) == 6
    )
    got = [r.loss for r in sorted(plan.collect())]
    early, late = (encoding.fit_cells(part.drop("held_back"), CFG, label) for part in (early, late))
    trees = models._over_cells(models._boosting(kind, setting, label), early).fit(early)
    wanted = trees.evaluateEachIteration(late, *([] if label == "sells" else ["squared"]))
    assert len(got) == 6 and all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(got, wanted))


def test_cells_that_no_task_holds_are_fitted_by_spark(spark, monkeypatch):
    rows = many_averages(spark, 600)
    cfg = dataclasses.replace(CFG, classifier=BoostingConfig(learning_rate=0.4, depth=2, early_stop_patience=2))
    grid = [BoostingConfig(iterations=n, learning_rate=0.4, depth=2) for n in (1, 3)]

    def found():
        losses = {r.iterations: r.log_loss for r in models.tune(rows, CFG, grid).collect()}
        return models.fit_classifier(rows, cfg).trees.getNumTrees, losses

    (in_tasks, losses), _ = found(), monkeypatch.setattr(rounds, "MOST_TASK_CELLS", 0)
    by_spark, others = found()
    assert in_tasks == by_spark and sorted(losses) == sorted(others) == [1, 3]
    assert all(math.isclose(losses[n], others[n], rel_tol=1e-9) for n in losses)


@pytest.mark.parametrize("losses, ends", [([3, 2, 1], False), ([1, 2, 3], True), ([1, 2, 3, 4], False), ([3, 1, 2, 3, 4, 5], True)])
def test_searches_look_back_at_doubled_rounds(losses, ends):
    assert models._search_ends(losses, 500, 2) is ends and models._search_ends(losses, len(losses), 2)


def test_products_and_contexts_are_encoded_before_they_are_paired(spark, monkeypatch):
    """The table holds what scoring each pair by itself gives, missing routes and unknown products too."""
    setting = BoostingConfig(iterations=3, learning_rate=0.5, depth=3, early_stop_weeks=None)
    cfg = dataclasses.replace(CFG, classifier=setting, regressor=setting)
    rows = learnable(spark)
    model = models.TwoStageModel(models.fit_classifier(rows, cfg), models.fit_regressor(rows, cfg))
    requests = spark.createDataFrame(
        [(f"q{k}", f"r{k % 4}" if k % 5 else None, ("Day", "Night", None)[k % 3], 70.0 * (k % 4)) for k in range(60)],
        "request_id string, route string, day_period string, expected_pax double",
    )
    products = spark.createDataFrame([(i, "Fresh", "x") for i in ("a", "b", "new")], "item_id string, category string, other string")
    lookup = spark.createDataFrame(
        [(i, f"r{r}", "Day", float(r)) for i in "ab" for r in range(3)] + [("a", None, "Day", 9.0)],
        "item_id string, route string, day_period string, hist_avg double",
    )
    points = scoring.point_inputs(requests, products, lookup, cfg)
    wanted = models.decide(models.score_points(points, model, cfg), 0.4)
    names = [*scoring.CONTEXT, "item_id", "category", "hist_avg"]
    wanted = sorted(map(str, wanted.select(*names, F.col("predicted").alias("predicted_quantity")).collect()))
    given, join = [], encoding.CategoryMeans.join
    monkeypatch.setattr(
        encoding.CategoryMeans, "join", lambda self, df, names: given.append((len(names), df.count())) or join(self, df, names)
    )
    got = scoring.score_table(requests, products, lookup, model, "low_missed_sales", cfg)
    assert sorted(map(str, got.collect())) == wanted and len(wanted) > 60
    most = max(3, scoring.contexts(requests, cfg).count())
    assert all(n <= most for names, n in given if names) and most < len(wanted)
