import numpy as np
import pytest
from pyspark.sql import functions as F

from skygalley.operators import stats
from skygalley.sources.readers import read_mart_since
from skygalley.sources.sinks import overwrite_by_month


@pytest.mark.parametrize("size", [1, 2, 7, 5000])
def test_quantiles_equal_numpy(spark, size):
    """Ties, a value that holds a third of all rows, and nulls, against numpy's linear interpolation."""
    rng = np.random.default_rng(size)
    values = np.concatenate([rng.normal(size=size), np.full(size // 2, 0.25), rng.integers(0, 5, size)])
    rows = [(float(v),) for v in values] + [(None,)] * 3
    df = spark.createDataFrame(rows, "x double")
    got = {r["point"]: r["value"] for r in stats.quantiles(df, "x").collect()}
    for point in stats.PERCENTILES:
        assert got[point] == pytest.approx(np.quantile(values, point), abs=1e-9)


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert [r["value"] for r in stats.quantiles(df, "x").collect()] == [None] * len(stats.PERCENTILES)


def test_describe_many_columns_at_once(spark):
    """Every column gets its own quartiles; one without values gets nulls; names may clash with inner ones."""
    rng = np.random.default_rng(3)
    n, c = rng.normal(size=3000), rng.integers(0, 4, 3000).astype(float)
    rows = [(float(a), float(b), None) for a, b in zip(n, c)]
    df = spark.createDataFrame(rows, "n double, value double, c double")
    got = {r["column_name"]: r for r in stats.describe(df, ["n", "value", "c"]).collect()}
    for name, values in (("n", n), ("value", c)):
        for key, point in (("q25", 0.25), ("median", 0.5), ("q75", 0.75)):
            assert got[name][key] == pytest.approx(np.quantile(values, point), abs=1e-9)
    assert (got["c"]["n"], got["c"]["median"], got["c"]["min"]) == (0, None, None)


def test_value_counts_are_shuffled_once_for_all_columns(spark, tmp_path):
    path = str(tmp_path / "two")
    spark.range(1000).selectExpr("id as a", "id % 7 as b", "id % 3 as d").write.parquet(path)
    df = stats.percentiles(spark.read.parquet(path), ["a", "b", "d"], (0.5,))
    assert {r["c"]: r["q"][0] for r in df.collect()} == {0: 499.5, 1: 3.0, 2: 1.0}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan[: plan.index("Initial Plan")]


@pytest.mark.parametrize("size", [2, 50, 4000])
def test_auc_equals_all_pairs(spark, size):
    rng = np.random.default_rng(size)
    score = np.round(rng.normal(size=size), 1)
    sold = rng.random(size) < 0.3
    sold[:2] = (True, False)
    rows = [(float(s), bool(y)) for s, y in zip(score, sold)] + [(None, True), (0.0, None)]
    score, sold = np.append(score, 0.0), np.append(sold, False)
    higher = np.sign(score[sold][:, None] - score[~sold][None, :])
    want = ((higher + 1) / 2).mean()
    got = stats.auc(spark.createDataFrame(rows, "s double, y boolean"), "s", F.col("y")).first()["auc"]
    assert got == pytest.approx(want, abs=1e-12)


def test_auc_of_one_kind_is_missing(spark):
    df = spark.createDataFrame([(0.5, True)], "s double, y boolean")
    assert stats.auc(df, "s", F.col("y")).first()["auc"] is None
    assert stats.auc(df.where("s > 1"), "s", F.col("y")).first()["auc"] is None


def test_months_are_pruned(spark, tmp_path):
    """Only folders from the month on are listed for the scan, and rows and columns come back as they were."""
    days = spark.range(200).select(F.date_add(F.lit("2026-01-01"), F.col("id").cast("int")).alias("date"), "id")
    days = days.unionByName(spark.createDataFrame([(None, -1)], "date date, id long"))
    path = str(tmp_path / "days")
    stored = overwrite_by_month(days, path)
    assert stored.columns == ["date", "id"]
    assert sorted(r["id"] for r in stored.collect()) == list(range(-1, 200))
    since = read_mart_since(spark, path, "2026-05-20")
    assert since.columns == ["date", "id"]
    assert sorted(r["id"] for r in since.collect()) == list(range(139, 200))
    plan = since._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "month_key" in filters and "202605" in filters


def test_day_numbers_by_month(spark, tmp_path):
    rows = spark.createDataFrame([(20260131, 1), (20260201, 2), (None, 3)], "date int, n long")
    stored = overwrite_by_month(rows, str(tmp_path / "numbers"))
    assert sorted((r["date"] or 0, r["n"]) for r in stored.collect()) == [(0, 3), (20260131, 1), (20260201, 2)]
    months = {p.name for p in (tmp_path / "numbers").iterdir() if p.name.startswith("month_key=")}
    assert months == {"month_key=202601", "month_key=202602", "month_key=__HIVE_DEFAULT_PARTITION__"}
