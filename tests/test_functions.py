import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skygalley import functions as fn
from skygalley.config import ForecastConfig
from skygalley.forecast.preparation import pax_bin


def column(spark, values, expr, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_to_time_normalises(spark):
    got = column(spark, ["7:05", "07:05", "23:59:58", None], fn.to_time, "string")
    assert got == ["07:05:00", "07:05:00", "23:59:58", None]


@pytest.mark.parametrize("text", ["", "25:00", "12:60", "noon"])
def test_to_time_refuses(spark, text):
    with pytest.raises(PySparkException):
        column(spark, [text], fn.to_time, "string")


def test_round_hour(spark):
    times = ["00:29:59", "00:30:00", "23:29:00", "23:30:00", "07:00:00", None]
    assert column(spark, times, fn.round_hour_from_time, "string") == [0, 1, 23, 23, 7, None]


def test_dates(spark):
    day = datetime.date(2025, 11, 1)
    assert column(spark, ["01/11/25", "1/11/25"], fn.date_from_short, "string") == [day, day]
    assert column(spark, ["2025/11/01 07:05"], fn.date_from_slashes, "string") == [day]
    assert column(spark, ["2025-11-01T07:05:00"], fn.date_from_iso, "string") == [day]
    assert column(spark, [day, None], fn.date_to_key, "date") == [20251101, None]


def test_names_padded_or_not(spark):
    day = datetime.date(2026, 5, 1)
    assert column(spark, [day], fn.month_name, "date") == ["May"]
    assert column(spark, [day], lambda c: fn.month_name(c, padded=True), "date") == ["May      "]
    assert column(spark, [day], fn.weekday_name, "date") == ["Friday"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(datetime.date(1990, 1, 1), datetime.date(2090, 1, 1)), min_size=1, max_size=50))
def test_calendar_agrees_with_python(spark, days):
    assert column(spark, days, fn.date_to_key, "date") == [int(d.strftime("%Y%m%d")) for d in days]
    assert column(spark, days, fn.day_of_week, "date") == [d.isoweekday() for d in days]
    assert column(spark, days, fn.is_weekend, "date") == [d.isoweekday() > 5 for d in days]
    mondays = [d - datetime.timedelta(days=d.weekday()) for d in days]
    assert column(spark, days, fn.week_start, "date") == mondays


def test_half_even(spark):
    assert column(spark, [0.5, 1.5, 2.5, -0.5], fn.half_even, "double") == [0.0, 2.0, 2.0, 0.0]
    assert column(spark, [2.5, 3.5, -4.0], fn.non_negative_int, "double") == [2, 4, 0]


def test_floor_threshold(spark):
    got = column(spark, [1.49, 1.5, 0.7, -0.2], lambda c: fn.floor_threshold(c, 0.5), "double")
    assert got == [1, 2, 1, 0]


def test_ratio_by_zero_is_null(spark):
    assert column(spark, [0, 4], lambda c: fn.ratio(F.lit(2), c), "int") == [None, 0.5]


@pytest.mark.parametrize(
    ("passengers", "trained", "served"),
    [
        (0, "<100", "<100"),
        (100, "<100", "100 - 150"),
        (101, "100 - 150", "100 - 150"),
        (150, "100 - 150", "150 - 180"),
        (180, "150 - 180", "180 +"),
        (181, "180 +", "180 +"),
        (1000, "180 +", "180 +"),
        (1001, None, "180 +"),
        (-1, None, "<100"),
        (None, None, None),
    ],
)
def test_pax_bins(spark, passengers, trained, served):
    cfg = ForecastConfig()
    assert column(spark, [passengers], lambda c: pax_bin(c, cfg), "int") == [trained]
    assert column(spark, [passengers], lambda c: pax_bin(c, cfg, serving=True), "int") == [served]


def test_keys_separate_nulls_from_text(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "UNKNOWN")], "x string, y string")
    keys = [r[0] for r in df.select(fn.surrogate_key("x", "y")).collect()]
    assert len(set(keys)) == 3
    pipe = [r[0] for r in df.select(fn.pipe_md5("x", "y")).collect()]
    assert pipe[0] == pipe[2] != pipe[1]
