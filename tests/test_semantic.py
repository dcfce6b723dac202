import dataclasses

import pytest

from skygalley.errors import ValidationError
from skygalley.plans.semantic import (
    DOMAINS,
    ROW_LIMIT,
    Dimension,
    Entities,
    Total,
    check_domain,
    metric_query,
    metric_result,
    needed_joins,
)


@pytest.mark.parametrize(
    "request_",
    [
        {"domain": "weather", "metrics": ["revenue"]},
        {"domain": "sales", "metrics": []},
        {"domain": "sales", "metrics": ["profit"]},
        {"domain": "sales", "metrics": ["revenue"], "group_by": "route"},
        {"domain": "sales", "metrics": ["revenue"], "group_by": ["planet"]},
        {"domain": "sales", "metrics": ["revenue"], "filters": ["year"]},
        {"domain": "sales", "metrics": ["revenue"], "filters": {"planet": 1}},
        {"domain": "sales", "metrics": ["revenue"], "order_by": {"year": "asc"}},
        {"domain": "sales", "metrics": ["revenue"], "order_by": {"revenue": "DESC"}},
        {"domain": "sales", "metrics": ["revenue"], "limit": 0},
        {"domain": "sales", "metrics": ["revenue"], "limit": "5"},
    ],
)
def test_bad_requests(lab, request_):
    with pytest.raises(ValidationError):
        metric_query(lab.wh.ref, **request_)


def test_all_problems_are_named(lab):
    with pytest.raises(ValidationError, match="profit.*planet.*up.*limit"):
        metric_query(lab.wh.ref, "sales", ["profit", "revenue"], ["planet"], {}, {"revenue": "up"}, -1)


def test_answer_is_whole(lab):
    whole = metric_query(lab.wh.ref, "wastage", ["loaded_quantity"], ["load_id"])
    assert whole.count() > ROW_LIMIT + 1
    assert metric_query(lab.wh.ref, "wastage", ["loaded_quantity"], ["load_id"], limit=250).count() == 250


def test_domains_are_complete():
    for domain in DOMAINS.values():
        check_domain(domain)
    assert sum(len(d.metrics) for d in DOMAINS.values()) == 26
    assert sum(len(d.dimensions) for d in DOMAINS.values()) == 41


def test_broken_domains():
    sales = DOMAINS["sales"]
    broken = [
        dataclasses.replace(sales, join_order=("dim_flights",)),
        dataclasses.replace(sales, entity=None),
        dataclasses.replace(sales, metrics={"m": Total(())}),
        dataclasses.replace(sales, metrics={"m": "sum(x)"}),
        dataclasses.replace(sales, dimensions={"d": Dimension(lambda: None, ("dim_moon",))}),
    ]
    for domain in broken:
        with pytest.raises(ValidationError):
            check_domain(domain)


def test_joins_are_pruned_and_ordered():
    sales = DOMAINS["sales"]
    assert needed_joins(sales, []) == []
    assert needed_joins(sales, ["category"]) == ["dim_products"]
    assert needed_joins(sales, ["day_period", "year"]) == ["dim_flights", "dim_date", "dim_time"]


def _tables(spark, rows):
    facts = spark.createDataFrame(
        rows, "slip_id string, purchase_amount double, sold_quantity int, discount_amount double"
    )
    return lambda name: facts


def test_distinct_counts_ignore_missing_entities(spark):
    rows = [("a", 1.0, 1, 0.0), ("a", 2.0, 1, 1.0), ("b", 4.0, 1, 0.0), (None, 8.0, 1, 5.0)]
    metrics = ["revenue", "discounted_sales_quantity", "average_sale_amount", "share_of_slips_with_discounts"]
    got = metric_query(_tables(spark, rows), "sales", metrics).first()
    assert tuple(got) == (15.0, 1.0, 7.5, 0.5)


def test_no_rows_give_one_row(spark):
    got = metric_query(_tables(spark, []), "sales", ["revenue", "discounted_sales_quantity"]).collect()
    assert [tuple(r) for r in got] == [(None, 0.0)]


def test_result_is_cut_and_says_so(lab):
    answer = metric_result(metric_query(lab.wh.ref, "wastage", ["loaded_quantity"], ["load_id"]))
    assert len(answer["rows"]) == ROW_LIMIT and answer["truncated"]
    assert all(isinstance(r["loaded_quantity"], float) for r in answer["rows"])
    few = metric_result(metric_query(lab.wh.ref, "flights", ["flight_count"], ["am_pm"]))
    assert 1 <= len(few["rows"]) <= 2 and not few["truncated"]


def test_ratio_of_the_same_part_twice(lab):
    assert Entities() == Entities() and hash(Total(("x",))) == hash(Total(("x",)))
