"""Governed metric questions: named metrics by named dimensions, with filters, order and limit.

A metric is a sum, a distinct count of the domain's entity, or a ratio of two of these. Distinct
counts are answered in two grouping steps, first by dimensions *and* entity, then by dimensions:
one pass serves any number of distinct counts, and a hot dimension value is spread by entity.
Only the joins that the request needs are made, in the domain's order; they are inner joins, so
leaving one out changes the answer and the optimizer could not do it for us.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygalley.errors import ValidationError
from skygalley.functions import ratio

ROW_LIMIT = 200


@dataclass(frozen=True)
class Total:
    """Sum of a measure, or of several added up."""

    columns: tuple[str, ...]


@dataclass(frozen=True)
class Entities:
    """Distinct count of the domain's entity, where a measure is above zero if one is given."""

    positive: str | None = None


@dataclass(frozen=True)
class Ratio:
    numerator: Total | Entities
    denominator: Total | Entities


Metric = Total | Entities | Ratio


@dataclass(frozen=True)
class Dimension:
    column: Callable[[], Column]
    requires: tuple[str, ...] = ()


@dataclass(frozen=True)
class Join:
    table: str
    left: str
    right: str
    # columns taken over, as {name after the join: name in the table}
    columns: dict[str, str]


@dataclass(frozen=True)
class Domain:
    base: str
    entity: str | None
    metrics: dict[str, Metric]
    dimensions: dict[str, Dimension]
    joins: dict[str, Join] = field(default_factory=dict)
    join_order: tuple[str, ...] = ()


def _total(*columns: str) -> Total:
    return Total(columns)


def _dim(name: str, *requires: str) -> Dimension:
    return Dimension(lambda: F.col(name), requires)


def _route() -> Column:
    return F.concat(F.col("origin"), F.lit(" _ "), F.col("destination"))


_CALENDAR = {c: c for c in ("year", "month", "day", "week_day", "is_weekend")}
_CLOCK = {c: c for c in ("day_period", "is_night", "am_pm")}
_DATE = Join("dim_date", "flight_date", "date_key", _CALENDAR)
_TIME = Join("dim_time", "hour_of_departure", "time_key", _CLOCK)
_PRODUCT = Join(
    "dim_products", "product_key", "product_key", {c: c for c in ("item_id", "category", "is_food")}
)
_FLIGHT_COLUMNS = {
    "flight_number": "flight_number",
    "origin": "origin",
    "destination": "destination",
    "flight_date": "date",
    "hour_of_departure": "hour_of_departure",
}

_SALES = Domain(
    base="fact_sales",
    entity="slip_id",
    metrics={
        "revenue": _total("purchase_amount"),
        "sales_quantity": _total("sold_quantity"),
        "discounted_sales_amount": _total("discount_amount"),
        "discounted_sales_quantity": Entities("discount_amount"),
        "average_sale_amount": Ratio(_total("purchase_amount"), Entities()),
        "average_items_in_slip": Ratio(_total("sold_quantity"), Entities()),
        "share_of_discounted_sales_in_amount": Ratio(
            _total("discount_amount"), _total("purchase_amount")
        ),
        "share_of_slips_with_discounts": Ratio(Entities("discount_amount"), Entities()),
    },
    dimensions={
        **{c: _dim(c, "dim_flights", "dim_date") for c in _CALENDAR},
        "flight_number": _dim("flight_number", "dim_flights"),
        "route": Dimension(_route, ("dim_flights",)),
        "day_period": _dim("day_period", "dim_flights", "dim_time"),
        "item_id": _dim("item_id", "dim_products"),
        "category": _dim("category", "dim_products"),
    },
    joins={
        "dim_flights": Join("dim_flights", "flight_key", "flight_key", _FLIGHT_COLUMNS),
        "dim_date": _DATE,
        "dim_time": _TIME,
        "dim_products": _PRODUCT,
    },
    join_order=("dim_flights", "dim_date", "dim_time", "dim_products"),
)

_WASTAGE = Domain(
    base="fact_wastage",
    entity="load_id",
    metrics={
        "loads_count": Entities(),
        "loaded_quantity": _total("load_quantity"),
        "sold_quantity": _total("sold_quantity"),
        "non_fresh_wastage_quantity": _total("wastage_quantity"),
        "fresh_wastage_quantity": _total("fresh_wastage_quantity"),
        "total_wastage": _total("wastage_quantity", "fresh_wastage_quantity"),
        "sell_through_rate": Ratio(_total("sold_quantity"), _total("load_quantity")),
        "fresh_wastage_rate": Ratio(_total("fresh_wastage_quantity"), _total("load_quantity")),
        "non_fresh_wastage_rate": Ratio(_total("wastage_quantity"), _total("load_quantity")),
        # as published: a share of all wastage, not of what was loaded
        "wastage_rate": Ratio(
            _total("wastage_quantity"), _total("wastage_quantity", "fresh_wastage_quantity")
        ),
    },
    dimensions={
        "load_id": _dim("load_id"),
        "item_id": _dim("item_id", "dim_products"),
        "category": _dim("category", "dim_products"),
        "is_food": _dim("is_food", "dim_products"),
        "destination": _dim("destination", "dim_flights"),
        **{c: _dim(c, "dim_flights", "dim_date") for c in _CALENDAR},
    },
    joins={
        "dim_flights": Join(
            "dim_flights", "flight_key_with_date", "flight_key_with_date", _FLIGHT_COLUMNS
        ),
        "dim_date": _DATE,
        "dim_products": _PRODUCT,
    },
    join_order=("dim_flights", "dim_date", "dim_products"),
)

_FLIGHTS = Domain(
    base="dim_flights",
    entity="flight_key",
    metrics={"flight_count": Entities()},
    dimensions={
        **{c: _dim(c, "dim_date") for c in ("year", "month", "week_day")},
        **{c: _dim(c, "dim_time") for c in _CLOCK},
    },
    joins={"dim_date": Join("dim_date", "date", "date_key", _CALENDAR), "dim_time": _TIME},
    join_order=("dim_date", "dim_time"),
)

_CATALOG = Domain(
    base="dim_products",
    entity="product_key",
    metrics={"item_count": Entities()},
    dimensions={"category": _dim("category"), "item_type": _dim("item_type")},
)

_PAX_SALES = Domain(
    base="mart_pax_sales",
    entity=None,
    metrics={
        "passenger_count": _total("passenger_count"),
        "number_of_tickets": _total("number_of_tickets"),
        "sold_quantity": _total("sold_quantity"),
        "purchase_amount": _total("purchase_amount"),
        "avg_sales_per_passenger": Ratio(_total("purchase_amount"), _total("passenger_count")),
        "avg_items_per_passenger": Ratio(_total("sold_quantity"), _total("passenger_count")),
    },
    dimensions={
        c: _dim(c)
        for c in (
            "year",
            "month",
            "day",
            "week_day",
            "weekday_name",
            "is_weekend",
            "origin",
            "destination",
            "route",
            "day_period",
            "am_pm",
            "is_night",
            "flight_number",
        )
    },
)

DOMAINS: dict[str, Domain] = {
    "sales": _SALES,
    "wastage": _WASTAGE,
    "flights": _FLIGHTS,
    "product_catalog": _CATALOG,
    "pax_sales": _PAX_SALES,
}


def check_domain(domain: Domain) -> None:
    """A domain must be complete: known metric kinds, known joins, one order for all joins."""
    for name, metric in domain.metrics.items():
        parts = _parts(name, metric)
        if any(isinstance(p, Entities) for p in parts) and domain.entity is None:
            raise ValidationError(f"metric {name} counts entities but the domain names none")
        if any(isinstance(p, Total) and not p.columns for p in parts):
            raise ValidationError(f"metric {name} sums no column")
    for name, dimension in domain.dimensions.items():
        for table in dimension.requires:
            if table not in domain.joins:
                raise ValidationError(f"dimension {name} needs the join {table}, which is not declared")
    if set(domain.join_order) != set(domain.joins):
        raise ValidationError("joins and join_order must list the same tables")


def _parts(name: str, metric: Metric) -> tuple[Total | Entities, ...]:
    if isinstance(metric, Ratio):
        return (metric.numerator, metric.denominator)
    if isinstance(metric, (Total, Entities)):
        return (metric,)
    raise ValidationError(f"metric {name} is neither a total, a count nor a ratio")


@dataclass(frozen=True)
class Request:
    """What is asked of a domain. ``problems`` names every field that can't be answered, and why."""

    metrics: object
    group_by: object
    filters: object
    order_by: object
    limit: object

    def problems(self, domain: Domain) -> list[str]:
        known = {"metrics": set(domain.metrics), "group_by": set(domain.dimensions)}
        known["filters"] = known["group_by"]
        shapes = {"metrics": list, "group_by": list, "filters": dict, "order_by": dict}
        wrong = {f for f, kind in shapes.items() if not isinstance(getattr(self, f), kind)}
        found = [f"{field}: a {shapes[field].__name__} is expected" for field in sorted(wrong)]
        for field, names in known.items():
            if field not in wrong:
                found += [f"{field}: {name} is unknown" for name in getattr(self, field) if name not in names]
        if self.metrics == []:
            found.append("metrics: empty")
        if not wrong:
            answer = {*self.metrics, *self.group_by}
            found += [f"order_by: {name} is not in the answer" for name in self.order_by if name not in answer]
            found += [f"order_by: {d} is no direction" for d in self.order_by.values() if d not in ("asc", "desc")]
        if self.limit is not None and not (isinstance(self.limit, int) and self.limit > 0):
            found.append("limit: a positive number is expected")
        return found


def needed_joins(domain: Domain, names: list[str]) -> list[str]:
    wanted = {table for name in names for table in domain.dimensions[name].requires}
    return [table for table in domain.join_order if table in wanted]


def _total_expr(total: Total, aggregate: Callable[[str], Column]) -> Column:
    out = aggregate(total.columns[0])
    for column in total.columns[1:]:
        out = out + aggregate(column)
    return out


def metric_query(
    tables: Callable[[str], DataFrame],
    domain: str,
    metrics: list[str],
    group_by: list[str] | None = None,
    filters: dict[str, object] | None = None,
    order_by: dict[str, str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """The answer as a lazy frame: dimensions first, then metrics, each under its own name.

    ``tables`` gives a warehouse table by name. The answer is whole unless a limit, of any size, is stated.
    """
    group_by = [] if group_by is None else group_by
    filters = {} if filters is None else filters
    order_by = order_by or {}
    if domain not in DOMAINS:
        raise ValidationError(f"no such domain: {domain}")
    spec = DOMAINS[domain]
    check_domain(spec)
    if problems := Request(metrics, group_by, filters, order_by, limit).problems(spec):
        raise ValidationError("; ".join(problems))

    df = tables(spec.base)
    for table in needed_joins(spec, [*group_by, *filters]):
        join = spec.joins[table]
        side = tables(join.table).select(
            F.col(join.right).alias("_right"),
            *[F.col(c).alias(alias) for alias, c in join.columns.items()],
        )
        df = df.drop(*join.columns).join(side, F.col(join.left) == F.col("_right")).drop("_right")
    for name, value in filters.items():
        df = df.where(spec.dimensions[name].column() == F.lit(value))

    # dimensions get a prefix until the end: a metric may share a dimension's or a measure's name
    keys = [spec.dimensions[name].column().alias(f"d_{name}") for name in group_by]
    key_names = [f"d_{name}" for name in group_by]
    parts = {p for name in metrics for p in _parts(name, spec.metrics[name])}
    measures = sorted({c for p in parts if isinstance(p, Total) for c in p.columns})
    entity_parts = sorted((p for p in parts if isinstance(p, Entities)), key=lambda p: p.positive or "")
    sums = {c: f"s_{c}" for c in measures}
    flags = {p: f"n_{p.positive or 'all'}" for p in entity_parts}

    if entity_parts:
        df = df.groupBy(*keys, F.col(spec.entity).alias("entity")).agg(
            *[F.sum(c).alias(sums[c]) for c in measures],
            F.max(F.lit(1)).alias("seen"),
            *[F.max((F.col(p.positive) > 0).cast("int")).alias(flags[p]) for p in entity_parts if p.positive],
        )
        keys = [F.col(k) for k in key_names]
        counts = [
            F.coalesce(
                F.sum(
                    F.when(
                        F.col("entity").isNotNull(),
                        F.coalesce(flags[p], F.lit(0)) if p.positive else F.lit(1),
                    )
                ),
                F.lit(0),
            ).alias(flags[p])
            for p in entity_parts
        ]
        aggregates = [*[F.sum(sums[c]).alias(sums[c]) for c in measures], *counts]
    else:
        aggregates = [F.sum(c).alias(sums[c]) for c in measures]
    df = df.groupBy(*keys).agg(*aggregates) if group_by else df.agg(*aggregates)

    def value(part: Total | Entities) -> Column:
        if isinstance(part, Entities):
            return F.col(flags[part]).cast("double")
        return _total_expr(part, lambda c: F.col(sums[c])).cast("double")

    def metric(name: str) -> Column:
        spec_ = spec.metrics[name]
        if isinstance(spec_, Ratio):
            return ratio(value(spec_.numerator), value(spec_.denominator))
        return value(spec_)

    df = df.select(
        *[F.col(f"d_{name}").alias(name) for name in group_by],
        *[metric(name).alias(f"m_{name}" if name in group_by else name) for name in metrics],
    )
    if order_by:
        # the order of nulls in PostgreSQL: last going up, first going down
        df = df.orderBy(
            *[F.asc_nulls_last(k) if d == "asc" else F.desc_nulls_first(k) for k, d in order_by.items()]
        )
    return df if limit is None else df.limit(limit)


def metric_result(answer: DataFrame, row_limit: int = ROW_LIMIT) -> dict[str, object]:
    """A view of at most ``row_limit`` rows, numbers as doubles, and whether the answer has more."""
    numbers = {f.name for f in answer.schema.fields if isinstance(f.dataType, T.NumericType)}
    view = answer.select(
        *[F.col(c).cast("double").alias(c) if c in numbers else F.col(c) for c in answer.columns]
    )
    found = [row.asDict() for row in view.take(row_limit + 1)]
    return {"rows": found[:row_limit], "truncated": len(found) > row_limit}
