"""Each governed metric, each dimension, and the whole request form."""

from __future__ import annotations

from skygalley.plans.semantic import DOMAINS, metric_query
from skygalley.registry.base import register

# The metrics and joins once more, as SQL text.
_SLIPS = "count(DISTINCT fs.slip_id)"
_DISCOUNTED = "count(DISTINCT CASE WHEN fs.discount_amount > 0 THEN fs.slip_id END)"
_WASTE, _FRESH, _LOAD = "sum(fw.wastage_quantity)", "sum(fw.fresh_wastage_quantity)", "sum(fw.load_quantity)"
_SQL = {
    "sales": {
        "revenue": "sum(fs.purchase_amount)",
        "sales_quantity": "sum(fs.sold_quantity)",
        "discounted_sales_amount": "sum(fs.discount_amount)",
        "discounted_sales_quantity": _DISCOUNTED,
        "average_sale_amount": ("sum(fs.purchase_amount)", _SLIPS),
        "average_items_in_slip": ("sum(fs.sold_quantity)", _SLIPS),
        "share_of_discounted_sales_in_amount": ("sum(fs.discount_amount)", "sum(fs.purchase_amount)"),
        "share_of_slips_with_discounts": (_DISCOUNTED, _SLIPS),
    },
    "wastage": {
        "loads_count": "count(DISTINCT fw.load_id)",
        "loaded_quantity": _LOAD,
        "sold_quantity": "sum(fw.sold_quantity)",
        "non_fresh_wastage_quantity": _WASTE,
        "fresh_wastage_quantity": _FRESH,
        "total_wastage": f"{_WASTE} + {_FRESH}",
        "sell_through_rate": ("sum(fw.sold_quantity)", _LOAD),
        "fresh_wastage_rate": (_FRESH, _LOAD),
        "non_fresh_wastage_rate": (_WASTE, _LOAD),
        "wastage_rate": (_WASTE, f"{_WASTE} + {_FRESH}"),
    },
    "flights": {"flight_count": "count(DISTINCT df.flight_key)"},
    "product_catalog": {"item_count": "count(DISTINCT dp.product_key)"},
    "pax_sales": {
        "passenger_count": "sum(m.passenger_count)",
        "number_of_tickets": "sum(m.number_of_tickets)",
        "sold_quantity": "sum(m.sold_quantity)",
        "purchase_amount": "sum(m.purchase_amount)",
        "avg_sales_per_passenger": ("sum(m.purchase_amount)", "sum(m.passenger_count)"),
        "avg_items_per_passenger": ("sum(m.sold_quantity)", "sum(m.passenger_count)"),
    },
}
_FROM = {
    "sales": ("fact_sales fs", "JOIN dim_flights df ON df.flight_key = fs.flight_key"),
    "wastage": ("fact_wastage fw", "JOIN dim_flights df ON df.flight_key_with_date = fw.flight_key_with_date"),
    "flights": ("dim_flights df", ""),
    "product_catalog": ("dim_products dp", ""),
    "pax_sales": ("mart_pax_sales m", ""),
}
_DATE = "JOIN dim_date dd ON dd.date_key = df.date"
_TIME = "JOIN dim_time dt ON dt.time_key = df.hour_of_departure"
_COLUMN = {
    **{c: ("df dd", f"dd.{c}") for c in ("year", "month", "day", "week_day", "is_weekend")},
    **{c: ("df dt", f"dt.{c}") for c in ("day_period", "is_night", "am_pm")},
    "flight_number": ("df", "df.flight_number"),
    "destination": ("df", "df.destination"),
    "route": ("df", "df.origin || ' _ ' || df.destination"),
    **{c: ("dp", f"dp.{c}") for c in ("item_id", "category", "is_food", "item_type")},
    "load_id": ("", "fw.load_id"),
}


def _sql(
    domain: str,
    metrics: list[str],
    group_by: tuple[str, ...] = (),
    filters: dict[str, str] | None = None,
    tail: str = "",
) -> str:
    """The request as SQL; ``filters`` holds SQL literals."""
    filters = filters or {}
    table, flights = _FROM[domain]

    def column(name: str) -> tuple[str, str]:
        return ("", f"m.{name}") if domain == "pax_sales" else _COLUMN[name]

    used = " ".join(column(n)[0] for n in (*group_by, *filters))
    joins = [flights if "df" in used else "", _DATE if "dd" in used else "", _TIME if "dt" in used else ""]
    if "dp" in used and domain in ("sales", "wastage"):
        joins.append(f"JOIN dim_products dp ON dp.product_key = {table.split()[1]}.product_key")

    def metric(name: str) -> str:
        form = _SQL[domain][name]
        if isinstance(form, tuple):
            return f"CAST({form[0]} AS DOUBLE) / nullif(CAST({form[1]} AS DOUBLE), 0) AS {name}"
        return f"CAST({form} AS DOUBLE) AS {name}"

    parts = [*[f"{column(n)[1]} AS {n}" for n in group_by], *[metric(m) for m in metrics]]
    where = " AND ".join(f"{column(n)[1]} = {v}" for n, v in filters.items())
    group = ", ".join(column(n)[1] for n in group_by)
    return (
        f"SELECT {', '.join(parts)} FROM {table} {' '.join(j for j in joins if j)}"
        f" {'WHERE ' + where if where else ''} {'GROUP BY ' + group if group else ''} {tail}"
    )


# One dimension with few values per domain: every metric is asked by it.
_BY = {
    "sales": "category",
    "wastage": "destination",
    "flights": "day_period",
    "product_catalog": "category",
    "pax_sales": "weekday_name",
}
for _domain, _spec in DOMAINS.items():
    for _metric in _spec.metrics:
        register(
            f"mq_{_domain}_{_metric}",
            lambda lab, d=_domain, m=_metric: metric_query(lab.wh.ref, d, [m], [_BY[d]]),
            _sql(_domain, [_metric], (_BY[_domain],)),
        )
    for _name in _spec.dimensions:
        _metrics = list(_spec.metrics)[:2]
        _order = {_name: "asc"}
        register(
            f"mq_{_domain}_by_{_name}",
            lambda lab, d=_domain, m=_metrics, n=_name, o=_order: metric_query(
                lab.wh.ref, d, m, [n], None, o
            ),
            _sql(_domain, _metrics, (_name,), tail=f"ORDER BY {_name} ASC NULLS LAST"),
        )

register(
    "mq_sales_by_category_top",
    lambda lab: metric_query(
        lab.wh.ref,
        "sales",
        ["revenue", "average_sale_amount"],
        ["category"],
        order_by={"revenue": "desc", "category": "asc"},
        limit=10,
    ),
    _sql(
        "sales",
        ["revenue", "average_sale_amount"],
        ("category",),
        tail="ORDER BY revenue DESC NULLS FIRST, category LIMIT 10",
    ),
)
register(
    "mq_filter",
    lambda lab: metric_query(
        lab.wh.ref,
        "sales",
        list(DOMAINS["sales"].metrics),
        ["route", "day_period"],
        {"is_weekend": True, "category": "SMALL"},
        {"revenue": "desc", "route": "asc", "day_period": "asc"},
        limit=200,
    ),
    _sql(
        "sales",
        list(DOMAINS["sales"].metrics),
        ("route", "day_period"),
        {"is_weekend": "true", "category": "'SMALL'"},
        "ORDER BY revenue DESC NULLS FIRST, route, day_period LIMIT 200",
    ),
)
register(
    "mq_join_prune",
    lambda lab: metric_query(
        lab.wh.ref, "wastage", ["loads_count", "total_wastage", "wastage_rate"], filters={"year": 2026}
    ),
    _sql("wastage", ["loads_count", "total_wastage", "wastage_rate"], filters={"year": "2026"}),
)
register(
    "mq_all_global_sales",
    lambda lab: metric_query(lab.wh.ref, "sales", list(DOMAINS["sales"].metrics)),
    _sql("sales", list(DOMAINS["sales"].metrics)),
)
register(
    "mq_order_limit",
    lambda lab: metric_query(
        lab.wh.ref,
        "pax_sales",
        ["purchase_amount", "avg_sales_per_passenger"],
        ["flight_number", "month"],
        {"is_night": False},
        {"month": "desc", "purchase_amount": "asc", "flight_number": "asc"},
        15,
    ),
    _sql(
        "pax_sales",
        ["purchase_amount", "avg_sales_per_passenger"],
        ("flight_number", "month"),
        {"is_night": "false"},
        "ORDER BY month DESC NULLS FIRST, purchase_amount ASC NULLS LAST, flight_number LIMIT 15",
    ),
)
