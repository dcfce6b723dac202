"""Every model of the warehouse, the older star schema and the sales marts, whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from skygalley.plans import bi, warehouse
from skygalley.plans import legacy as old
from skygalley.registry.base import Lab, plain, query, register
from skygalley.registry.oracle import double


def view(name: str, money: str = "", where: str = "") -> str:
    columns = f"* REPLACE ({double(*money.split())})" if money else "*"
    return f"SELECT {columns} FROM {name} {where}"


MONEY = {
    "stg_catalog": "price",
    "stg_payments": "purchase_amount purchase_amount_main",
    "stg_sales": "price purchase_amount discount_amount",
    "dim_products": "price",
    "fact_sales": "purchase_amount discount_amount",
    "fact_payments": "purchase_amount_main",
    "mart_fresh_food_order_sale": "price",
    "mart_pax_sales": "purchase_amount",
}
MODELS = (
    "stg_bank",
    "stg_catalog",
    "stg_items_load",
    "stg_line",
    "stg_pax",
    "stg_payments",
    "stg_sales",
    "stg_schedule",
    "stg_wastage",
    "int_flights",
    "int_flight_load",
    "dim_flights",
    "dim_products",
    "dim_sessions",
    "dim_card",
    "bridge_flight_load",
    "fact_sales",
    "fact_payments",
    "fact_pax",
    "fact_wastage",
    "fact_items_load",
    "mart_fresh_food_order_sale",
    "mart_pax_sales",
)
for _name in MODELS:
    register(
        _name,
        lambda lab, n=_name: plain(lab.wh.model(n)),
        view(_name, MONEY.get(_name, "")),
    )


@query(
    "int_line_route",
    "SELECT * FROM int_line_route",
)
def _line_route(lab: Lab):
    return lab.wh.model("int_line_route").select(
        "line_id",
        "date",
        "load_id",
        F.concat_ws(">", "connected_flights").alias("connected_flights"),
        F.concat_ws(">", "route").alias("route"),
        F.size("route").alias("stops"),
        "potential_error",
    )


# The calendar and the clock do not come from data: they are checked through the flights on them.
@query(
    "int_hours",
    """SELECT h.hour, count(f.flight_key) AS flights FROM int_hours h
       LEFT JOIN dim_flights f ON f.hour_of_departure = h.hour GROUP BY h.hour""",
)
def _hours(lab: Lab):
    flights = lab.wh.ref("dim_flights").select("hour_of_departure", "flight_key")
    hours = lab.wh.model("int_hours")
    joined = hours.join(flights, hours["hour"] == flights["hour_of_departure"], "left")
    return joined.groupBy("hour").agg(F.count("flight_key").alias("flights"))


@query(
    "dim_date",
    """SELECT d.*, coalesce(f.flights, 0) AS flights FROM dim_date d
       LEFT JOIN (SELECT date AS date_key, count(*) AS flights FROM dim_flights GROUP BY 1) f
         ON d.date_key = f.date_key""",
)
def _dates(lab: Lab):
    flights = lab.wh.ref("dim_flights").groupBy(F.col("date").alias("date_key"))
    counts = flights.agg(F.count(F.lit(1)).alias("flights"))
    dates = lab.wh.model("dim_date")
    out = dates.join(counts, "date_key", "left")
    return out.withColumn("flights", F.coalesce("flights", F.lit(0))).select(*dates.columns, "flights")


@query(
    "dim_time",
    """SELECT t.*, coalesce(f.flights, 0) AS flights FROM dim_time t
       LEFT JOIN (SELECT hour_of_departure AS time_key, count(*) AS flights FROM dim_flights GROUP BY 1) f
         ON t.time_key = f.time_key""",
)
def _times(lab: Lab):
    flights = lab.wh.ref("dim_flights").groupBy(F.col("hour_of_departure").alias("time_key"))
    counts = flights.agg(F.count(F.lit(1)).alias("flights"))
    times = lab.wh.model("dim_time")
    out = times.join(counts, "time_key", "left")
    return out.withColumn("flights", F.coalesce("flights", F.lit(0))).select(*times.columns, "flights")


@query(
    "mart_pax_sales_per_flight",
    """SELECT s.flight_key, p.total_passengers AS passenger_count, s.number_of_tickets, s.sold_quantity,
       CAST(s.purchase_amount AS DOUBLE) AS purchase_amount
       FROM sales_by_flight s JOIN pax_by_flight p ON s.flight_key = p.flight_key
       JOIN dim_flights f ON f.flight_key = s.flight_key JOIN dim_time t ON t.time_key = f.hour_of_departure
       JOIN dim_date d ON d.date_key = f.date""",
)
def _pax_sales_per_flight(lab: Lab):
    ref = lab.wh.ref
    mart = warehouse.mart_pax_sales(
        ref("fact_sales"),
        ref("fact_pax"),
        ref("dim_flights"),
        ref("dim_time"),
        ref("dim_date"),
        per_flight=True,
    )
    return plain(
        mart.select(
            "flight_key", "passenger_count", "number_of_tickets", "sold_quantity", "purchase_amount"
        )
    )


# --- the older star schema ----------------------------------------------------------------------

LEGACY_MONEY = {
    "fact_payment": "purchase_amount",
    "fact_sales": "price purchase_amount discount_amount",
}
for _name in (
    "dim_product",
    "dim_flight",
    "dim_load",
    "dim_card",
    "dim_session",
    "fact_pax",
    "fact_payment",
    "fact_sales",
    "fact_wastage",
):
    register(
        f"leg_{_name}",
        lambda lab, n=_name: plain(lab.legacy.model(n)),
        view(f"leg_{_name}", LEGACY_MONEY.get(_name, "")),
    )


@query(
    "leg_dim_date",
    """SELECT d.*, coalesce(s.sales_rows, 0) AS sales_rows FROM leg_dim_date d
       LEFT JOIN (SELECT date, count(*) AS sales_rows FROM leg_sales GROUP BY date) s ON d.date = s.date""",
)
def _leg_dates(lab: Lab):
    sold = old.staged_sales(lab.wh.ref("stg_sales")).groupBy("date")
    counts = sold.agg(F.count(F.lit(1)).alias("sales_rows"))
    dates = lab.legacy.model("dim_date")
    out = dates.join(counts, "date", "left")
    return out.select(*dates.columns, F.coalesce("sales_rows", F.lit(0)).alias("sales_rows"))


# --- sales marts and their charts ---------------------------------------------------------------


def performance(lab: Lab):
    return bi.mart_sales_performance(lab.legacy.ref("fact_sales"), lab.legacy.ref("dim_date"))


def product_sales(lab: Lab):
    return bi.mart_product_sales(lab.legacy.ref("fact_sales"), lab.legacy.ref("dim_product"))


def flight_sales(lab: Lab):
    ref = lab.legacy.ref
    return bi.mart_flight_sales(
        lab.legacy.ref("fact_sales"), ref("dim_flight"), ref("dim_date"), ref("fact_pax")
    )


for _name, _build in (
    ("bi_sales_performance", performance),
    ("bi_product_sales", product_sales),
    ("bi_flight_sales", flight_sales),
):
    register(_name, lambda lab, b=_build: plain(b(lab)), view(_name, "total_sales"))


def _marts(lab: Lab):
    return lab.keep(
        "marts",
        lambda: bi.refresh_marts(
            {
                "mart_sales_performance": performance(lab),
                "mart_product_sales": product_sales(lab),
                "mart_flight_sales": flight_sales(lab),
            },
            f"{lab.root}/marts",
        ),
    )


@query(
    "refresh_marts",
    """SELECT 'mart_sales_performance' AS mart, count(*) AS n, CAST(sum(total_sales) AS DOUBLE) AS total
       FROM bi_sales_performance
       UNION ALL SELECT 'mart_product_sales', count(*), CAST(sum(total_sales) AS DOUBLE) FROM bi_product_sales
       UNION ALL SELECT 'mart_flight_sales', count(*), CAST(sum(total_sales) AS DOUBLE) FROM bi_flight_sales""",
)
def _refresh(lab: Lab):
    out = None
    for name, mart in _marts(lab).items():
        one = mart.agg(
            F.count(F.lit(1)).alias("n"), F.sum("total_sales").cast("double").alias("total")
        ).select(F.lit(name).alias("mart"), "n", "total")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "bi_weekly_revenue",
    """SELECT CAST(date_trunc('week', date) AS DATE) AS week, CAST(sum(total_sales) AS DOUBLE) AS total_sales
       FROM bi_sales_performance GROUP BY 1""",
)
def _weekly(lab: Lab):
    return plain(bi.weekly_revenue(_marts(lab)["mart_sales_performance"]))


@query(
    "bi_product_share",
    """SELECT item_id, CAST(sum(total_sales) AS DOUBLE) AS total_sales,
       CAST(sum(total_sales) AS DOUBLE) / CAST((SELECT sum(total_sales) FROM bi_product_sales) AS DOUBLE) AS share
       FROM bi_product_sales GROUP BY item_id""",
)
def _share(lab: Lab):
    return plain(bi.product_share(_marts(lab)["mart_product_sales"]))


def _chart_sql(direction: str, where: str = "") -> str:
    return f"""SELECT item_id, CAST(total AS DOUBLE) AS total_sales FROM (
        SELECT item_id, sum(total_sales) AS total FROM bi_product_sales {where} GROUP BY item_id)
        ORDER BY total {direction}, item_id LIMIT 10"""


@query("top_products_chart", _chart_sql("DESC"))
def _best(lab: Lab):
    return plain(bi.best_products(_marts(lab)["mart_product_sales"]))


@query("worst_products_chart", _chart_sql("ASC"))
def _worst(lab: Lab):
    return plain(bi.worst_products(_marts(lab)["mart_product_sales"]))


@query("bi_cross_filter", _chart_sql("DESC", "WHERE item_category = 'SMALL' AND is_food = true"))
def _cross(lab: Lab):
    mart = _marts(lab)["mart_product_sales"]
    return plain(bi.best_products(bi.cross_filter(mart, item_category="SMALL", is_food=True)))
