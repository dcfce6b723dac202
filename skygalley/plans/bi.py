"""The three sales marts and the four charts on them.

Distinct slips are counted in two grouping steps, so that a hot day or product is spread by slip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygalley.functions import ratio, week_start
from skygalley.sources.sinks import overwrite

MONEY = "decimal(38,2)"


def _per_slip(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys, "slip_id").agg(
        F.sum("purchase_amount").alias("total"), F.count("product_key").alias("items")
    )


def mart_sales_performance(sales: DataFrame, dates: DataFrame) -> DataFrame:
    keys = ["date", "month", "is_weekend"]
    day = dates.select(F.col("date_sur_id").alias("date_key"), *keys)
    # aggregated by date key first: the calendar is joined to one row per day and slip
    slips = _per_slip(sales, ["date_key"]).join(day, "date_key")
    return slips.groupBy(*keys).agg(
        F.sum("total").cast(MONEY).alias("total_sales"),
        F.count("slip_id").alias("total_transactions"),
        F.sum("items").alias("total_items"),
        ratio(F.sum("total"), F.sum("items")).alias("avg_item_price"),
        ratio(F.sum("total"), F.count("slip_id")).alias("avg_check"),
    )


def mart_product_sales(sales: DataFrame, products: DataFrame) -> DataFrame:
    keys = ["item_id", "item_category", "item_type", "is_food"]
    side = products.select(F.col("product_sur_id").alias("product_key"), *keys)
    slips = _per_slip(sales, ["product_key"]).groupBy("product_key").agg(
        F.sum("total").alias("total"), F.sum("items").alias("items"), F.count("slip_id").alias("slips")
    )
    return slips.join(side, "product_key").select(
        *keys,
        F.col("total").cast(MONEY).alias("total_sales"),
        F.col("items").alias("quantity_sold"),
        F.col("slips").alias("total_transactions"),
        ratio(F.col("items"), F.col("slips")).alias("attach_rate"),
    )


def mart_flight_sales(
    sales: DataFrame, flights: DataFrame, dates: DataFrame, pax: DataFrame
) -> DataFrame:
    seats = pax.groupBy("flight_key").agg(F.sum("pax_quantity").alias("total_pax"))
    side = flights.select(
        F.col("flight_sur_id").alias("flight_key"), "flight_no", "origin", "destination"
    )
    day = dates.select(F.col("date_sur_id").alias("date_key"), "date", "is_weekend")
    sold = (
        sales.groupBy("flight_key", "date_key")
        .agg(F.sum("purchase_amount").alias("total"))
        .join(side, "flight_key")
        .join(day, "date_key")
        .join(seats, "flight_key", "left")
    )
    keys = ["flight_no", "origin", "destination", "date", "is_weekend"]
    mart = sold.groupBy(*keys).agg(
        F.sum("total").alias("total"), F.max("total_pax").alias("total_pax")
    )
    return mart.select(
        "flight_no",
        F.concat("origin", F.lit("-"), "destination").alias("route"),
        "date",
        "is_weekend",
        F.col("total").cast(MONEY).alias("total_sales"),
        "total_pax",
        ratio(F.col("total"), F.col("total_pax")).alias("revenue_per_pax"),
    )


def refresh_marts(marts: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Rebuild the marts in place and return them as stored."""
    return {name: overwrite(df, f"{root.rstrip('/')}/{name}") for name, df in marts.items()}


# --- charts: each takes a mart, already cut down by the dashboard's cross filters -----------------


def cross_filter(df: DataFrame, **equal: object) -> DataFrame:
    """The selection made in one chart applies to the others as equality."""
    for name, value in equal.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def weekly_revenue(performance: DataFrame) -> DataFrame:
    return performance.groupBy(week_start(F.col("date")).alias("week")).agg(
        F.sum("total_sales").cast(MONEY).alias("total_sales")
    )


def _by_item(product_sales: DataFrame) -> DataFrame:
    return product_sales.groupBy("item_id").agg(
        F.sum("total_sales").cast(MONEY).alias("total_sales")
    )


def product_share(product_sales: DataFrame) -> DataFrame:
    """Each product's revenue and its share of the whole; the whole is one scalar, not a window."""
    items = _by_item(product_sales)
    whole = product_sales.agg(F.sum("total_sales").cast("double")).scalar()
    return items.withColumn("share", ratio(F.col("total_sales"), whole))


def _top(product_sales: DataFrame, first: Column, rows: int) -> DataFrame:
    return _by_item(product_sales).orderBy(first, F.asc("item_id")).limit(rows)


def best_products(product_sales: DataFrame, rows: int = 10) -> DataFrame:
    return _top(product_sales, F.desc("total_sales"), rows)


def worst_products(product_sales: DataFrame, rows: int = 10) -> DataFrame:
    return _top(product_sales, F.asc("total_sales"), rows)
