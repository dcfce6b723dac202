"""The older star schema that the sales charts still read. Facts keep every row; only keys change."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygalley.config import UNKNOWN
from skygalley.functions import date_spine, date_to_key, is_weekend, pipe_md5, weekday_name
from skygalley.operators.cleaning import distinct_rows, first_per_key, non_negative
from skygalley.operators.joins import fill_from_first, join_null_safe, map_key, only_in_left
from skygalley.plans.warehouse import Warehouse
from skygalley.sources.sinks import overwrite

FLIGHT_KEY = ["flight_no", "date", "time", "origin", "destination"]


def staged_sales(sales: DataFrame) -> DataFrame:
    """The older staging also drops negative quantities."""
    return non_negative(sales, ["sold_quantity"])


def staged_wastage(wastage: DataFrame, schedule: DataFrame) -> DataFrame:
    """Wastage has no time of day; it takes that of the first scheduled row of its flight and day."""
    order = [F.asc_nulls_last("time")]
    return fill_from_first(wastage, schedule, ["flight_no", "date"], "time", order)


def dim_product(catalog: DataFrame, sales: DataFrame, wastage: DataFrame) -> DataFrame:
    """Catalog items, plus items known only from sales or wastage, marked UNKNOWN."""
    columns = ["item_id", "status", "item_category", "is_food", "item_type"]
    order = [F.asc_nulls_last(c) for c in columns[1:]]
    known = first_per_key(catalog.select(*columns), ["item_id"], order)
    seen = (
        sales.select("item_id", "item_category")
        .distinct()
        .withColumn("place", F.lit(1))
        .unionByName(
            wastage.select("item_id", "item_category", "item_type")
            .distinct()
            .withColumn("place", F.lit(2)),
            allowMissingColumns=True,
        )
    )
    # sales before wastage, then by name: one stated choice among many rows of an item
    order = [F.col("place"), F.asc_nulls_last("item_category"), F.asc_nulls_last("item_type")]
    inferred = only_in_left(first_per_key(seen, ["item_id"], order), known, ["item_id"])
    inferred = inferred.drop("place").withColumn("source", F.lit(UNKNOWN))
    both = known.unionByName(inferred, allowMissingColumns=True)
    return both.withColumn("product_sur_id", pipe_md5("item_id"))


def dim_flight(schedule: DataFrame, others: list[DataFrame]) -> DataFrame:
    """Scheduled flights (KNOWN) and flights seen only elsewhere (UNKNOWN)."""
    known = first_per_key(schedule.select(*FLIGHT_KEY, "line_id"), FLIGHT_KEY, [F.col("line_id")])
    known = known.withColumn("source", F.lit("KNOWN"))
    seen = None
    for df in others:
        part = df.select(*FLIGHT_KEY).distinct()
        seen = part if seen is None else seen.unionByName(part)
    unknown = only_in_left(seen.distinct(), known, FLIGHT_KEY)
    unknown = unknown.withColumn("line_id", F.lit(None).cast("string")).withColumn(
        "source", F.lit(UNKNOWN)
    )
    return known.unionByName(unknown).withColumn("flight_sur_id", pipe_md5(*FLIGHT_KEY))


def dim_load(schedule: DataFrame) -> DataFrame:
    loads = schedule.select(
        "line_id", F.coalesce(F.col("load_id").cast("string"), F.lit(UNKNOWN)).alias("load_id")
    ).distinct()
    return loads.withColumn("load_sur_id", pipe_md5("line_id", "load_id"))


def dim_card(payments: DataFrame, bank: DataFrame) -> DataFrame:
    """Cards with a prefix and a type, with the bank's details where it has them."""
    used = payments.select("card_number_prefix", "card_type").dropna()
    cards = first_per_key(used.distinct(), ["card_number_prefix"], [F.col("card_type")])
    cards = cards.join(bank.distinct().dropna(), "card_number_prefix", "left")
    return cards.withColumn("card_sur_key", pipe_md5("card_number_prefix"))


def dim_session(payments: DataFrame, sales: DataFrame) -> DataFrame:
    """Unlike the newer dimension an unknown mode is False."""
    seen = payments.select("session_id", "is_offline_mode").distinct()
    seen = seen.unionByName(sales.select("session_id").distinct(), allowMissingColumns=True)
    sessions = seen.groupBy("session_id").agg(
        F.coalesce(F.max("is_offline_mode"), F.lit(False)).alias("is_offline_mode")
    )
    return sessions.withColumn("session_sur_id", pipe_md5("session_id"))


def dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Weekdays count from 0 here, and both ends are included."""
    date = F.col("date")
    after = (datetime.date.fromisoformat(end) + datetime.timedelta(days=1)).isoformat()
    return date_spine(spark, start, after).select(
        "date",
        date_to_key(date).alias("date_sur_id"),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
        F.weekday(date).alias("weekday"),
        weekday_name(date).alias("weekday_name"),
        is_weekend(date).alias("is_weekend"),
    )


def map_flight(df: DataFrame, flights: DataFrame) -> DataFrame:
    """Add the flight's key; flights are unique on their five parts, missing parts included."""
    side = flights.select(*FLIGHT_KEY, F.col("flight_sur_id").alias("flight_key"))
    return join_null_safe(df, side, FLIGHT_KEY)


def _date_key() -> Column:
    return date_to_key(F.col("date")).alias("date_key")


def fact_pax(pax: DataFrame, flights: DataFrame) -> DataFrame:
    df = map_flight(pax, flights).select("flight_key", "class", "pax_quantity", _date_key())
    return df.withColumn("pax_sur_id", pipe_md5("flight_key", "class", "date_key", "pax_quantity"))


def fact_payment(
    payments: DataFrame, flights: DataFrame, sessions: DataFrame, cards: DataFrame
) -> DataFrame:
    df = map_flight(payments, flights)
    df = map_key(df, sessions, "session_id", "session_sur_id", "session_key")
    df = map_key(df, cards, "card_number_prefix", "card_sur_key", "card_key")
    df = df.select(
        "slip_id",
        "session_key",
        "flight_key",
        "sales_type",
        "payment_type",
        "purchase_amount",
        "card_key",
        _date_key(),
    )
    parts = ("slip_id", "flight_key", "sales_type", "payment_type", "purchase_amount")
    return df.withColumn("payment_sur_id", pipe_md5(*parts))


def fact_sales(
    sales: DataFrame, flights: DataFrame, sessions: DataFrame, products: DataFrame
) -> DataFrame:
    df = map_flight(sales, flights)
    df = map_key(df, sessions, "session_id", "session_sur_id", "session_key")
    df = map_key(df, products, "item_id", "product_sur_id", "product_key")
    df = df.select(
        "session_key",
        "flight_key",
        "slip_id",
        "sales_type",
        "product_key",
        "price",
        "sold_quantity",
        "purchase_amount",
        "discount_amount",
        _date_key(),
    )
    parts = ("slip_id", "product_key", "price", "purchase_amount")
    return df.withColumn("sales_sur_id", pipe_md5(*parts))


def fact_wastage(wastage: DataFrame, flights: DataFrame, products: DataFrame) -> DataFrame:
    counts = ["load_quantity", "sold_quantity", "wastage_quantity", "fresh_wastage_quantity"]
    df = map_flight(wastage, flights)
    df = map_key(df, products, "item_id", "product_sur_id", "item_key")
    df = distinct_rows(df.select("flight_key", _date_key(), "item_key", *counts))
    return df.withColumn("wastage_sur_id", pipe_md5("flight_key", "item_key", "date_key", *counts))


class LegacyWarehouse:
    """Wires the older star schema to the staging models of a warehouse.

    Dimensions are written once when ``root`` is given: the facts map keys against all of them.
    """

    def __init__(self, warehouse: Warehouse, start: str, end: str, root: str | None = None):
        self.wh = warehouse
        self.start, self.end = start, end
        self.root = root.rstrip("/") if root else None
        self._refs: dict[str, DataFrame] = {}

    def _builders(self) -> dict[str, Callable[[], DataFrame]]:
        stg, ref = self.wh.ref, self.ref
        sales = lambda: staged_sales(stg("stg_sales"))
        wastage = lambda: staged_wastage(stg("stg_wastage"), stg("stg_schedule"))
        return {
            "dim_product": lambda: dim_product(stg("stg_catalog"), sales(), wastage()),
            "dim_flight": lambda: dim_flight(
                stg("stg_schedule"), [sales(), stg("stg_payments"), stg("stg_pax"), wastage()]
            ),
            "dim_date": lambda: dim_date(self.wh.spark, self.start, self.end),
            "dim_load": lambda: dim_load(stg("stg_schedule")),
            "dim_card": lambda: dim_card(stg("stg_payments"), stg("stg_bank")),
            "dim_session": lambda: dim_session(stg("stg_payments"), sales()),
            "fact_pax": lambda: fact_pax(stg("stg_pax"), ref("dim_flight")),
            "fact_payment": lambda: fact_payment(
                stg("stg_payments"), ref("dim_flight"), ref("dim_session"), ref("dim_card")
            ),
            "fact_sales": lambda: fact_sales(
                sales(), ref("dim_flight"), ref("dim_session"), ref("dim_product")
            ),
            "fact_wastage": lambda: fact_wastage(wastage(), ref("dim_flight"), ref("dim_product")),
        }

    @property
    def names(self) -> list[str]:
        return list(self._builders())

    def model(self, name: str) -> DataFrame:
        return self._builders()[name]()

    def ref(self, name: str) -> DataFrame:
        if name not in self._refs:
            df = self.model(name)
            self._refs[name] = overwrite(df, f"{self.root}/{name}") if self.root else df
        return self._refs[name]
