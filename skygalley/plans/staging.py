"""Staging: one function per raw dataset; drop unusable rows, rename, convert, drop copies.

Missing and negative values are tested on the raw columns: a conversion never turns a value into a
null (it raises), so the result is the same and Spark can push the tests into the Parquet scan. The
unusable rows go before ``distinct``: what is dropped is not shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygalley.config import WarehouseConfig
from skygalley.functions import (
    anonymize_flight,
    date_from_iso,
    date_from_short,
    date_from_slashes,
    or_unknown,
    to_time,
)
from skygalley.operators.cleaning import date_window, distinct_rows, non_negative, required
from skygalley.operators.joins import with_lookup

MONEY = "decimal(18,2)"


def _part(text: Column, separator: str, position: int) -> Column:
    return F.split_part(text, F.lit(separator), F.lit(position))


def _cities(df: DataFrame, cities: DataFrame, origin: Column, destination: Column) -> DataFrame:
    df = with_lookup(df, origin, cities, "iata_code", "city_id", "origin")
    return with_lookup(df, destination, cities, "iata_code", "city_id", "destination")


def _currency(df: DataFrame, currencies: DataFrame, out: str = "currency_id") -> DataFrame:
    return with_lookup(df, F.col("currency"), currencies, "currency_code", "currency_id", out)


def _in_window(df: DataFrame, cfg: WarehouseConfig) -> DataFrame:
    return date_window(df, cfg.start_date, cfg.end_date)


def stg_bank(raw: DataFrame) -> DataFrame:
    df = required(raw, ["bin"]).select(
        F.col("bin").alias("card_number_prefix"),
        *[or_unknown(F.col(c)).alias(c) for c in ("brand", "type", "category", "issuer")],
        or_unknown(F.col("alpha_3")).alias("country_short"),
        or_unknown(F.col("country")).alias("country"),
    )
    return distinct_rows(df)


def stg_catalog(raw: DataFrame) -> DataFrame:
    priced = required(raw, ["reference", "family", "selling_price"])
    df = priced.where(F.col("selling_price") > 0).select(
        F.col("reference").alias("item_id"),
        or_unknown(F.col("status")).alias("status"),
        F.col("family").alias("item_category"),
        (F.col("food") == "YES").alias("is_food"),
        or_unknown(F.col("type")).alias("item_type"),
        F.col("selling_price").cast(MONEY).alias("price"),
    )
    return distinct_rows(df)


def stg_items_load(raw: DataFrame, cfg: WarehouseConfig, deal: Sequence[str] | None = None) -> DataFrame:
    raw = required(raw, ["flight_number", "departure_date", "order_num", "item_reference"])
    df = non_negative(raw, ["total_qty_loaded"]).select(
        anonymize_flight(F.col("flight_number")).alias("flight_no"),
        date_from_slashes(F.col("departure_date")).alias("date"),
        to_time(_part(F.col("departure_date"), " ", 2)).alias("time"),
        F.col("order_num").alias("load_id"),
        F.col("item_reference").alias("item_id"),
        F.col("total_qty_loaded").alias("total_loaded_quantity"),
    )
    return distinct_rows(_in_window(df, cfg), deal)


def _lines(raw: DataFrame, cities: DataFrame, stamp: str, time: Column, cfg: WarehouseConfig) -> DataFrame:
    raw = required(raw, ["line_id", "flight_no", stamp])
    df = _cities(raw, cities, F.col("iata_departure"), F.col("iata_destination")).select(
        "line_id",
        anonymize_flight(F.col("flight_no")).alias("flight_no"),
        "origin",
        "destination",
        date_from_iso(F.col(stamp)).alias("date"),
        to_time(time).alias("time"),
        F.col("order_no").alias("load_id"),
    )
    return distinct_rows(_in_window(df, cfg))


def stg_line(raw: DataFrame, cities: DataFrame, cfg: WarehouseConfig) -> DataFrame:
    """The day ends at a ``T`` or a blank; the time is read only after a blank, else it is missing."""
    stamp = "scheduled_datetime_utc"
    return _lines(raw, cities, stamp, F.nullif(_part(F.col(stamp), " ", 2), F.lit("")), cfg)


def stg_schedule(raw: DataFrame, cities: DataFrame, cfg: WarehouseConfig) -> DataFrame:
    stamp = "scheduled_datetime"
    return _lines(raw, cities, stamp, _part(F.col(stamp), " ", 2), cfg)


def stg_pax(raw: DataFrame, cities: DataFrame, cfg: WarehouseConfig) -> DataFrame:
    raw = non_negative(required(raw, ["flight_number", "scheduled_date"]), ["pax"])
    ends = raw.withColumnsRenamed({"origin": "origin_raw", "destination": "destination_raw"})
    df = _cities(ends, cities, F.col("origin_raw"), F.col("destination_raw")).select(
        anonymize_flight(F.col("flight_number")).alias("flight_no"),
        date_from_short(F.col("scheduled_date")).alias("date"),
        to_time(F.col("scheduled_time")).alias("time"),
        "origin",
        "destination",
        "class",
        F.col("pax").cast("int").alias("pax_quantity"),
    )
    return distinct_rows(_in_window(df, cfg))


def stg_payments(
    raw: DataFrame, cities: DataFrame, currencies: DataFrame, cfg: WarehouseConfig
) -> DataFrame:
    """Both currency columns follow the transaction currency, as in the published tables."""
    needed = [
        "session_no",
        "order_no",
        "ticket_id",
        "flight_no",
        "sales_type",
        "payment_type",
        "amount_tendered",
        "amount_tendered_main",
    ]
    df = required(raw, needed)
    df = _cities(df, cities, F.col("flight_origin"), F.col("flight_destination"))
    df = _currency(df, currencies).select(
        F.substr("session_no", F.lit(8)).alias("session_id"),
        F.col("order_no").alias("load_id"),
        F.col("ticket_id").alias("slip_id"),
        anonymize_flight(F.col("flight_no")).alias("flight_no"),
        "origin",
        "destination",
        date_from_iso(F.col("scheduled_date")).alias("date"),
        to_time(_part(F.col("scheduled_date"), "T", 2)).alias("time"),
        F.coalesce(F.col("offline").cast("boolean"), F.lit(False)).alias("is_offline_mode"),
        "sales_type",
        "payment_type",
        F.col("amount_tendered").cast(MONEY).alias("purchase_amount"),
        F.col("currency_id").alias("currency"),
        F.col("amount_tendered_main").cast(MONEY).alias("purchase_amount_main"),
        F.col("currency_id").alias("main_currency"),
        F.substring("card_digits", 1, 6).alias("card_number_prefix"),
        "card_type",
    )
    return distinct_rows(_in_window(df, cfg))


def stg_sales(
    raw: DataFrame, cities: DataFrame, currencies: DataFrame, cfg: WarehouseConfig, deal: Sequence[str] | None = None
) -> DataFrame:
    needed = [
        "session_no",
        "order_no",
        "flight_no",
        "scheduled_date",
        "ticket_id",
        "sales_type",
        "item_reference",
        "qty_sold",
        "sale_amount",
    ]
    # a missing price or discount counts as zero
    fits = F.coalesce("item_price", F.lit(0)) >= 0
    fits &= F.coalesce("promotion_discount", F.lit(0)) >= 0
    df = required(raw, needed).where(fits)
    df = _cities(df, cities, F.col("flight_origin"), F.col("flight_destination"))
    df = _currency(df, currencies).select(
        F.substr("session_no", F.lit(8)).alias("session_id"),
        F.col("order_no").alias("load_id"),
        anonymize_flight(F.col("flight_no")).alias("flight_no"),
        "origin",
        "destination",
        date_from_iso(F.col("scheduled_date")).alias("date"),
        to_time(_part(F.col("scheduled_date"), "T", 2)).alias("time"),
        F.col("ticket_id").alias("slip_id"),
        "sales_type",
        F.col("currency_id").alias("currency"),
        F.col("item_reference").alias("item_id"),
        or_unknown(F.col("item_category")).alias("item_category"),
        F.coalesce("item_price", F.lit(0)).cast(MONEY).alias("price"),
        F.col("qty_sold").cast("int").alias("sold_quantity"),
        F.col("sale_amount").cast(MONEY).alias("purchase_amount"),
        F.coalesce("promotion_discount", F.lit(0)).cast(MONEY).alias("discount_amount"),
    )
    return distinct_rows(_in_window(df, cfg), deal)


def stg_wastage(raw: DataFrame, cities: DataFrame, cfg: WarehouseConfig) -> DataFrame:
    raw = required(raw, ["order_no", "flight_no", "scheduled_date", "item_reference"])
    raw = non_negative(raw, ["ordered_qty", "sold_qty", "damaged_waste_qty", "qty_fresh_waste"])
    route = F.col("scheduled_route")
    df = _cities(raw, cities, _part(route, "-", 1), _part(route, "-", 2)).select(
        F.col("order_no").alias("load_id"),
        anonymize_flight(F.col("flight_no")).alias("flight_no"),
        "origin",
        "destination",
        date_from_short(F.col("scheduled_date")).alias("date"),
        or_unknown(F.col("item_category")).alias("item_category"),
        F.col("item_reference").alias("item_id"),
        or_unknown(F.col("item_type")).alias("item_type"),
        F.col("ordered_qty").cast("int").alias("load_quantity"),
        F.col("sold_qty").cast("int").alias("sold_quantity"),
        F.col("damaged_waste_qty").cast("int").alias("wastage_quantity"),
        F.col("qty_fresh_waste").cast("int").alias("fresh_wastage_quantity"),
    )
    return distinct_rows(_in_window(df, cfg))
