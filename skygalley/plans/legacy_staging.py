"""The older staging of the seven raw datasets.

It differs from today's staging in what it keeps and how it reads days, not in its steps: choose and rename columns,
read days by stated patterns, drop unusable rows and copies, keep a window of days. Three differences matter: rows
with a null in a quantity go, a day may be written in several ways, and a day that fits none is refused. Which days
would be refused, and how many rows each pattern reads, is counted by ``count_dates`` before a load.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygalley.functions import anonymize_flight, or_unknown, parse_dates, to_time, try_dates
from skygalley.operators.cleaning import date_window, distinct_rows, non_negative, required
from skygalley.operators.joins import fill_from_first, with_lookup

# Patterns of days, in the order they are tried, of the extracts of each dataset.
FORMATS: dict[str, tuple[str, ...]] = {
    "pax": ("dd/MM/yy",),
    "sales": ("yyyy-MM-dd",),
    "payments": ("yyyy-MM-dd",),
    "wastage": ("dd-MM-yyyy", "dd/MM/yy"),
    "schedule": ("dd/MM/yy", "yyyy-MM-dd"),
}
# The text column that holds a dataset's day, and what parts it from the time of day.
STAMPS: dict[str, tuple[str, str | None]] = {
    "pax": ("scheduled_date", None),
    "sales": ("scheduled_date", "T"),
    "payments": ("scheduled_date", "T"),
    "wastage": ("scheduled_date", None),
    "schedule": ("scheduled_datetime", " "),
}
# The first and the last day kept.
WINDOW = ("2026-01-01", "2026-03-31")


@dataclass(frozen=True)
class OldStaging:
    """The parameters of the older staging: window and patterns of days."""

    start: str = WINDOW[0]
    end: str = WINDOW[1]
    formats: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(FORMATS))


def _day_text(dataset: str) -> Column:
    name, separator = STAMPS[dataset]
    return F.col(name) if separator is None else F.split_part(F.col(name), F.lit(separator), F.lit(1))


def count_dates(raw: DataFrame, dataset: str, options: OldStaging = OldStaging()) -> DataFrame:
    """Rows by how their day was read: (pattern, n). The pattern is null for a missing day, ``none`` for a refused one.

    One pass; each task counts first, and there are as many rows as patterns and two.
    """
    text = _day_text(dataset)
    pattern = F.when(text.isNull(), F.lit(None).cast("string"))
    for p in options.formats[dataset]:
        pattern = pattern.when(try_dates(text, [p]).isNotNull(), F.lit(p))
    return raw.groupBy(pattern.otherwise(F.lit("none")).alias("pattern")).agg(F.count(F.lit(1)).alias("n"))


def _date(dataset: str, options: OldStaging) -> Column:
    return parse_dates(_day_text(dataset), options.formats[dataset]).alias("date")


def _time(dataset: str) -> Column:
    name, separator = STAMPS[dataset]
    return to_time(F.split_part(F.col(name), F.lit(separator), F.lit(2))).alias("time")


def _flight(raw: DataFrame, cities: DataFrame, number: str, origin: Column, destination: Column) -> DataFrame:
    """Adds flight_no, and the cities of both ends as from_city and to_city, UNKNOWN where there is none."""
    df = with_lookup(raw, origin, cities, "iata_code", "city_id", "from_city")
    df = with_lookup(df, destination, cities, "iata_code", "city_id", "to_city")
    return df.withColumn("flight_masked", anonymize_flight(F.col(number)))


def _ends() -> list[Column]:
    return [F.col("from_city").alias("origin"), F.col("to_city").alias("destination")]


def _clean(df: DataFrame, options: OldStaging, needed: Sequence[str], unsigned: Sequence[str] = ()) -> DataFrame:
    """Rows with all values, none of them negative, inside the window, once each."""
    df = required(df, needed)
    df = non_negative(df, unsigned) if unsigned else df
    return distinct_rows(date_window(df, options.start, options.end))


def pax(raw: DataFrame, cities: DataFrame, options: OldStaging = OldStaging()) -> DataFrame:
    df = _flight(raw, cities, "flight_number", F.col("origin"), F.col("destination")).select(
        F.col("flight_masked").alias("flight_no"),
        _date("pax", options),
        to_time(F.col("scheduled_time")).alias("time"),
        *_ends(),
        "class",
        F.col("pax").cast("int").alias("pax_quantity"),
    )
    return _clean(df, options, ["flight_no", "date"], ["pax_quantity"])


def sales(raw: DataFrame, cities: DataFrame, options: OldStaging = OldStaging()) -> DataFrame:
    """Without currency. A row without price or discount goes; today's staging reads them as zero."""
    df = _flight(raw, cities, "flight_no", F.col("flight_origin"), F.col("flight_destination")).select(
        F.substr("session_no", F.lit(8)).alias("session_id"),
        F.col("order_no").alias("load_id"),
        F.col("flight_masked").alias("flight_no"),
        *_ends(),
        F.col("ticket_id").alias("slip_id"),
        "sales_type",
        "item_category",
        F.col("item_reference").alias("item_id"),
        F.col("item_price").alias("price"),
        F.col("qty_sold").cast("int").alias("sold_quantity"),
        F.col("sale_amount").alias("purchase_amount"),
        F.col("promotion_discount").alias("discount_amount"),
        _date("sales", options),
        _time("sales"),
    )
    needed = ["session_id", "load_id", "flight_no", "slip_id", "sales_type", "item_id", "purchase_amount"]
    return _clean(df, options, needed, ["sold_quantity", "price", "discount_amount"])


def payments(raw: DataFrame, cities: DataFrame, options: OldStaging = OldStaging()) -> DataFrame:
    """Without currencies. A missing mode of payment stays missing; today's staging reads it as online."""
    df = _flight(raw, cities, "flight_no", F.col("flight_origin"), F.col("flight_destination")).select(
        F.substr("session_no", F.lit(8)).alias("session_id"),
        F.col("order_no").alias("load_id"),
        F.col("ticket_id").alias("slip_id"),
        F.col("flight_masked").alias("flight_no"),
        *_ends(),
        F.col("offline").cast("boolean").alias("is_offline_mode"),
        "sales_type",
        "payment_type",
        F.col("amount_tendered").alias("purchase_amount"),
        F.substring("card_digits", 1, 6).alias("card_number_prefix"),
        "card_type",
        _date("payments", options),
        _time("payments"),
    )
    needed = ["session_id", "load_id", "slip_id", "flight_no", "sales_type", "payment_type", "purchase_amount"]
    return _clean(df, options, needed)


def schedule(raw: DataFrame, cities: DataFrame, options: OldStaging = OldStaging()) -> DataFrame:
    df = _flight(raw, cities, "flight_no", F.col("iata_departure"), F.col("iata_destination")).select(
        "line_id",
        F.col("flight_masked").alias("flight_no"),
        *_ends(),
        _date("schedule", options),
        _time("schedule"),
        F.col("order_no").alias("load_id"),
    )
    return _clean(df, options, ["line_id", "flight_no"])


def wastage(
    raw: DataFrame, scheduled: DataFrame, cities: DataFrame, options: OldStaging = OldStaging()
) -> DataFrame:
    """``scheduled`` is the older schedule of all days: it lends the time of its flight's first row of the day."""
    route = F.col("scheduled_route")
    ends = [F.split_part(route, F.lit("-"), F.lit(i)) for i in (1, 2)]
    df = _flight(raw, cities, "flight_no", *ends).select(
        F.col("order_no").alias("load_id"),
        F.col("flight_masked").alias("flight_no"),
        *_ends(),
        _date("wastage", options),
        "item_category",
        F.col("item_reference").alias("item_id"),
        "item_type",
        F.col("ordered_qty").cast("long").alias("load_quantity"),
        F.col("sold_qty").cast("long").alias("sold_quantity"),
        F.col("damaged_waste_qty").cast("long").alias("wastage_quantity"),
        F.col("qty_fresh_waste").cast("long").alias("fresh_wastage_quantity"),
    )
    counts = ["load_quantity", "sold_quantity", "wastage_quantity", "fresh_wastage_quantity"]
    # copies go before the join: the time depends on flight and day alone
    df = _clean(df, options, ["load_id", "flight_no", "item_id"], counts)
    return fill_from_first(df, scheduled, ["flight_no", "date"], "time", [F.asc_nulls_last("time")])


def catalog(raw: DataFrame) -> DataFrame:
    """Any price counts, also zero or less. Food is ``Yes`` or ``No`` in any case; else it is not known."""
    food = F.upper("food")
    df = raw.select(
        F.col("reference").alias("item_id"),
        "status",
        F.col("family").alias("item_category"),
        F.when(food == "YES", F.lit(True)).when(food == "NO", F.lit(False)).alias("is_food"),
        F.col("type").alias("item_type"),
        F.col("selling_price").alias("price"),
    )
    return distinct_rows(required(df, ["item_id", "item_category", "price"]))


def bank(raw: DataFrame) -> DataFrame:
    """Every missing value reads UNKNOWN, that of the card prefix too, so no row is dropped for it."""
    names = {"bin": "card_number_prefix", "alpha_3": "country_short"}
    columns = ["bin", "brand", "type", "category", "issuer", "alpha_3", "country"]
    return distinct_rows(raw.select(*[or_unknown(F.col(c)).alias(names.get(c, c)) for c in columns]))
