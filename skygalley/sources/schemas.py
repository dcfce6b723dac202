"""Explicit layouts of the raw files: header text, column name used here, type.

Stating the types avoids the extra scan of schema inference and keeps loads stable.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TEXT = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()


@dataclass(frozen=True)
class RawDataset:
    pattern: str
    separator: str
    # (header in the file, name in the engine, type)
    columns: tuple[tuple[str, str, T.DataType], ...]
    # personal data: never carried past the reader
    prohibited: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [name for _, name, _ in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, kind) for _, name, kind in self.columns])


# The headers of the source extracts.
RAW_DATASETS: dict[str, RawDataset] = {
    "pax": RawDataset(
        "pax*",
        ";",
        (
            ("Flight Number", "flight_number", TEXT),
            ("Scheduled Date", "scheduled_date", TEXT),
            ("Scheduled Time", "scheduled_time", TEXT),
            ("Origin", "origin", TEXT),
            ("Destination", "destination", TEXT),
            ("Class", "class", TEXT),
            ("PAX", "pax", INT),
        ),
    ),
    "sales": RawDataset(
        "sales*",
        ",",
        (
            ("Session No", "session_no", TEXT),
            ("Order No", "order_no", LONG),
            ("Flight No", "flight_no", TEXT),
            ("Flight Origin", "flight_origin", TEXT),
            ("Flight Destination", "flight_destination", TEXT),
            ("Scheduled Date", "scheduled_date", TEXT),
            ("Ticket ID", "ticket_id", TEXT),
            ("Sales Type", "sales_type", TEXT),
            ("Item Category", "item_category", TEXT),
            ("Item Reference", "item_reference", TEXT),
            ("Currency", "currency", TEXT),
            ("Item Price", "item_price", MONEY),
            ("Qty Sold", "qty_sold", INT),
            ("Sale Amount", "sale_amount", MONEY),
            ("Promotion Discount", "promotion_discount", MONEY),
        ),
        prohibited=("Staff ID", "Staff Name"),
    ),
    "payments": RawDataset(
        "payment*",
        ",",
        (
            ("Session No", "session_no", TEXT),
            ("Order No", "order_no", LONG),
            ("Ticket ID", "ticket_id", TEXT),
            ("Flight No", "flight_no", TEXT),
            ("Flight Origin", "flight_origin", TEXT),
            ("Flight Destination", "flight_destination", TEXT),
            ("Scheduled Date", "scheduled_date", TEXT),
            ("Offline", "offline", TEXT),
            ("Sales Type", "sales_type", TEXT),
            ("Payment Type", "payment_type", TEXT),
            ("Amount Tendered", "amount_tendered", MONEY),
            ("Currency", "currency", TEXT),
            ("Amount Tendered (main)", "amount_tendered_main", MONEY),
            ("Main Currency", "main_currency", TEXT),
            ("Card Digits", "card_digits", TEXT),
            ("Card Type", "card_type", TEXT),
        ),
    ),
    "wastage": RawDataset(
        "wastage*",
        ",",
        (
            ("Order No", "order_no", LONG),
            ("Flight No", "flight_no", TEXT),
            ("Scheduled Route", "scheduled_route", TEXT),
            ("Scheduled Date", "scheduled_date", TEXT),
            ("Item Category", "item_category", TEXT),
            ("Item Reference", "item_reference", TEXT),
            ("Item Type", "item_type", TEXT),
            ("Ordered Qty", "ordered_qty", INT),
            ("Sold Qty", "sold_qty", INT),
            ("Damaged Waste Qty", "damaged_waste_qty", INT),
            ("QTY Fresh Waste", "qty_fresh_waste", INT),
        ),
    ),
    "schedule": RawDataset(
        "schedule*",
        ",",
        (
            ("line_id", "line_id", TEXT),
            ("flight_no", "flight_no", TEXT),
            ("iata_departure", "iata_departure", TEXT),
            ("iata_destination", "iata_destination", TEXT),
            ("scheduled_datetime", "scheduled_datetime", TEXT),
            ("order_no", "order_no", LONG),
        ),
    ),
    "product_catalog": RawDataset(
        "product_catalog*",
        ",",
        (
            ("Reference", "reference", TEXT),
            ("Status", "status", TEXT),
            ("Family", "family", TEXT),
            ("Food", "food", TEXT),
            ("Type", "type", TEXT),
            ("Selling Price", "selling_price", MONEY),
        ),
    ),
    "bank": RawDataset(
        "bank*",
        ",",
        (
            ("bin", "bin", TEXT),
            ("brand", "brand", TEXT),
            ("type", "type", TEXT),
            ("category", "category", TEXT),
            ("issuer", "issuer", TEXT),
            ("alpha_3", "alpha_3", TEXT),
            ("country", "country", TEXT),
        ),
    ),
    "items_load": RawDataset(
        "order_summary*",
        ",",
        (
            ("flight_number", "flight_number", TEXT),
            ("departure_date", "departure_date", TEXT),
            ("order_num", "order_num", LONG),
            ("item_reference", "item_reference", TEXT),
            ("total_qty_loaded", "total_qty_loaded", INT),
        ),
    ),
    "line_load": RawDataset(
        "lines*",
        ",",
        (
            ("line_id", "line_id", TEXT),
            ("flight_no", "flight_no", TEXT),
            ("iata_departure", "iata_departure", TEXT),
            ("iata_destination", "iata_destination", TEXT),
            ("scheduled_datetime_utc", "scheduled_datetime_utc", TEXT),
            ("order_no", "order_no", LONG),
        ),
    ),
}

SEEDS: dict[str, T.StructType] = {
    "cities_mapping": T.StructType(
        [T.StructField("iata_code", TEXT), T.StructField("city_id", TEXT)]
    ),
    "currency_mapping": T.StructType(
        [T.StructField("currency_code", TEXT), T.StructField("currency_id", TEXT)]
    ),
}
