"""The quality rules of the warehouse, as published with it."""

from __future__ import annotations

from skygalley.operators.quality import (
    Accepted,
    Expression,
    NoRows,
    NotNull,
    Relationship,
    Rule,
    Unique,
)

# Which columns must be present, unique, in a list, or point to a parent.
_PRESENT = {
    "stg_bank": ("card_number_prefix", "brand", "country_short"),
    "stg_catalog": ("item_id", "item_category", "price"),
    "stg_pax": ("flight_no", "origin", "destination", "pax_quantity"),
    "stg_sales": (
        "session_id",
        "load_id",
        "flight_no",
        "date",
        "time",
        "slip_id",
        "sales_type",
        "item_id",
        "sold_quantity",
        "purchase_amount",
    ),
    "stg_payments": (
        "session_id",
        "load_id",
        "slip_id",
        "flight_no",
        "sales_type",
        "payment_type",
        "purchase_amount",
    ),
    "stg_wastage": (
        "load_id",
        "flight_no",
        "date",
        "item_id",
        "load_quantity",
        "sold_quantity",
        "wastage_quantity",
        "fresh_wastage_quantity",
    ),
    "stg_schedule": ("line_id", "flight_no", "date"),
    "stg_line": ("line_id", "flight_no", "origin", "destination"),
    "stg_items_load": ("flight_no", "date", "time", "load_id", "item_id", "total_loaded_quantity"),
    "int_flights": ("flight_no", "origin", "destination", "date", "source", "rn"),
    "int_hours": ("hour",),
    "int_line_route": ("line_id", "connected_flights", "route"),
    "int_flight_load": ("line_id", "flight_number", "origin", "destination", "date", "time", "load_id"),
    "dim_time": ("time_key", "hour", "is_night", "day_period", "am_pm"),
    "dim_date": ("date_key", "date", "year", "month", "day", "quarter", "week_day", "is_weekend"),
    "dim_card": ("card_number_prefix",),
    "dim_sessions": ("sales_session_id",),
    "dim_flights": ("flight_key", "flight_key_with_date", "flight_number", "origin", "destination", "date"),
    "dim_products": ("product_key", "item_id"),
    "bridge_flight_load": ("line_id", "flight_key", "load_id"),
    "fact_sales": ("sale_transaction_key", "flight_key", "product_key"),
    "fact_wastage": ("wastage_record_key", "flight_key_with_date", "product_key"),
    "fact_pax": ("passenger_count_key", "flight_key", "travel_class"),
    "fact_items_load": ("item_load_key", "flight_key", "load_id", "product_key"),
    "fact_payments": ("payment_transaction_key", "flight_key", "slip_id", "sales_type", "payment_type"),
    "mart_fresh_food_order_sale": (
        "flight_key",
        "flight_number",
        "origin",
        "destination",
        "date",
        "year",
        "item_id",
        "sold_quantity",
    ),
}

_UNIQUE = {
    "stg_bank": "card_number_prefix",
    "stg_catalog": "item_id",
    "int_hours": "hour",
    "int_line_route": "load_id",
    "dim_time": "time_key",
    "dim_date": "date_key",
    "dim_card": "card_number_prefix",
    "dim_sessions": "sales_session_id",
    "dim_flights": "flight_key",
    "dim_products": "product_key",
    "bridge_flight_load": "flight_key",
    "fact_sales": "sale_transaction_key",
    "fact_wastage": "wastage_record_key",
    "fact_pax": "passenger_count_key",
    "fact_items_load": "item_load_key",
    "fact_payments": "payment_transaction_key",
}

_UNIQUE_TOGETHER = {
    "int_flights": ("flight_no", "origin", "destination", "date"),
    "int_flight_load": ("flight_number", "date", "time"),
    "bridge_flight_load": ("flight_key",),
    "fact_sales": ("slip_id", "product_key", "sales_type"),
    "fact_wastage": ("flight_key_with_date", "product_key", "load_id"),
    "fact_pax": ("flight_key", "travel_class"),
    "fact_items_load": ("flight_key", "load_id", "product_key"),
    "fact_payments": ("slip_id", "sales_type", "payment_type", "card_number_prefix"),
    "mart_fresh_food_order_sale": ("flight_key", "item_id"),
}

_PARENTS = (
    ("dim_flights", "date", "dim_date", "date_key"),
    ("dim_flights", "hour_of_departure", "dim_time", "time_key"),
    ("bridge_flight_load", "flight_key", "dim_flights", "flight_key"),
    ("fact_sales", "flight_key", "dim_flights", "flight_key"),
    ("fact_sales", "sales_session_id", "dim_sessions", "sales_session_id"),
    ("fact_sales", "product_key", "dim_products", "product_key"),
    ("fact_wastage", "flight_key_with_date", "dim_flights", "flight_key_with_date"),
    ("fact_wastage", "product_key", "dim_products", "product_key"),
    ("fact_pax", "flight_key", "dim_flights", "flight_key"),
    ("fact_items_load", "flight_key", "dim_flights", "flight_key"),
    ("fact_items_load", "product_key", "dim_products", "product_key"),
    ("fact_payments", "flight_key", "dim_flights", "flight_key"),
    ("fact_payments", "sales_session_id", "dim_sessions", "sales_session_id"),
    ("fact_payments", "card_number_prefix", "dim_card", "card_number_prefix"),
    ("mart_fresh_food_order_sale", "flight_key", "dim_flights", "flight_key"),
    ("mart_fresh_food_order_sale", "hour_of_departure", "dim_time", "time_key"),
    ("mart_fresh_food_order_sale", "item_id", "dim_products", "item_id"),
)

_ACCEPTED = (
    ("stg_sales", "sales_type", ("Sale", "Refund")),
    ("stg_payments", "sales_type", ("Sale", "Refund", "Change Given")),
    ("stg_payments", "payment_type", ("Card", "Cash", "RAK Voucher")),
    (
        "int_flights",
        "source",
        ("SCHEDULE", "WASTAGE", "SALES", "PAYMENTS", "PAX", "ITEMS_LOAD"),
    ),
    ("dim_time", "day_period", ("Night", "Morning", "Day", "Evening")),
    ("dim_time", "am_pm", ("AM", "PM")),
)

_TRUE = (
    ("stg_catalog", "price > 0"),
    ("stg_pax", "origin like 'city%'"),
    ("stg_pax", "destination like 'city%'"),
    ("stg_pax", "pax_quantity >= 0 and pax_quantity < 250"),
    ("stg_wastage", "load_quantity >= 0"),
    ("stg_wastage", "sold_quantity >= 0"),
    ("stg_wastage", "wastage_quantity >= 0"),
    ("stg_wastage", "fresh_wastage_quantity >= 0"),
    ("stg_line", "flight_no like 'AB%'"),
    ("stg_items_load", "flight_no like 'AB%'"),
    ("stg_items_load", "total_loaded_quantity >= 0"),
    (
        "fact_pax",
        "(number_of_passengers = 0 and potential_error = 'zero_pax_count')"
        " or (number_of_passengers > 0 and potential_error is null)",
    ),
    (
        "mart_fresh_food_order_sale",
        "(number_of_passengers is null and potential_error = 'no_pax_data')"
        " or (number_of_passengers = 0 and potential_error = 'zero_pax_count')"
        " or (number_of_passengers > 0 and potential_error is null)",
    ),
)

_BUSINESS = (
    (
        "stg_payments",
        "change_given_mirrors_cash",
        "sales_type = 'Change Given' and payment_type = 'Cash'"
        " and purchase_amount != -purchase_amount_main",
    ),
    ("stg_sales", "sale_quantity_not_negative", "sales_type = 'Sale' and sold_quantity < 0"),
    ("stg_sales", "sale_amount_not_negative", "sales_type = 'Sale' and purchase_amount < 0"),
)

NOT_NULL: list[Rule] = [
    *[NotNull(t, c) for t, columns in _PRESENT.items() for c in columns],
    NotNull("int_line_route", "load_id", "potential_error is null"),
]
UNIQUE: list[Rule] = [Unique(t, (c,)) for t, c in _UNIQUE.items()]
UNIQUE_TOGETHER: list[Rule] = [
    Unique(t, c, combination=True) for t, c in _UNIQUE_TOGETHER.items()
]
RELATIONSHIPS: list[Rule] = [Relationship(*p) for p in _PARENTS]
ACCEPTED: list[Rule] = [Accepted(*a) for a in _ACCEPTED]
EXPRESSIONS: list[Rule] = [Expression(*e) for e in _TRUE]
BUSINESS: list[Rule] = [NoRows(*b) for b in _BUSINESS]

ALL: list[Rule] = [
    *NOT_NULL,
    *UNIQUE,
    *UNIQUE_TOGETHER,
    *RELATIONSHIPS,
    *ACCEPTED,
    *EXPRESSIONS,
    *BUSINESS,
]

LEGACY: list[Rule] = [
    *[
        Unique(t, (c,))
        for t, c in (
            ("dim_product", "product_sur_id"),
            ("dim_flight", "flight_sur_id"),
            ("dim_date", "date_sur_id"),
            ("dim_load", "load_sur_id"),
            ("dim_card", "card_sur_key"),
            ("dim_session", "session_sur_id"),
            ("fact_pax", "pax_sur_id"),
            ("fact_payment", "payment_sur_id"),
            ("fact_sales", "sales_sur_id"),
            ("fact_wastage", "wastage_sur_id"),
        )
    ],
    *[
        Relationship(*r)
        for r in (
            ("fact_pax", "flight_key", "dim_flight", "flight_sur_id"),
            ("fact_pax", "date_key", "dim_date", "date_sur_id"),
            ("fact_payment", "flight_key", "dim_flight", "flight_sur_id"),
            ("fact_payment", "session_key", "dim_session", "session_sur_id"),
            ("fact_payment", "card_key", "dim_card", "card_sur_key"),
            ("fact_payment", "date_key", "dim_date", "date_sur_id"),
            ("fact_sales", "flight_key", "dim_flight", "flight_sur_id"),
            ("fact_sales", "product_key", "dim_product", "product_sur_id"),
            ("fact_sales", "session_key", "dim_session", "session_sur_id"),
            ("fact_sales", "date_key", "dim_date", "date_sur_id"),
            ("fact_wastage", "flight_key", "dim_flight", "flight_sur_id"),
            ("fact_wastage", "item_key", "dim_product", "product_sur_id"),
            ("fact_wastage", "date_key", "dim_date", "date_sur_id"),
        )
    ],
]
