"""The older staging of all seven raw datasets, and how their days are read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygalley.plans import legacy_staging as old
from skygalley.registry.base import Lab, plain, query
from skygalley.registry.oracle import city, clock, double, masked, staged, stamp

_ALL_DAYS = old.OldStaging("0001-01-01", "9999-12-31")


def _kept(sql: str) -> str:
    return f"SELECT * FROM ({sql}) WHERE date BETWEEN DATE '2026-01-01' AND DATE '2026-03-31'"


def _raw(lab: Lab, name: str) -> DataFrame:
    """A raw dataset; days of wastage and lines are written in two ways, by the parity of load and day."""
    df = lab.tables.fixture(f"fx_{name}")
    if name == "wastage":
        long = F.concat(F.translate(F.substring("scheduled_date", 1, 6), "/", "-"), F.lit("20"), F.substring("scheduled_date", 7, 2))
        df = df.withColumn("scheduled_date", F.when(F.col("order_no") % 2 == 1, long).otherwise(F.col("scheduled_date")))
    if name == "schedule":
        at = F.col("scheduled_datetime")
        parts = [F.substring(at, start, size) for start, size in ((9, 2), (6, 2), (3, 2))]
        short = F.concat(F.concat_ws("/", *parts), F.substring(at, 11, 9))
        df = df.withColumn("scheduled_datetime", F.when(F.substring(at, 10, 1).cast("int") % 2 == 1, short).otherwise(at))
    return df


def _cities(lab: Lab) -> DataFrame:
    return lab.tables.fixture("fx_cities")


@query(
    "legacy_staging_pax",
    _kept(
        staged(
            "fx_pax",
            ("flight_no", "date"),
            window=False,
            unsigned=("pax_quantity",),
            flight_no=masked("flight_number"),
            date="CAST(strptime(scheduled_date, '%d/%m/%y') AS DATE)",
            time=clock("scheduled_time"),
            origin=city("raw.origin"),
            destination=city("raw.destination"),
            **{"class": "class"},
            pax_quantity="CAST(pax AS INTEGER)",
        )
    ),
)
def _pax(lab: Lab):
    return old.pax(_raw(lab, "pax"), _cities(lab))


@query(
    "legacy_staging_sales",
    f"""SELECT * REPLACE ({double("price", "purchase_amount", "discount_amount")}) FROM ({_kept(
        staged(
            "fx_sales",
            ("session_id", "load_id", "flight_no", "slip_id", "sales_type", "item_id", "purchase_amount"),
            window=False,
            unsigned=("sold_quantity", "price", "discount_amount"),
            session_id="substring(session_no, 8)",
            load_id="order_no",
            flight_no=masked("flight_no"),
            origin=city("raw.flight_origin"),
            destination=city("raw.flight_destination"),
            slip_id="ticket_id",
            sales_type="sales_type",
            item_category="item_category",
            item_id="item_reference",
            price="item_price",
            sold_quantity="CAST(qty_sold AS INTEGER)",
            purchase_amount="sale_amount",
            discount_amount="promotion_discount",
            date="CAST(substring(scheduled_date, 1, 10) AS DATE)",
            time=stamp("scheduled_date", "T"),
        )
    )})""",
)
def _sales(lab: Lab):
    return plain(old.sales(_raw(lab, "sales"), _cities(lab)))


@query(
    "legacy_staging_payments",
    f"""SELECT * REPLACE ({double("purchase_amount")}) FROM ({_kept(
        staged(
            "fx_payments",
            ("session_id", "load_id", "slip_id", "flight_no", "sales_type", "payment_type", "purchase_amount"),
            window=False,
            session_id="substring(session_no, 8)",
            load_id="order_no",
            slip_id="ticket_id",
            flight_no=masked("flight_no"),
            origin=city("raw.flight_origin"),
            destination=city("raw.flight_destination"),
            is_offline_mode="CAST(offline AS BOOLEAN)",
            sales_type="sales_type",
            payment_type="payment_type",
            purchase_amount="amount_tendered",
            card_number_prefix="substring(card_digits, 1, 6)",
            card_type="card_type",
            date="CAST(substring(scheduled_date, 1, 10) AS DATE)",
            time=stamp("scheduled_date", "T"),
        )
    )})""",
)
def _payments(lab: Lab):
    """A mode of payment that the extract leaves out stays missing."""
    return plain(old.payments(_raw(lab, "payments"), _cities(lab)))


_SCHEDULE = staged(
    "fx_schedule",
    ("line_id", "flight_no", "date"),
    window=False,
    line_id="line_id",
    flight_no=masked("flight_no"),
    origin=city("raw.iata_departure"),
    destination=city("raw.iata_destination"),
    date="CAST(substring(scheduled_datetime, 1, 10) AS DATE)",
    time=stamp("scheduled_datetime", " "),
    load_id="order_no",
)


@query("legacy_staging_schedule", _kept(_SCHEDULE))
def _schedule(lab: Lab):
    """Days of two patterns in one extract."""
    return old.schedule(_raw(lab, "schedule"), _cities(lab))


_WASTE = staged(
    "fx_wastage",
    ("load_id", "flight_no", "date", "item_id"),
    window=False,
    unsigned=("load_quantity", "sold_quantity", "wastage_quantity", "fresh_wastage_quantity"),
    load_id="order_no",
    flight_no=masked("flight_no"),
    origin=city("split_part(raw.scheduled_route, '-', 1)"),
    destination=city("split_part(raw.scheduled_route, '-', 2)"),
    date="CAST(strptime(scheduled_date, '%d/%m/%y') AS DATE)",
    item_category="item_category",
    item_id="item_reference",
    item_type="item_type",
    load_quantity="ordered_qty",
    sold_quantity="sold_qty",
    wastage_quantity="damaged_waste_qty",
    fresh_wastage_quantity="qty_fresh_waste",
)


@query(
    "legacy_staging_wastage",
    f"""SELECT w.*, s.time FROM ({_kept(_WASTE)}) w LEFT JOIN
        (SELECT flight_no, date, min(time) AS time FROM ({_SCHEDULE}) GROUP BY flight_no, date) s
        ON w.flight_no = s.flight_no AND w.date = s.date""",
)
def _wastage(lab: Lab):
    """Days of two patterns; the time of day is that of the first scheduled row of the flight and day."""
    scheduled = old.schedule(_raw(lab, "schedule"), _cities(lab), _ALL_DAYS)
    return old.wastage(_raw(lab, "wastage"), scheduled, _cities(lab))


@query(
    "legacy_staging_catalog",
    f"""SELECT DISTINCT reference AS item_id, status, family AS item_category,
        CASE upper(food) WHEN 'YES' THEN true WHEN 'NO' THEN false END AS is_food, type AS item_type,
        {double("selling_price").replace("AS selling_price", "AS price")} FROM fx_product_catalog
        WHERE reference IS NOT NULL AND family IS NOT NULL AND selling_price IS NOT NULL""",
)
def _catalog(lab: Lab):
    return plain(old.catalog(_raw(lab, "product_catalog")))


@query(
    "legacy_staging_bank",
    "SELECT DISTINCT "
    + ", ".join(
        f"coalesce({c}, 'UNKNOWN') AS {name}"
        for c, name in (
            ("bin", "card_number_prefix"),
            ("brand", "brand"),
            ("type", "type"),
            ("category", "category"),
            ("issuer", "issuer"),
            ("alpha_3", "country_short"),
            ("country", "country"),
        )
    )
    + " FROM fx_bank",
)
def _bank(lab: Lab):
    return old.bank(_raw(lab, "bank"))


_ODD_DAY = "CAST(substring(scheduled_datetime, 10, 1) AS INTEGER) % 2 = 1"


@query(
    "legacy_date_counts",
    f"""SELECT 'pax' AS dataset, 'dd/MM/yy' AS pattern, count(*) AS n FROM fx_pax
        UNION ALL SELECT 'sales', 'yyyy-MM-dd', count(*) FROM fx_sales
        UNION ALL SELECT 'payments', 'yyyy-MM-dd', count(*) FROM fx_payments
        UNION ALL SELECT 'wastage', CASE WHEN order_no % 2 = 1 THEN 'dd-MM-yyyy' ELSE 'dd/MM/yy' END, count(*)
                  FROM fx_wastage GROUP BY 2
        UNION ALL SELECT 'schedule', CASE WHEN {_ODD_DAY} THEN 'dd/MM/yy' ELSE 'yyyy-MM-dd' END, count(*)
                  FROM fx_schedule GROUP BY 2""",
)
def _counts(lab: Lab):
    """How many days each stated pattern reads, per dataset; refused days would show as ``none``."""
    found = [
        old.count_dates(_raw(lab, name), name).select(F.lit(name).alias("dataset"), "pattern", "n")
        for name in old.FORMATS
    ]
    return reduce(DataFrame.unionByName, found)
