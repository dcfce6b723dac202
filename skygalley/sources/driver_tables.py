"""Raw-shaped airline datasets derived from the TPC-H-like test tables.

Every dataset reads the whole of the tables it names. The texts hold ``{name}`` for each input;
Spark fills in DataFrames, the SQL check fills in view names.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from skygalley.sources.sinks import overwrite

TABLES = ("region", "nation", "part", "orders", "lineitem")

FIXTURES: dict[str, str] = {
    "fx_base": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, fl, dd,
       'XY' || CAST(100 + fl AS STRING) AS flight_no,
       'NATION_' || CAST(fl AS STRING) AS origin,
       'NATION_' || CAST((fl * 3 + 1) % 25 AS STRING) AS destination,
       CAST(DATE '2025-11-01' + dd AS DATE) AS fdate,
       lpad(CAST((fl * 5 + dd % 3) % 24 AS STRING), 2, '0') || ':' ||
           lpad(CAST((dd % 4) * 15 AS STRING), 2, '0') AS hhmm,
       'L' || CAST(CAST(floor(fl / 2.0) AS INT) AS STRING) || '_' || CAST(dd AS STRING) AS line_id,
       CAST(floor(fl / 2.0) AS INT) * 1000 + dd AS load_id
FROM (SELECT *, CAST(o_orderkey % 17 AS INT) AS fl, CAST(o_orderkey % 130 AS INT) AS dd
      FROM {orders}) o""",
    "fx_cities": """
SELECT n_name AS iata_code, 'city_' || lpad(CAST(n_nationkey AS STRING), 3, '0') AS city_id
FROM {nation} WHERE n_nationkey < 20""",
    "fx_currencies": """
SELECT 'USD' AS currency_code, 'cur_001' AS currency_id""",
    "fx_sales": """
SELECT 'SESSION' || CAST(b.fl * 1000 + b.dd AS STRING) AS session_no, b.load_id AS order_no,
       b.flight_no, b.origin AS flight_origin, b.destination AS flight_destination,
       CAST(b.fdate AS STRING) || 'T' || b.hhmm || ':00' AS scheduled_date,
       'T' || CAST(l_orderkey AS STRING) AS ticket_id,
       CASE WHEN l_returnflag = 'R' THEN 'Refund' ELSE 'Sale' END AS sales_type,
       CASE WHEN l_linenumber = 1 THEN NULL ELSE 'CAT' END AS item_category,
       'P' || CAST(l_partkey AS STRING) AS item_reference,
       CASE WHEN l_linestatus = 'O' THEN 'USD' ELSE 'EUR' END AS currency,
       CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_quantity AS DECIMAL(18,2)) END AS item_price,
       CAST(l_quantity AS INT) AS qty_sold,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS sale_amount,
       CASE WHEN l_discount = 0 THEN NULL
            ELSE CAST(round(l_discount * 100) AS DECIMAL(18,2)) END AS promotion_discount
FROM {lineitem} JOIN {fx_base} b ON l_orderkey = b.o_orderkey""",
    "fx_payments": """
SELECT 'SESSION' || CAST(fl * 1000 + dd AS STRING) AS session_no, load_id AS order_no,
       'T' || CAST(o_orderkey AS STRING) AS ticket_id, flight_no,
       origin AS flight_origin, destination AS flight_destination,
       CAST(fdate AS STRING) || 'T' || hhmm || ':00' AS scheduled_date,
       CASE WHEN o_custkey % 3 = 0 THEN 'true' WHEN o_custkey % 3 = 1 THEN 'false' ELSE NULL END AS offline,
       CASE o_orderstatus WHEN 'F' THEN 'Refund' WHEN 'O' THEN 'Sale' ELSE 'Change Given' END AS sales_type,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Card'
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'RAK Voucher' ELSE 'Cash' END AS payment_type,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount_tendered, 'USD' AS currency,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount_tendered_main, 'USD' AS main_currency,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
            THEN '4' || lpad(CAST(o_custkey % 30 AS STRING), 5, '0') || 'XXXX' ELSE NULL END AS card_digits,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'VISA' ELSE NULL END AS card_type
FROM {fx_base}""",
    "fx_bank": """
SELECT '4' || lpad(CAST(n_nationkey AS STRING), 5, '0') AS bin,
       CASE WHEN n_nationkey % 2 = 0 THEN 'VISA' ELSE NULL END AS brand, 'DEBIT' AS type,
       CAST(NULL AS STRING) AS category, n_name AS issuer, r_name AS alpha_3, r_name AS country
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "fx_pax": """
SELECT DISTINCT flight_no AS flight_number,
       substring(CAST(fdate AS STRING), 9, 2) || '/' || substring(CAST(fdate AS STRING), 6, 2) || '/' ||
           substring(CAST(fdate AS STRING), 3, 2) AS scheduled_date,
       hhmm AS scheduled_time, origin, destination,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Business' ELSE 'Economy' END AS class,
       CASE WHEN (fl + dd) % 23 = 0 THEN 0 ELSE 40 + (fl * 7 + dd) % 90 END AS pax
FROM {fx_base} WHERE fl NOT IN (13, 16) AND dd % 10 <> 0""",
    "fx_schedule": """
SELECT DISTINCT line_id, flight_no, origin AS iata_departure, destination AS iata_destination,
       CAST(fdate AS STRING) || ' ' || hhmm AS scheduled_datetime,
       CASE WHEN fl % 2 = 1 THEN NULL ELSE load_id END AS order_no
FROM {fx_base} WHERE fl < 14""",
    "fx_line_load": """
SELECT line_id, flight_no, iata_departure, iata_destination,
       scheduled_datetime AS scheduled_datetime_utc, order_no
FROM {fx_schedule}""",
    "fx_items_load": """
SELECT b.flight_no AS flight_number, replace(CAST(b.fdate AS STRING), '-', '/') || ' ' || b.hhmm AS departure_date,
       b.load_id AS order_num, 'P' || CAST(l_partkey AS STRING) AS item_reference,
       CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(l_quantity AS INT) END AS total_qty_loaded
FROM {lineitem} JOIN {fx_base} b ON l_orderkey = b.o_orderkey""",
    "fx_wastage": """
SELECT b.load_id AS order_no, b.flight_no, b.origin || '-' || b.destination AS scheduled_route,
       substring(CAST(b.fdate AS STRING), 9, 2) || '/' || substring(CAST(b.fdate AS STRING), 6, 2) || '/' ||
           substring(CAST(b.fdate AS STRING), 3, 2) AS scheduled_date,
       CASE WHEN l_linenumber = 2 THEN NULL ELSE 'CAT' END AS item_category,
       'P' || CAST(l_partkey AS STRING) AS item_reference,
       CASE WHEN l_linenumber = 4 THEN NULL ELSE 'Ambient' END AS item_type,
       CAST(l_quantity AS INT) + 5 AS ordered_qty, CAST(l_quantity AS INT) AS sold_qty,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE l_linenumber % 3 END AS damaged_waste_qty,
       l_linenumber % 2 AS qty_fresh_waste
FROM {lineitem} JOIN {fx_base} b ON l_orderkey = b.o_orderkey WHERE l_returnflag = 'N'""",
    "fx_product_catalog": """
SELECT 'P' || CAST(p_partkey AS STRING) AS reference,
       CASE WHEN p_size % 5 = 0 THEN 'Inactive' ELSE 'Active' END AS status,
       CASE WHEN p_type = 'PROMO' THEN 'BOL Products' ELSE p_type END AS family,
       CASE WHEN p_size % 2 = 0 THEN 'YES' ELSE 'NO' END AS food,
       CASE WHEN length(p_brand) = 7 THEN 'Fresh Product' ELSE 'Ambient' END AS type,
       CAST(p_retailprice AS DECIMAL(18,2)) AS selling_price
FROM {part}""",
}

# Lines of orders with what their flights lend them: three raw datasets start from this join.
_JOIN = "{lineitem} JOIN {fx_base} b ON l_orderkey = b.o_orderkey"
_LINES = f"""
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag, l_linestatus,
       b.fl, b.dd, b.flight_no, b.origin, b.destination, b.fdate, b.hhmm, b.load_id
FROM {_JOIN}"""

_INPUT = re.compile(r"\{(\w+)\}")


def inputs_of(text: str) -> list[str]:
    return sorted(set(_INPUT.findall(text)))


class DriverTables:
    """The tables of one folder and the raw datasets derived from them.

    With ``root`` each raw dataset is landed once as a Parquet table, the way raw extracts are loaded
    before anything reads them; staging then prunes columns and pushes filters into those files. The lines of
    orders are joined to their flights and landed once for all three datasets made of them: the joined tables are
    shuffled once, and those datasets, each a projection of the landed lines, are not written again. Nor are the payments,
    a projection of the orders (``PROJECTIONS``).
    """

    JOIN_KEY = {"lineitem": "l_orderkey", "orders": "o_orderkey"}
    PROJECTIONS = ("sales", "items_load", "wastage", "payments")
    RAW = (
        "sales",
        "payments",
        "bank",
        "pax",
        "schedule",
        "line_load",
        "items_load",
        "wastage",
        "product_catalog",
        "cities",
        "currencies",
    )

    def __init__(self, spark: SparkSession, folder: str, root: str | None = None):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.root = root.rstrip("/") if root else None
        self._derived: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def fixture(self, name: str) -> DataFrame:
        if name not in self._derived:
            text, raw = FIXTURES[name], name.removeprefix("fx_")
            df = self._lines(text) if self.root and _JOIN in text else self._filled(text)
            if self.root and raw in self.RAW and raw not in self.PROJECTIONS:
                df = overwrite(df, f"{self.root}/raw/{raw}")
            self._derived[name] = df
        return self._derived[name]

    def _filled(self, text: str) -> DataFrame:
        frames = {i: self.fixture(i) if i in FIXTURES else self.table(i) for i in inputs_of(text)}
        return self.spark.sql(text, **frames)

    def _lines(self, text: str) -> DataFrame:
        """A dataset over the landed lines."""
        if "lines" not in self._derived:
            flights = self.spark.sql(FIXTURES["fx_base"], orders=self._spread("orders"))
            lines = self.spark.sql(_LINES, lineitem=self._spread("lineitem"), fx_base=flights)
            self._derived["lines"] = overwrite(lines, f"{self.root}/lines")
        return self.spark.sql(text.replace(_JOIN, "{lines} b"), lines=self._derived["lines"])

    def _spread(self, name: str) -> DataFrame:
        """One of the two big tables, dealt by the key they are joined on."""
        return self.table(name).repartition(self.JOIN_KEY[name])

    def raw(self) -> Mapping[str, DataFrame]:
        """The raw datasets and seeds under the names the warehouse expects, landed on first use."""
        return _OnDemand(self)


class _OnDemand(Mapping):
    def __init__(self, tables: DriverTables):
        self._tables = tables

    def __getitem__(self, name: str) -> DataFrame:
        if name not in DriverTables.RAW:
            raise KeyError(name)
        return self._tables.fixture(f"fx_{name}")

    def __iter__(self):
        return iter(DriverTables.RAW)

    def __len__(self) -> int:
        return len(DriverTables.RAW)
