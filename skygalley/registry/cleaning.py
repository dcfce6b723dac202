"""Sources, sinks and cleaning operators."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skygalley.functions import anonymize_flight
from skygalley.operators import cleaning
from skygalley.plans import legacy as old
from skygalley.plans import staging
from skygalley.registry.base import Lab, plain, query
from skygalley.registry.oracle import double
from skygalley.sources import readers, sinks
from skygalley.sources.schemas import RAW_DATASETS


def _land_csv(lab: Lab, dataset: str) -> str:
    """Write a raw dataset as delimited files with the headers of the source system."""

    def write() -> str:
        spec = RAW_DATASETS[dataset]
        df = lab.tables.fixture(f"fx_{dataset}")
        df = df.select(*[F.col(name).cast("string").alias(header) for header, name, _ in spec.columns])
        folder = f"{lab.root}/files"
        df.write.mode("overwrite").csv(
            f"{folder}/{spec.pattern.rstrip('*')}_1", sep=spec.separator, header=True
        )
        return folder

    return lab.keep(f"csv_{dataset}", write)


@query("src_csv", "SELECT flight_number, scheduled_date, scheduled_time, origin, destination, class, pax FROM fx_pax")
def _csv(lab: Lab):
    """Semicolon files, read back with their stated layout."""
    return readers.read_raw(lab.spark, _land_csv(lab, "pax"), "pax")


def _land_layouts(lab: Lab) -> str:
    """The sales in files of three layouts: as stated, in reverse order, and with two personal columns between."""

    def write() -> str:
        spec = RAW_DATASETS["sales"]
        sales = lab.tables.fixture("fx_sales")
        stated = [F.col(name).cast("string").alias(header) for header, name, _ in spec.columns]
        staff = [F.substring("ticket_id", 2, 3).alias("Staff ID"), F.col("item_reference").alias("Staff Name")]
        layouts = (stated, stated[::-1], [*stated[5:], *staff, *stated[:5]])
        folder = f"{lab.root}/layouts"
        part = F.pmod(F.crc32(F.col("ticket_id").cast("binary")), F.lit(len(layouts)))
        for i, columns in enumerate(layouts):
            rows = sales.where(part == i).select(*columns)
            rows.write.mode("overwrite").csv(f"{folder}/{spec.pattern.rstrip('*')}_{i}", sep=spec.separator, header=True)
        return folder

    return lab.keep("csv_layouts", write)


@query("src_csv_layouts", f"SELECT * REPLACE ({double('item_price', 'sale_amount', 'promotion_discount')}) FROM fx_sales")
def _csv_layouts(lab: Lab):
    """All sales, read from many files whose headers differ; personal columns stay behind."""
    return plain(readers.read_raw(lab.spark, _land_layouts(lab), "sales"))


@query("src_csv_comma", "SELECT * FROM fx_schedule")
def _csv_comma(lab: Lab):
    return readers.read_raw(lab.spark, _land_csv(lab, "schedule"), "schedule")


@query("src_parquet", "SELECT * FROM fx_wastage")
def _parquet(lab: Lab):
    """All wastage, landed as an extract and read back."""

    def write() -> str:
        path = f"{lab.root}/extracts/wastage"
        sinks.overwrite(lab.tables.fixture("fx_wastage"), path)
        return path

    return readers.read_parquet(lab.spark, lab.keep("parquet_wastage", write))


@query(
    "src_seed",
    """SELECT p.origin, c.city_id, count(*) AS n FROM fx_pax p
       LEFT JOIN fx_cities c ON p.origin = c.iata_code GROUP BY p.origin, c.city_id""",
)
def _seed(lab: Lab):
    def write() -> str:
        path = f"{lab.root}/seeds/cities_mapping"
        lab.tables.fixture("fx_cities").write.mode("overwrite").csv(path, header=True)
        return path

    seed = readers.read_seed(lab.spark, lab.keep("seed_cities", write), "cities_mapping")
    pax = lab.tables.fixture("fx_pax")
    joined = pax.join(seed, pax["origin"] == seed["iata_code"], "left")
    return joined.groupBy("origin", "city_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "src_filtered_mart",
    f"SELECT * REPLACE ({double('price')}) FROM mart_fresh_food_order_sale WHERE date >= DATE '2026-01-01'",
)
def _filtered(lab: Lab):
    lab.wh.ref("mart_fresh_food_order_sale")
    path = f"{lab.root}/warehouse/mart_fresh_food_order_sale"
    return plain(readers.read_mart_since(lab.spark, path, "2026-01-01"))


@query("drop_pii", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def _pii(lab: Lab):
    """Names and balances go; a listed column that the data lacks is no error."""
    return cleaning.drop_columns(lab.table("customer"), ["c_name", "c_acctbal", "Staff ID"])


@query("sink_overwrite", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def _overwrite(lab: Lab):
    """Writing twice leaves one copy."""

    def write():
        df = lab.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
        sinks.overwrite(df, f"{lab.root}/out/orders")
        return sinks.overwrite(df, f"{lab.root}/out/orders")

    return lab.keep("sink_overwrite", write)


@query(
    "sink_append_replace",
    """SELECT 'lookup_parts' AS table_name, count(*) AS n FROM part
       UNION ALL SELECT 'parts', 2 * count(*) FROM part""",
)
def _append(lab: Lab):
    def write():
        for table in ("lookup_parts", "parts"):
            for _ in range(2):
                sinks.append_or_replace(lab.table("part"), f"{lab.root}/append", table)
        return True

    lab.keep("sink_append", write)
    out = None
    for table in ("lookup_parts", "parts"):
        one = lab.spark.read.parquet(f"{lab.root}/append/{table}").agg(F.count(F.lit(1)).alias("n"))
        one = one.select(F.lit(table).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "sink_parquet_sample",
    """SELECT count(*) AS stored, least(count(*), 5) AS sample_csv, least(count(*), 5) AS sample_parquet
       FROM lineitem""",
)
def _sample(lab: Lab):
    def write():
        df = lab.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        return sinks.write_with_sample(df, f"{lab.root}/sampled", "lineitem")

    stored = lab.keep("sink_sample", write)
    folder = f"{lab.root}/sampled/samples"
    csv = lab.spark.read.csv(f"{folder}/lineitem_csv", header=True)
    parquet = lab.spark.read.parquet(f"{folder}/lineitem_parquet")
    n = F.count(F.lit(1))
    return stored.agg(n.alias("stored")).select(
        "stored",
        csv.agg(n).scalar().alias("sample_csv"),
        parquet.agg(n).scalar().alias("sample_parquet"),
    )


# Old rows: status as stored. New rows: finished orders under another status.
_OLD = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'"
_NEW = "SELECT o_orderkey, o_custkey, 'DONE' AS o_orderstatus FROM orders WHERE o_orderstatus <> 'O'"


def _merged(lab: Lab, keep: str) -> DataFrame:
    """The old orders stored by month, then the new ones merged into the months that they touch."""

    def write() -> DataFrame:
        path = f"{lab.root}/merged_{keep}"
        orders = lab.table("orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate")
        )
        sinks.overwrite_by_month(orders.where("o_orderstatus <> 'P'"), path, "o_orderdate")
        new = orders.where("o_orderstatus <> 'O'").withColumn("o_orderstatus", F.lit("DONE"))
        return sinks.merge_by_month(lab.spark, path, new, ["o_orderkey"], "o_orderdate", keep)

    return lab.keep(f"merged_{keep}", write).drop("o_orderdate")


@query(
    "upsert_keep_new",
    f"""SELECT * FROM ({_NEW}) UNION ALL SELECT * FROM ({_OLD}) o
        WHERE NOT EXISTS (SELECT 1 FROM ({_NEW}) n WHERE n.o_orderkey = o.o_orderkey)""",
)
def _upsert(lab: Lab):
    return _merged(lab, "new")


@query(
    "insert_keep_old",
    f"""SELECT * FROM ({_OLD}) UNION ALL SELECT * FROM ({_NEW}) n
        WHERE NOT EXISTS (SELECT 1 FROM ({_OLD}) o WHERE n.o_orderkey = o.o_orderkey)""",
)
def _insert(lab: Lab):
    return _merged(lab, "old")


# --- filters, copies, anonymizing -----------------------------------------------------------------


@query("flt_date_window", "SELECT * FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
def _window(lab: Lab):
    events = lab.table("events").withColumn("date", F.col("ts").cast("date"))
    return cleaning.date_window(events, "2024-01-05", "2024-01-20").drop("date")


@query(
    "flt_required",
    """SELECT order_no, flight_no, item_reference, damaged_waste_qty FROM fx_wastage
       WHERE item_category IS NOT NULL AND damaged_waste_qty IS NOT NULL""",
)
def _required(lab: Lab):
    df = cleaning.required(lab.tables.fixture("fx_wastage"), ["item_category", "damaged_waste_qty"])
    return df.select("order_no", "flight_no", "item_reference", "damaged_waste_qty")


@query("flt_nonneg", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0")
def _nonneg(lab: Lab):
    return cleaning.non_negative(lab.table("customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])


@query("dedup_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def _dedup(lab: Lab):
    columns = ["l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber"]
    return cleaning.distinct_rows(lab.table("lineitem").select(*columns))


@query(
    "dedup_subset",
    """SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM (
       SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey) AS rn
       FROM lineitem) WHERE rn = 1""",
)
def _dedup_subset(lab: Lab):
    df = lab.table("lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")
    order = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")]
    return cleaning.first_per_key(df, ["l_partkey"], order)


@query("anonymize_flight", "SELECT DISTINCT flight_no AS raw, 'AB' || substring(flight_no, 3) AS flight_no FROM fx_sales")
def _anonymize(lab: Lab):
    sales = lab.tables.fixture("fx_sales").select(F.col("flight_no").alias("raw"))
    return sales.select("raw", anonymize_flight(F.col("raw")).alias("flight_no")).distinct()


@query(
    "legacy_staging_variants",
    f"""SELECT * REPLACE ({double("price", "purchase_amount", "discount_amount")}) FROM stg_sales_any_date
        WHERE sold_quantity >= 0 AND date BETWEEN DATE '2026-01-01' AND DATE '2026-03-31'""",
)
def _legacy_window(lab: Lab):
    cfg = dataclasses.replace(lab.config, start_date="2026-01-01", end_date="2026-03-31")
    fx = lab.tables.fixture
    return plain(
        old.staged_sales(staging.stg_sales(fx("fx_sales"), fx("fx_cities"), fx("fx_currencies"), cfg))
    )


@query("legacy_staged_wastage", "SELECT * FROM leg_wastage")
def _legacy_wastage(lab: Lab):
    return old.staged_wastage(lab.wh.ref("stg_wastage"), lab.wh.ref("stg_schedule"))
