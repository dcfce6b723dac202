"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from skygalley import functions as fn
from skygalley.registry.base import Lab, query
from skygalley.registry.oracle import date_key, hour, pipe, rint, sk


@query("fn_concat", "SELECT n_nationkey, n_name || ' _ ' || nullif(r_name, 'ASIA') AS label FROM nation JOIN region ON n_regionkey = r_regionkey")
def _concat(lab: Lab):
    nation = lab.table("nation").join(lab.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    region = fn.null_if(F.col("r_name"), "ASIA")
    return nation.select(
        "n_nationkey", fn.concat_text(F.col("n_name"), F.lit(" _ "), region).alias("label")
    )


@query("fn_substring", "SELECT c_custkey, substring(c_name, 10) AS tail, substring(c_name, 1, 6) AS head FROM customer")
def _substring(lab: Lab):
    return lab.table("customer").select(
        "c_custkey",
        F.substr("c_name", F.lit(10)).alias("tail"),
        F.substring("c_name", 1, 6).alias("head"),
    )


@query(
    "fn_split_part",
    """SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS first, split_part(o_orderpriority, '-', 2) AS second,
       split_part(o_orderpriority, '-', 3) AS third FROM orders""",
)
def _split(lab: Lab):
    part = lambda i: F.split_part("o_orderpriority", F.lit("-"), F.lit(i))
    return lab.table("orders").select(
        "o_orderkey", part(1).alias("first"), part(2).alias("second"), part(3).alias("third")
    )


@query("fn_coalesce", "SELECT ticket_id, item_reference, coalesce(item_category, 'UNKNOWN') AS item_category FROM fx_sales")
def _coalesce(lab: Lab):
    return lab.tables.fixture("fx_sales").select(
        "ticket_id", "item_reference", fn.or_unknown(F.col("item_category")).alias("item_category")
    )


@query("fn_nullif", "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders")
def _nullif(lab: Lab):
    return lab.table("orders").select(
        "o_orderkey", fn.null_if(F.col("o_orderstatus"), "P").alias("status")
    )


@query(
    "fn_to_date",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS slashes, CAST(o_orderdate AS DATE) AS iso,
       CASE WHEN year(o_orderdate) >= 2000 THEN CAST(o_orderdate AS DATE)
            ELSE CAST(o_orderdate + INTERVAL 100 YEAR AS DATE) END AS short FROM orders""",
)
def _to_date(lab: Lab):
    day = F.col("o_orderdate")
    texts = lab.table("orders").select(
        "o_orderkey",
        F.date_format(day, "yyyy/MM/dd HH:mm").alias("slashes"),
        F.date_format(day, "yyyy-MM-dd HH:mm").alias("iso"),
        F.date_format(day, "dd/MM/yy").alias("short"),
    )
    return texts.select(
        "o_orderkey",
        fn.date_from_slashes(F.col("slashes")).alias("slashes"),
        fn.date_from_iso(F.col("iso")).alias("iso"),
        fn.date_from_short(F.col("short")).alias("short"),
    )


@query("fn_to_time", "SELECT event_id, strftime(ts, '%H:%M:%S') AS full_time, strftime(ts, '%H:%M') || ':00' AS short_time FROM events")
def _to_time(lab: Lab):
    texts = lab.table("events").select(
        "event_id",
        F.date_format("ts", "H:mm:ss").alias("full_text"),
        F.date_format("ts", "HH:mm").alias("short_text"),
    )
    return texts.select(
        "event_id",
        fn.to_time(F.col("full_text")).alias("full_time"),
        fn.to_time(F.col("short_text")).alias("short_time"),
    )


@query("fn_date_to_key", f"SELECT o_orderkey, {date_key('o_orderdate')} AS date_key FROM orders")
def _key(lab: Lab):
    return lab.table("orders").select("o_orderkey", fn.date_to_key(F.col("o_orderdate")).alias("date_key"))


@query(
    "fn_date_parts",
    """SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day,
       quarter(o_orderdate) AS quarter FROM orders""",
)
def _parts(lab: Lab):
    day = F.col("o_orderdate")
    return lab.table("orders").select(
        "o_orderkey",
        fn.year_from_date(day).alias("year"),
        fn.month_from_date(day).alias("month"),
        fn.day_from_date(day).alias("day"),
        fn.quarter_from_date(day).alias("quarter"),
    )


@query(
    "fn_isodow",
    "SELECT o_orderkey, isodow(o_orderdate) AS week_day, isodow(o_orderdate) >= 6 AS is_weekend FROM orders",
)
def _dow(lab: Lab):
    day = F.col("o_orderdate")
    return lab.table("orders").select(
        "o_orderkey", fn.day_of_week(day).alias("week_day"), fn.is_weekend(day).alias("is_weekend")
    )


@query("fn_is_weekend", "SELECT event_id, isodow(ts) IN (6, 7) AS is_weekend FROM events")
def _weekend(lab: Lab):
    return lab.table("events").select("event_id", fn.is_weekend(F.col("ts")).alias("is_weekend"))


@query(
    "fn_season",
    """SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter'
       WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Spring' WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Summer'
       ELSE 'Autumn' END AS season FROM orders""",
)
def _season(lab: Lab):
    month = fn.month_from_date(F.col("o_orderdate"))
    return lab.table("orders").select("o_orderkey", fn.season_from_month(month).alias("season"))


@query(
    "fn_month_day_names",
    """SELECT o_orderkey, strftime(o_orderdate, '%B') AS month_name, strftime(o_orderdate, '%A') AS weekday_name,
       rpad(strftime(o_orderdate, '%B'), 9, ' ') AS padded_month,
       rpad(strftime(o_orderdate, '%A'), 9, ' ') AS padded_weekday FROM orders""",
)
def _names(lab: Lab):
    day = F.col("o_orderdate")
    return lab.table("orders").select(
        "o_orderkey",
        fn.month_name(day).alias("month_name"),
        fn.weekday_name(day).alias("weekday_name"),
        fn.month_name(day, padded=True).alias("padded_month"),
        fn.weekday_name(day, padded=True).alias("padded_weekday"),
    )


@query("fn_round_hour", f"SELECT event_id, {hour('(strftime(ts, chr(37) || chr(72) || chr(58) || chr(37) || chr(77)))')} AS hour FROM events")
def _hour(lab: Lab):
    text = F.date_format("ts", "HH:mm:ss")
    return lab.table("events").select("event_id", fn.round_hour_from_time(text).alias("hour"))


@query("fn_surrogate_key", f"SELECT o_orderkey, {sk('o_custkey', chr(39) + 'x' + chr(39), 'nullif(o_orderstatus, ' + chr(39) + 'P' + chr(39) + ')')} AS key FROM orders")
def _sk(lab: Lab):
    status = fn.null_if(F.col("o_orderstatus"), "P")
    return lab.table("orders").select(
        "o_orderkey", fn.surrogate_key("o_custkey", F.lit("x"), status).alias("key")
    )


@query("key_pipe_md5", f"SELECT ticket_id, item_reference, {pipe('ticket_id', 'item_category', 'qty_sold')} AS key FROM fx_sales")
def _pipe(lab: Lab):
    return lab.tables.fixture("fx_sales").select(
        "ticket_id", "item_reference", fn.pipe_md5("ticket_id", "item_category", "qty_sold").alias("key")
    )


@query(
    "fn_cardinality",
    """SELECT o_orderkey, len(string_split(o_orderpriority, '-')) AS parts,
       array_to_string(list_concat([o_orderstatus], string_split(o_orderpriority, '-')), '+') AS joined,
       len(list_concat([o_orderstatus], string_split(o_orderpriority, '-'))) AS joined_parts FROM orders""",
)
def _arrays(lab: Lab):
    parts = F.split("o_orderpriority", "-")
    joined = F.concat(F.array("o_orderstatus"), parts)
    return lab.table("orders").select(
        "o_orderkey",
        F.size(parts).alias("parts"),
        F.concat_ws("+", joined).alias("joined"),
        F.size(joined).alias("joined_parts"),
    )


@query(
    "fn_round_clip",
    f"""SELECT c_custkey, {rint("c_acctbal / 8", 2)} AS cents, CAST(greatest({rint("c_acctbal / 1000")}, 0) AS INTEGER) AS clipped
        FROM customer""",
)
def _round(lab: Lab):
    return lab.table("customer").select(
        "c_custkey",
        fn.half_even(F.col("c_acctbal") / 8, 2).alias("cents"),
        fn.non_negative_int(F.col("c_acctbal") / 1000).alias("clipped"),
    )


@query(
    "fn_floor_threshold",
    """SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity / 8) + CASE WHEN l_quantity / 8 - floor(l_quantity / 8) >= 0.5
       THEN 1 ELSE 0 END AS INTEGER) AS half, CAST(floor(l_quantity / 8) + CASE WHEN
       l_quantity / 8 - floor(l_quantity / 8) >= 0.75 THEN 1 ELSE 0 END AS INTEGER) AS late FROM lineitem""",
)
def _floor(lab: Lab):
    raw = F.col("l_quantity") / 8
    return lab.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fn.floor_threshold(raw, 0.5).alias("half"),
        fn.floor_threshold(raw, 0.75).alias("late"),
    )


@query("fn_like", "SELECT count(*) FILTER (origin LIKE 'city%') AS known, count(*) FILTER (flight_no LIKE 'AB%') AS masked, count(*) AS n FROM stg_sales")
def _like(lab: Lab):
    return lab.wh.ref("stg_sales").agg(
        F.count(F.when(F.col("origin").like("city%"), 1)).alias("known"),
        F.count(F.when(F.col("flight_no").like("AB%"), 1)).alias("masked"),
        F.count(F.lit(1)).alias("n"),
    )


_Q = "CAST(l_quantity AS INTEGER) * 4"


@query(
    "fn_bucket",
    f"""SELECT l_orderkey, l_linenumber,
        CASE WHEN {_Q} < 0 THEN NULL WHEN {_Q} <= 100 THEN '<100' WHEN {_Q} <= 150 THEN '100 - 150'
             WHEN {_Q} <= 180 THEN '150 - 180' END AS trained,
        CASE WHEN {_Q} < 100 THEN '<100' WHEN {_Q} < 150 THEN '100 - 150' WHEN {_Q} < 180 THEN '150 - 180'
             WHEN {_Q} IS NOT NULL THEN '180 +' END AS served FROM lineitem""",
)
def _bucket(lab: Lab):
    q = F.col("l_quantity").cast("int") * 4
    cfg = lab.forecast
    return lab.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fn.bucket(q, cfg.pax_edges[:-1], cfg.pax_labels[:-1], include_lowest=True).alias("trained"),
        fn.bucket(q, cfg.pax_edges, cfg.pax_labels, left_closed=True).alias("served"),
    )


@query("fn_year_week", "SELECT event_id, CAST(date_trunc('week', ts) AS DATE) AS week FROM events")
def _week(lab: Lab):
    return lab.table("events").select("event_id", fn.week_start(F.col("ts")).alias("week"))
