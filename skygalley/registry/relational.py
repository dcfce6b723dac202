"""Joins, aggregates, windows, sorts and unions on their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from skygalley.functions import or_unknown, ratio
from skygalley.operators import joins, windows
from skygalley.operators.cleaning import first_per_key
from skygalley.plans import warehouse
from skygalley.plans.semantic import ROW_LIMIT, metric_query, metric_result
from skygalley.registry.base import Lab, plain, query
from skygalley.registry.oracle import city, double
from skygalley.registry.oracle import ratio as sql_ratio

# --- joins --------------------------------------------------------------------------------------


@query(
    "join_lookup_left",
    f"""SELECT ticket_id, item_reference, {city("raw.flight_origin")} AS origin,
        {city("raw.flight_destination")} AS destination FROM fx_sales raw""",
)
def _lookup(lab: Lab):
    sales, cities = lab.tables.fixture("fx_sales"), lab.tables.fixture("fx_cities")
    df = joins.with_lookup(sales, F.col("flight_origin"), cities, "iata_code", "city_id", "origin")
    df = joins.with_lookup(df, F.col("flight_destination"), cities, "iata_code", "city_id", "destination")
    return df.select("ticket_id", "item_reference", "origin", "destination")


@query(
    "join_inner_2key",
    """SELECT f.flight_no, f.date, f.source, count(*) AS sales_rows FROM stg_sales s
       JOIN int_flights f ON s.flight_no = f.flight_no AND s.date = f.date
       GROUP BY f.flight_no, f.date, f.source""",
)
def _inner(lab: Lab):
    # counted per flight first: a hot flight reaches the join as one row
    counts = lab.wh.ref("stg_sales").groupBy("flight_no", "date")
    counts = counts.agg(F.count(F.lit(1)).alias("sales_rows"))
    flights = lab.wh.ref("int_flights").select("flight_no", "date", "source")
    return counts.join(flights, ["flight_no", "date"]).select("flight_no", "date", "source", "sales_rows")


@query(
    "join_left_3key",
    """SELECT il.flight_no, il.date, il.load_id, il.item_id, coalesce(s.origin, 'UNKNOWN') AS origin,
       coalesce(s.destination, 'UNKNOWN') AS destination
       FROM stg_items_load il LEFT JOIN stg_schedule s
         ON il.flight_no = s.flight_no AND il.date = s.date AND il.load_id = s.load_id""",
)
def _left3(lab: Lab):
    keys = ["flight_no", "date", "load_id"]
    schedule = lab.wh.ref("stg_schedule").select(*keys, "origin", "destination")
    loads = lab.wh.ref("stg_items_load").select(*keys, "item_id")
    return loads.join(schedule, keys, "left").select(
        *keys,
        "item_id",
        or_unknown(F.col("origin")).alias("origin"),
        or_unknown(F.col("destination")).alias("destination"),
    )


@query(
    "join_star",
    """SELECT dd.year, dd.month, dt.day_period, dp.category, CAST(sum(fs.sold_quantity) AS BIGINT) AS sold_quantity
       FROM fact_sales fs JOIN dim_flights df ON df.flight_key = fs.flight_key
       JOIN dim_date dd ON dd.date_key = df.date JOIN dim_time dt ON dt.time_key = df.hour_of_departure
       JOIN dim_products dp ON dp.product_key = fs.product_key GROUP BY ALL""",
)
def _star(lab: Lab):
    ref = lab.wh.ref
    flights = ref("dim_flights").select("flight_key", F.col("date").alias("date_key"), "hour_of_departure")
    times = ref("dim_time").select(F.col("time_key").alias("hour_of_departure"), "day_period")
    return (
        ref("fact_sales")
        .join(flights, "flight_key")
        .join(ref("dim_date").select("date_key", "year", "month"), "date_key")
        .join(times, "hour_of_departure")
        .join(ref("dim_products").select("product_key", "category"), "product_key")
        .groupBy("year", "month", "day_period", "category")
        .agg(F.sum("sold_quantity").alias("sold_quantity"))
    )


@query(
    "join_filter_in_on",
    """SELECT dp.item_id, dp.category, fil.load_id, fil.flight_key, fil.total_loaded_quantity
       FROM fact_items_load fil JOIN dim_products dp ON dp.product_key = fil.product_key
        AND fil.potential_error IS NULL AND dp.item_type = 'Fresh Product' AND dp.category <> 'BOL Products'
        AND dp.status = 'Active'""",
)
def _on(lab: Lab):
    products = warehouse.fresh_products(lab.wh.ref("dim_products"))
    loads = lab.wh.ref("fact_items_load").where("potential_error is null")
    joined = loads.join(products.select("product_key", "item_id", "category"), "product_key")
    return joined.select("item_id", "category", "load_id", "flight_key", "total_loaded_quantity")


@query(
    "join_subquery_agg",
    """SELECT f.flight_key, f.flight_number, coalesce(s.sold, 0) AS sold_quantity FROM dim_flights f
       LEFT JOIN (SELECT flight_key, CAST(sum(sold_quantity) AS BIGINT) AS sold FROM fact_sales GROUP BY 1) s
         ON s.flight_key = f.flight_key""",
)
def _subquery(lab: Lab):
    sold = lab.wh.ref("fact_sales").groupBy("flight_key").agg(F.sum("sold_quantity").alias("sold"))
    flights = lab.wh.ref("dim_flights").select("flight_key", "flight_number")
    return flights.join(sold, "flight_key", "left").select(
        "flight_key", "flight_number", F.coalesce("sold", F.lit(0)).alias("sold_quantity")
    )


@query(
    "join_semi_fk",
    "SELECT * FROM fact_sales_keys WHERE flight_key IN (SELECT flight_key FROM bridge_flight_load)".replace(
        "fact_sales_keys", "(SELECT sale_transaction_key, flight_key, load_id FROM fact_sales)"
    ),
)
def _semi(lab: Lab):
    sales = lab.wh.ref("fact_sales").select("sale_transaction_key", "flight_key", "load_id")
    return sales.join(lab.wh.ref("bridge_flight_load"), "flight_key", "left_semi").select(*sales.columns)


@query(
    "join_anti",
    """SELECT flight_no, date, time, origin, destination FROM leg_seen_flights
       EXCEPT SELECT flight_no, date, time, origin, destination FROM stg_schedule""",
)
def _anti(lab: Lab):
    keys = ["flight_no", "date", "time", "origin", "destination"]
    ref = lab.wh.ref
    seen = ref("stg_sales").select(*keys).distinct()
    for other in ("stg_payments", "stg_pax"):
        seen = seen.unionByName(ref(other).select(*keys).distinct())
    first_times = [F.asc_nulls_last("time")]
    waste = ref("stg_wastage").select(*[k for k in keys if k != "time"]).distinct()
    waste = joins.fill_from_first(waste, ref("stg_schedule"), ["flight_no", "date"], "time", first_times)
    seen = seen.unionByName(waste.select(*keys)).distinct()
    return joins.only_in_left(seen, ref("stg_schedule"), keys)


@query(
    "join_not_in",
    "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')",
)
def _not_in(lab: Lab):
    returned = lab.table("lineitem").where("l_returnflag = 'R'")
    returned = returned.select(F.col("l_partkey").alias("p_partkey"))
    return joins.only_in_left(lab.table("part").select("p_partkey", "p_name"), returned, ["p_partkey"])


@query(
    "join_map_key",
    """SELECT x.slip_id, x.payment_type, c.card_sur_key AS card_key FROM stg_payments x
       LEFT JOIN leg_dim_card c ON x.card_number_prefix = c.card_number_prefix""",
)
def _map(lab: Lab):
    payments = lab.wh.ref("stg_payments").select("slip_id", "payment_type", "card_number_prefix")
    cards = lab.legacy.ref("dim_card")
    out = joins.map_key(payments, cards, "card_number_prefix", "card_sur_key", "card_key")
    return out.select("slip_id", "payment_type", "card_key")


@query(
    "join_time_from_schedule",
    """SELECT w.flight_no, w.date, w.load_id, w.item_id, w.load_quantity, s.time FROM stg_wastage w
       LEFT JOIN leg_schedule_time s ON w.flight_no = s.flight_no AND w.date = s.date""",
)
def _time(lab: Lab):
    columns = ["flight_no", "date", "load_id", "item_id", "load_quantity"]
    waste = lab.wh.ref("stg_wastage").select(*columns)
    order = [F.asc_nulls_last("time")]
    out = joins.fill_from_first(waste, lab.wh.ref("stg_schedule"), ["flight_no", "date"], "time", order)
    return out.select(*columns, "time")


@query(
    "join_cast_key",
    """SELECT n.n_nationkey, n.n_name, count(c.c_custkey) AS customers FROM nation n
       LEFT JOIN customer c ON CAST(n.n_nationkey AS VARCHAR) = CAST(c.c_nationkey AS VARCHAR)
       GROUP BY n.n_nationkey, n.n_name""",
)
def _cast(lab: Lab):
    customers = lab.table("customer").groupBy(F.col("c_nationkey").cast("string").alias("key"))
    customers = customers.agg(F.count("c_custkey").alias("customers"))
    nations = lab.table("nation").select("n_nationkey", "n_name")
    joined = nations.join(customers, nations["n_nationkey"].cast("string") == customers["key"], "left")
    return joined.select("n_nationkey", "n_name", F.coalesce("customers", F.lit(0)).alias("customers"))


@query(
    "join_bcast_mean",
    f"""SELECT l_orderkey, l_linenumber, l_quantity,
        {sql_ratio("sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_partkey)",
                   "count(*) OVER (PARTITION BY l_partkey)")} AS part_mean FROM lineitem""",
)
def _mean(lab: Lab):
    lines = lab.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    means = lines.groupBy("l_partkey").agg(
        ratio(F.sum(F.col("l_quantity").cast("bigint")), F.count(F.lit(1))).alias("part_mean")
    )
    return lines.join(means, "l_partkey").select("l_orderkey", "l_linenumber", "l_quantity", "part_mean")


# --- aggregates ---------------------------------------------------------------------------------


@query(
    "agg_sum_group",
    """SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def _sum(lab: Lab):
    return plain(
        lab.table("lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"),
        )
    )


@query("agg_two_level_avg", "SELECT * FROM avg_pax")
def _two_level(lab: Lab):
    pax = warehouse.pax_by_flight(lab.wh.ref("fact_pax"))
    flights = lab.wh.ref("dim_flights").select("flight_key", "flight_number")
    return (
        pax.join(flights, "flight_key")
        .groupBy("flight_number")
        .agg(F.avg("total_passengers").alias("avg_passengers"))
    )


@query(
    "agg_count_distinct",
    "SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY l_returnflag",
)
def _distinct(lab: Lab):
    return lab.table("lineitem").groupBy("l_returnflag").agg(F.countDistinct("l_orderkey").alias("orders"))


@query(
    "agg_cond_distinct",
    """SELECT l_linestatus, count(DISTINCT CASE WHEN l_discount > 0 THEN l_orderkey END) AS discounted
       FROM lineitem GROUP BY l_linestatus""",
)
def _cond_distinct(lab: Lab):
    discounted = F.when(F.col("l_discount") > 0, F.col("l_orderkey"))
    return lab.table("lineitem").groupBy("l_linestatus").agg(F.countDistinct(discounted).alias("discounted"))


@query(
    "agg_cond_max",
    """SELECT l_orderkey, max(CASE WHEN l_linenumber = 1 THEN l_partkey END) AS first_part
       FROM lineitem GROUP BY l_orderkey""",
)
def _cond_max(lab: Lab):
    first = F.when(F.col("l_linenumber") == 1, F.col("l_partkey"))
    return lab.table("lineitem").groupBy("l_orderkey").agg(F.max(first).alias("first_part"))


@query(
    "agg_ordered_array",
    "SELECT line_id, date, connected_flights AS flights FROM int_line_route",
)
def _ordered(lab: Lab):
    leg = F.struct(F.col("time").isNull().alias("late"), "time", "flight_no")
    days = lab.wh.ref("stg_line").groupBy("line_id", "date")
    legs = days.agg(F.array_sort(F.collect_list(leg)).alias("legs"))
    return legs.select(
        "line_id", "date", F.concat_ws(">", F.transform("legs", lambda x: x["flight_no"])).alias("flights")
    )


@query(
    "agg_ratio",
    f"""SELECT l_suppkey, {sql_ratio("sum(CAST(l_quantity AS BIGINT))", "count(DISTINCT l_orderkey)")} AS per_order
        FROM lineitem GROUP BY l_suppkey""",
)
def _ratio(lab: Lab):
    total = F.sum(F.col("l_quantity").cast("bigint"))
    return lab.table("lineitem").groupBy("l_suppkey").agg(
        ratio(total, F.countDistinct("l_orderkey")).alias("per_order")
    )


@query("agg_count_col", "SELECT scheduled_route, count(damaged_waste_qty) AS n FROM fx_wastage GROUP BY scheduled_route")
def _count(lab: Lab):
    return lab.tables.fixture("fx_wastage").groupBy("scheduled_route").agg(F.count("damaged_waste_qty").alias("n"))


@query(
    "agg_global",
    """SELECT CAST(sum(purchase_amount) AS DOUBLE) AS revenue, CAST(sum(sold_quantity) AS DOUBLE) AS sales_quantity
       FROM fact_sales""",
)
def _global(lab: Lab):
    return metric_query(lab.wh.ref, "sales", ["revenue", "sales_quantity"])


@query("agg_max_per_group", "SELECT flight_key, max(pax_quantity) AS largest FROM leg_fact_pax GROUP BY flight_key")
def _largest(lab: Lab):
    return lab.legacy.ref("fact_pax").groupBy("flight_key").agg(F.max("pax_quantity").alias("largest"))


# --- windows ------------------------------------------------------------------------------------


@query("win_best_source", "SELECT flight_no, date, source, time FROM int_flights")
def _best(lab: Lab):
    return lab.wh.model("int_flights").select("flight_no", "date", "source", "time")


@query("win_session_pref", "SELECT * FROM dim_sessions")
def _session(lab: Lab):
    """The row-number form of the session dimension; it must agree with the grouped one."""
    both = lab.wh.ref("stg_payments").select("session_id", "is_offline_mode").unionByName(
        lab.wh.ref("stg_sales").select("session_id"), allowMissingColumns=True
    )
    mode = F.col("is_offline_mode")
    order = F.when(mode, 1).when(~mode, 2).otherwise(3)
    return first_per_key(both.distinct(), ["session_id"], [order]).withColumnRenamed(
        "session_id", "sales_session_id"
    )


@query("win_line_seq", "SELECT line_id, flight_no, date, time, CAST(rn AS INTEGER) AS rn FROM line_ordered")
def _seq(lab: Lab):
    then = [F.asc_nulls_last("time"), "flight_no", "origin", "destination"]
    out = windows.with_sequence(lab.wh.ref("stg_line"), ["line_id"], "date", then, "rn")
    return out.select("line_id", "flight_no", "date", "time", "rn")


@query(
    "win_partition_max",
    "SELECT line_id, flight_no, date, max(load_id) OVER (PARTITION BY line_id) AS load_id FROM stg_schedule",
)
def _partition_max(lab: Lab):
    schedule = lab.wh.ref("stg_schedule").select("line_id", "flight_no", "date", "load_id")
    return windows.with_group_max(schedule, ["line_id"], "load_id", "load_id")


# --- sorts, limits, unions ------------------------------------------------------------------------


@query(
    "sort_multi",
    """SELECT category, is_food, CAST(sum(sold_quantity) AS DOUBLE) AS sold_quantity FROM fact_wastage fw
       JOIN dim_products dp ON dp.product_key = fw.product_key GROUP BY category, is_food
       ORDER BY is_food DESC NULLS FIRST, sold_quantity ASC NULLS LAST""",
)
def _sort(lab: Lab):
    order = {"is_food": "desc", "sold_quantity": "asc"}
    return metric_query(lab.wh.ref, "wastage", ["sold_quantity"], ["category", "is_food"], None, order)


@query(
    "topk",
    """SELECT item_id, CAST(sum(purchase_amount) AS DOUBLE) AS revenue FROM fact_sales fs
       JOIN dim_products dp ON dp.product_key = fs.product_key GROUP BY item_id
       ORDER BY revenue DESC NULLS FIRST, item_id LIMIT 25""",
)
def _topk(lab: Lab):
    order = {"revenue": "desc", "item_id": "asc"}
    return metric_query(lab.wh.ref, "sales", ["revenue"], ["item_id"], None, order, 25)


@query(
    "cap_truncate",
    f"""SELECT item_id, sales_quantity, n > {ROW_LIMIT} AS truncated FROM (
          SELECT item_id, CAST(sum(sold_quantity) AS DOUBLE) AS sales_quantity, count(*) OVER () AS n,
            row_number() OVER (ORDER BY sum(sold_quantity) DESC NULLS FIRST, item_id) AS place
          FROM fact_sales fs JOIN dim_products dp ON dp.product_key = fs.product_key GROUP BY item_id)
        WHERE place <= {ROW_LIMIT}""",
)
def _cap(lab: Lab):
    """The view of an answer without a limit: its first rows, numbers as doubles, and whether it has more."""
    order = {"sales_quantity": "desc", "item_id": "asc"}
    answer = metric_query(lab.wh.ref, "sales", ["sales_quantity"], ["item_id"], None, order)
    view = metric_result(answer)
    rows = [(r["item_id"], r["sales_quantity"], view["truncated"]) for r in view["rows"]]
    return lab.spark.createDataFrame(rows, "item_id string, sales_quantity double, truncated boolean")


@query("union_all", "SELECT source, count(*) AS n FROM flights_unioned GROUP BY source")
def _union(lab: Lab):
    ref, keys = lab.wh.ref, ["flight_no", "origin", "destination", "date", "time", "load_id"]
    parts = {
        "SCHEDULE": ref("stg_schedule"),
        "SALES": ref("stg_sales"),
        "PAYMENTS": ref("stg_payments"),
        "PAX": ref("stg_pax").withColumn("load_id", F.lit(None).cast("int")),
        "WASTAGE": ref("stg_wastage").withColumn("time", F.lit(None).cast("string")),
        "ITEMS_LOAD": ref("stg_items_load")
        .select("flight_no", "date", "time", "load_id")
        .distinct()
        .join(
            ref("stg_schedule").select("flight_no", "date", "load_id", "origin", "destination"),
            ["flight_no", "date", "load_id"],
            "left",
        )
        .withColumn("origin", or_unknown(F.col("origin")))
        .withColumn("destination", or_unknown(F.col("destination"))),
    }
    out = None
    for name, df in parts.items():
        part = df.select(*keys).distinct().withColumn("source", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query(
    "union_widen",
    f"""SELECT {double("price")}, item_id, item_category, item_type FROM (
        SELECT item_id, item_category, CAST(NULL AS VARCHAR) AS item_type, price FROM stg_sales
        UNION ALL SELECT item_id, item_category, item_type, NULL FROM stg_wastage)""",
)
def _widen(lab: Lab):
    sales = lab.wh.ref("stg_sales").select("item_id", "item_category", "price")
    waste = lab.wh.ref("stg_wastage").select("item_id", "item_category", "item_type")
    return plain(sales.unionByName(waste, allowMissingColumns=True))
