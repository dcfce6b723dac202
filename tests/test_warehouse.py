"""Edge cases that the generated tables do not hold."""

import datetime

import pytest
from pyspark.sql import functions as F

from skygalley.config import WarehouseConfig
from skygalley.operators import cleaning, joins, quality, windows
from skygalley.plans import staging, warehouse

DAY = datetime.date(2025, 11, 2)
FLIGHTS = "flight_no string, origin string, destination string, date date, time string, load_id int"


def flights(spark, rows):
    return spark.createDataFrame(rows, FLIGHTS)


def best(spark, **sources):
    empty = flights(spark, [])
    given = {n: flights(spark, sources.get(n, [])) for n in ("schedule", "wastage", "sales", "payments", "pax")}
    return warehouse.int_flights(items_load=empty, **given).collect()


def test_schedule_beats_better_known_sources(spark):
    got = best(
        spark,
        schedule=[("AB1", "UNKNOWN", "UNKNOWN", DAY, None, None)],
        sales=[("AB1", "city_1", "city_2", DAY, "10:00:00", 1)],
    )
    assert [(r.source, r.time) for r in got] == [("SCHEDULE", None)]


def test_known_cities_then_time_then_source(spark):
    got = best(
        spark,
        sales=[("AB1", "UNKNOWN", "city_2", DAY, "10:00:00", 1)],
        wastage=[("AB1", "city_1", "city_2", DAY, None, 1)],
        payments=[("AB1", "city_1", "city_3", DAY, "11:00:00", 1)],
    )
    assert [(r.source, r.destination) for r in got] == [("PAYMENTS", "city_3")]


def test_one_row_per_number_and_day(spark):
    other = DAY + datetime.timedelta(days=1)
    rows = [("AB1", "a", "b", d, t, 1) for d in (DAY, other) for t in ("09:00:00", "08:00:00")]
    got = sorted((r.date, r.time) for r in best(spark, sales=rows))
    assert got == [(DAY, "08:00:00"), (other, "08:00:00")]


def schedule(spark, rows):
    return spark.createDataFrame(rows, "line_id string, " + FLIGHTS)


def test_two_ways_to_spread_a_load(spark):
    rows = [
        ("L1", "AB1", "a", "b", DAY, "08:00:00", 7),
        ("L1", "AB2", "b", "a", DAY, "12:00:00", None),
        ("L2", "AB3", "a", "b", DAY, "08:00:00", None),
    ]
    df = schedule(spark, rows)
    loaded = warehouse.int_flight_load(df).collect()
    assert [(r.flight_number, r.load_id) for r in loaded] == [("AB1", 7)]
    dim = warehouse.dim_flights(
        df.drop("line_id").withColumn("source", F.lit("SCHEDULE")).withColumn("rn", F.lit(1))
    )
    bridge = warehouse.bridge_flight_load(df, dim)
    keys = {r.flight_key: r.flight_number for r in dim.collect()}
    assert sorted(keys[r.flight_key] for r in bridge.collect()) == ["AB1", "AB2"]


def test_line_route_of_three_stops(spark):
    rows = [
        ("L1", "AB2", "b", "c", DAY, "12:00:00", None),
        ("L1", "AB1", "a", "b", DAY, "08:00:00", 7),
        ("L2", "AB3", "a", "b", DAY, None, 9),
    ]
    got = {r.line_id: r for r in warehouse.int_line_route(schedule(spark, rows)).collect()}
    assert got["L1"].connected_flights == ["AB1", "AB2"]
    assert got["L1"].route == ["a", "b", "c"] and got["L1"].potential_error is None
    assert got["L2"].potential_error == "potentially_incorrect_route"


def test_line_route_start_only_on_first_day(spark):
    """The origin belongs to the line's first flight: a later day starts with a missing stop."""
    later = DAY + datetime.timedelta(days=1)
    rows = [("L1", "AB1", "a", "b", DAY, "08:00:00", 7), ("L1", "AB2", "b", "a", later, "08:00:00", 7)]
    got = {r.date: r.route for r in warehouse.int_line_route(schedule(spark, rows)).collect()}
    assert got == {DAY: ["a", "b"], later: [None, "a"]}


def test_session_mode(spark):
    payments = spark.createDataFrame(
        [("s1", True), ("s1", False), ("s2", False)], "session_id string, is_offline_mode boolean"
    )
    sales = spark.createDataFrame([("s2",), ("s3",)], "session_id string")
    got = {r.sales_session_id: r.is_offline_mode for r in warehouse.dim_sessions(payments, sales).collect()}
    assert got == {"s1": True, "s2": False, "s3": None}


def test_line_time_only_after_a_blank(spark):
    raw = spark.createDataFrame(
        [
            ("L1", "XY1", "X", "Y", "2025-11-02 08:15", 1),
            ("L1", "XY2", "X", "Y", "2025-11-02T08:15:00", 1),
            ("L1", "XY3", "X", "Y", "2025-10-31 08:15", 1),
        ],
        "line_id string, flight_no string, iata_departure string, iata_destination string,"
        " scheduled_datetime_utc string, order_no int",
    )
    cities = spark.createDataFrame([("X", "city_1")], "iata_code string, city_id string")
    got = staging.stg_line(raw, cities, WarehouseConfig()).orderBy("flight_no").collect()
    assert [(r.flight_no, r.time, r.origin, r.destination) for r in got] == [
        ("AB1", "08:15:00", "city_1", "UNKNOWN"),
        ("AB2", None, "city_1", "UNKNOWN"),
    ]


def test_pax_sales_counts_per_class_unless_corrected(spark):
    sales = spark.createDataFrame(
        [("f", "s1", 2, 10), ("f", "s1", 1, 5), ("f", "s2", 1, 7)],
        "flight_key string, slip_id string, sold_quantity int, purchase_amount int",
    )
    pax = spark.createDataFrame([("f", 90), ("f", 10)], "flight_key string, number_of_passengers int")
    dim = spark.createDataFrame(
        [("f", "AB1", "a", "b", 20251102, 8)],
        "flight_key string, flight_number string, origin string, destination string, date int,"
        " hour_of_departure int",
    )
    times = warehouse.dim_time(warehouse.int_hours(spark))
    dates = warehouse.dim_date(spark, WarehouseConfig(calendar_end="2026-01-01"))
    for per_flight, factor in ((False, 2), (True, 1)):
        row = warehouse.mart_pax_sales(sales, pax, dim, times, dates, per_flight).first()
        assert row.passenger_count == 100 and row.route == "a _ b"
        assert row.number_of_tickets == 2 * factor
        assert row.sold_quantity == 4 * factor and row.purchase_amount == 22 * factor


# --- generic operators ----------------------------------------------------------------------------


def test_loads_meet_sales_without_what_describes_the_flight(spark):
    """Bridge rows of one flight under two loads, a flight without sales, an item sold on another flight; keys alone are shuffled."""
    make = spark.createDataFrame
    bridge = make([("l", "f1", 1), ("l", "f1", 2), ("l", "f2", 1), ("l", "f9", 1)], "line_id string, flight_key string, load_id int")
    dim = make(
        [(f, n, "A", "B", 20251102, 9) for f, n in (("f1", "AB1"), ("f2", "AB2"))],
        "flight_key string, flight_number string, origin string, destination string, date int, hour_of_departure int",
    )
    dates = make([(20251102, DAY, "November", 2025, "Sunday", True)], "date_key int, date date, month_name string, year int, weekday_name string, is_weekend boolean")
    times = make([(9, "morning", False, "AM")], "time_key int, day_period string, is_night boolean, am_pm string")
    loads = make([(1, "p1", None), (2, "p1", None), (1, "p2", "zero_load_error"), (3, "p1", None)], "load_id int, product_key string, potential_error string")
    products = make([("p1", "i1", "Fresh Product", "Meals", "Active", 5.0), ("p2", "i2", "Fresh Product", "Meals", "Active", 5.0)], "product_key string, item_id string, item_type string, category string, status string, price double")
    pax = make([("f1", 10), ("f1", 20)], "flight_key string, number_of_passengers int")
    sales = make([("f1", "p1", 3), ("f1", "p1", 4), ("f9", "p1", 5)], "flight_key string, product_key string, sold_quantity int")
    out = warehouse.mart_fresh_food_order_sale(bridge, dim, dates, times, loads, products, pax, sales)
    got = sorted((r.flight_key, r.item_id, r.sold_quantity, r.number_of_passengers, r.potential_error) for r in out.collect())
    assert got == [("f1", "i1", 7, 30.0, None), ("f1", "i1", 7, 30.0, None), ("f2", "i1", 0, None, "no_pax_data")]
    # the join with the sales has nothing of the calendar below it
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "Join LeftOuter" in line and "product_key" in line)
    depth = lines[at].index("Join")
    ends = (i for i in range(at + 1, len(lines)) if len(lines[i]) - len(lines[i].lstrip(" :+-")) <= depth)
    inner = lines[at + 1 : next(ends, len(lines))]
    assert inner and not any("weekday_name" in line for line in inner)


def test_anti_join_matches_missing_to_missing(spark):
    left = spark.createDataFrame([("a", None), ("b", None), ("a", "x")], "k string, t string")
    right = spark.createDataFrame([("a", None)], "k string, t string")
    got = joins.only_in_left(left, right, ["k", "t"]).collect()
    assert sorted((r.k, r.t) for r in got) == [("a", "x"), ("b", None)]


def test_sequence_matches_one_window(spark):
    """Against brute force, with one group that holds most rows."""
    rows = [("hot", d, i) for d in range(6) for i in range(40)] + [("cold", 3, 1)]
    df = spark.createDataFrame(rows, "g string, d int, i int")
    got = {(r.g, r.d, r.i): r.rn for r in windows.with_sequence(df, ["g"], "d", ["i"], "rn").collect()}
    want = {}
    for g in ("hot", "cold"):
        for n, (d, i) in enumerate(sorted((d, i) for gg, d, i in rows if gg == g), start=1):
            want[(g, d, i)] = n
    assert got == want


def test_group_max_keeps_rows_of_missing_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 5), ("b", None)], "g string, v int")
    got = windows.with_group_max(df, ["g"], "v", "top").collect()
    assert sorted((str(r.g), str(r.v), str(r.top)) for r in got) == [
        ("None", "5", "5"),
        ("a", "1", "1"),
        ("a", "None", "1"),
        ("b", "None", "None"),
    ]


def test_first_per_key_cuts_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, v int")
    out = cleaning.first_per_key(df, ["k"], [F.col("v")])
    assert sorted(tuple(r) for r in out.collect()) == [("a", 1), ("b", 3)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_empty_columns_and_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, None)], "a int, b int, c string")
    kept = cleaning.drop_empty_rows(cleaning.drop_empty_columns(df))
    assert kept.columns == ["a", "c"] and kept.count() == 1


def test_unknown_expression_passes(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    rules = [
        quality.Expression("t", "x >= 0"),
        quality.NotNull("t", "x"),
        quality.Unique("t", ("x",)),
        quality.Accepted("t", "x", (1, 2)),
        quality.NotNull("t", "x", "x > 5"),
        quality.Relationship("t", "x", "p", "x"),
    ]
    parents = {"t": df, "p": spark.createDataFrame([(1,)], "x int")}
    got = quality.check_rules(parents.__getitem__, rules).collect()
    assert sorted((r.rule, r.failures) for r in got) == [
        ("accepted_values", 1),
        ("expression", 1),
        ("not_null", 0),
        ("not_null", 1),
        ("relationship", 1),
        ("unique", 0),
    ]


@pytest.mark.parametrize("columns", [("a",), ("a", "b")])
def test_unique_counts_missing_parts_only_in_combinations(spark, columns):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1)], "a int, b int")
    got = quality.check_rules(lambda _: df, [quality.Unique("t", columns)]).first()
    assert got.failures == (0 if len(columns) == 1 else 1)


def _tables(spark, folder):
    """Orders with lines of fresh and other items; copies of lines and orders, missing keys."""
    orders = [(k, k % 5, "OFP"[k % 3], 10.5 + k, ("1-URGENT", "5-LOW")[k % 2]) for k in range(60)] + [(3, 3, "O", 13.5, "5-LOW"), (None, 1, "O", 1.0, None)]
    lines = [
        (k, None if k == 7 else (k + n) % 6, n, 3.0 + n, 9.25 * n, 0.01 * (n % 2), "NR"[k % 2], "OF"[n % 2]) for k in [*range(60), 999] for n in (1, 2, 7)
    ]
    lines += lines[:9] + [(None, 1, 1, 1.0, 1.0, 0.0, "N", "O")]
    parts = [(p, ("Brand#1", "Brand#12")[p == 2], ("STEEL", "PROMO")[p == 3], 5 if p == 4 else 1, 2.5) for p in range(6)] + [(0, "Brand#1", "STEEL", 1, 2.5)]
    for name, rows, schema in (
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"),
        ("lineitem", lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string"),
        ("part", parts, "p_partkey long, p_brand string, p_type string, p_size int, p_retailprice double"),
        ("nation", [(n, f"NATION_{n}", 0) for n in range(25)], "n_nationkey int, n_name string, n_regionkey int"),
        ("region", [(0, "R")], "r_regionkey int, r_name string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_mart_and_facts_write_no_wide_rows(spark, tmp_path):
    """The mart takes the facts of fresh items alone, facts and flights take staging unwritten: same rows as from stored tables."""
    from skygalley.plans.warehouse import STORED_INTERMEDIATE, Warehouse
    from skygalley.sources.driver_tables import DriverTables

    _tables(spark, str(tmp_path / "in"))

    def made(name):
        root = tmp_path / name
        return Warehouse(spark, DriverTables(spark, str(tmp_path / "in"), f"{root}/raw").raw(), root=f"{root}/wh"), root / "wh"

    rows = lambda wh, name: sorted(map(str, wh.ref(name).collect()))
    stored, _ = made("stored")
    for name in (*STORED_INTERMEDIATE, "fact_sales", "fact_items_load"):
        stored.ref(name)
    staged, _ = made("staged")
    for name in STORED_INTERMEDIATE:
        staged.ref(name)
    lean, folder = made("lean")
    mart = rows(lean, "mart_fresh_food_order_sale")
    assert mart == rows(stored, "mart_fresh_food_order_sale") == rows(staged, "mart_fresh_food_order_sale")
    assert len(mart) > 20 and any("sold_quantity=0" not in r for r in mart)
    wide = [f"{t}_{d}" for t, d in (("stg", "sales"), ("stg", "items_load"), ("stg", "payments"), ("stg", "wastage"), ("fact", "sales"), ("fact", "items_load"))]
    assert not [name for name in wide if (folder / name).exists()]
    assert not any((tmp_path / f"lean/raw/raw/{name}").exists() for name in ("wastage", "payments", "sales", "items_load"))
    for name in ("fact_sales", "fact_items_load", "fact_payments", "fact_wastage", "int_flights", "dim_sessions", "dim_card"):
        assert rows(lean, name) == rows(stored, name), name
    assert not [name for name in wide[:4] if (folder / name).exists()]


def test_fact_and_distinct_share_a_shuffle(spark, tmp_path):
    """Without a stored staging table, sales and loads are dealt once by what they are summed by."""
    from skygalley.plans import warehouse as w
    from skygalley.sources.driver_tables import DriverTables

    _tables(spark, str(tmp_path / "in"))
    wh = w.Warehouse(spark, DriverTables(spark, str(tmp_path / "in"), str(tmp_path / "raw")).raw(), root=str(tmp_path / "wh"))
    for name, staged, keys in (("fact_sales", "stg_sales", w.SALE), ("fact_items_load", "stg_items_load", w.LOAD)):
        dealt, plain = wh.seen(staged, keys), wh.seen(staged)
        assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect())) and plain.count() > 20
        shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        assert (shuffles(dealt.groupBy(*keys).count()), shuffles(plain.groupBy(*keys).count())) == (1, 2), name


def test_combinations_are_told_apart_by_short_keys(spark):
    """Parts that read alike when joined, missing and empty ones are different keys; their md5 is what is shuffled."""
    rows = [("a", "bc", 1), ("ab", "c", 1), ("a:1", "b", 1), ("a", "1:b", 1), (None, "", 1), ("", None, 1), ("-", "", 1), ("1", "2", 11)]
    df = spark.createDataFrame([*rows, ("1", "2", 11), (None, "", 1)], "a string, b string, c int")
    got = quality.check_rules(lambda _: df, [quality.Unique("t", ("a", "b", "c"))])
    assert got.first().failures == 2
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in plan
    halves = spark.createDataFrame([(0.0, "x"), (-0.0, "x")], "a double, b string")  # equal, though their texts differ
    assert quality.check_rules(lambda _: halves, [quality.Unique("t", ("a", "b"))]).first().failures == 1


def test_combinations_are_checked_without_writing_facts(spark, tmp_path):
    from skygalley.registry import queries
    from skygalley.registry.base import lab as get

    _tables(spark, str(tmp_path))
    got = queries()["dq_unique_combo"](spark, str(tmp_path)).collect()
    wh = get(spark, str(tmp_path)).wh
    assert len(got) == 9 and not {"fact_sales", "fact_items_load", "mart_fresh_food_order_sale"} & set(wh._refs)
    failures = {r.table_name: r.failures for r in got}
    sales = wh.ref("fact_sales").groupBy("slip_id", "product_key", "sales_type").count().where("count > 1").count()
    assert failures["fact_sales"] == sales
