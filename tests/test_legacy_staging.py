import datetime

import pytest
from pyspark.sql import functions as F

from skygalley.functions import parse_dates, try_dates
from skygalley.plans import legacy_staging as old

BOTH = ("dd-MM-yyyy", "dd/MM/yy")


def _texts(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string")


def test_days_are_tried_in_order(spark):
    df = _texts(spark, "05-01-2026", "31/01/26", None, "2026-01-05", "31-02-2026", "5/1/26", "05/01/2026", "")
    got = [r["d"] for r in df.select(try_dates(F.col("t"), BOTH).alias("d")).collect()]
    assert got == [datetime.date(2026, 1, 5), datetime.date(2026, 1, 31)] + [None] * 6
    swapped = _texts(spark, "03/04/26").select(
        try_dates(F.col("t"), ("dd/MM/yy", "MM/dd/yy")).alias("a"), try_dates(F.col("t"), ("MM/dd/yy", "dd/MM/yy")).alias("b")
    )
    assert tuple(swapped.first()) == (datetime.date(2026, 4, 3), datetime.date(2026, 3, 4))


def test_a_day_that_nothing_fits_is_refused(spark):
    good = _texts(spark, "05-01-2026", None).select(parse_dates(F.col("t"), BOTH).alias("d"))
    assert [r["d"] for r in good.collect()] == [datetime.date(2026, 1, 5), None]
    bad = _texts(spark, "05-01-2026", "soon").select(parse_dates(F.col("t"), BOTH).alias("d"))
    with pytest.raises(Exception, match="no date by dd-MM-yyyy, dd/MM/yy: soon"):
        bad.collect()


@pytest.fixture
def cities(spark):
    return spark.createDataFrame([("AAA", "city_1")], "iata_code string, city_id string")


def test_refused_days_are_counted_before_a_load(spark, cities):
    columns = "flight_number string, scheduled_date string, scheduled_time string, origin string, destination string, class string, pax int"
    rows = [("XY1", d, "10:00", "AAA", "BBB", "Economy", n) for d, n in (("01/02/26", 5), ("2026-02-01", 5), (None, 5))]
    raw = spark.createDataFrame(rows, columns)
    counts = {r["pattern"]: r["n"] for r in old.count_dates(raw, "pax").collect()}
    assert counts == {"dd/MM/yy": 1, "none": 1, None: 1}
    with pytest.raises(Exception, match="2026-02-01"):
        old.pax(raw, cities).collect()
    both = old.OldStaging(formats={"pax": ("dd/MM/yy", "yyyy-MM-dd")})
    # the missing day goes, the other two rows are copies of each other once their days are read
    assert [tuple(r) for r in old.pax(raw, cities, both).collect()] == [
        ("AB1", datetime.date(2026, 2, 1), "10:00:00", "city_1", "UNKNOWN", "Economy", 5)
    ]


def test_window_holds_both_ends(spark, cities):
    columns = "flight_number string, scheduled_date string, scheduled_time string, origin string, destination string, class string, pax int"
    days = ("31/12/25", "01/01/26", "31/03/26", "01/04/26")
    rows = [("XY1", d, None, None, "AAA", None, n) for d in days for n in (0, -1, None)]
    got = old.pax(spark.createDataFrame(rows, columns), cities).collect()
    assert sorted(r["date"].isoformat() for r in got) == ["2026-01-01", "2026-03-31"]
    assert {(r["time"], r["origin"], r["destination"], r["pax_quantity"]) for r in got} == {(None, "UNKNOWN", "city_1", 0)}


def test_catalog_and_bank(spark):
    catalog = spark.createDataFrame(
        [("P1", None, "F", "Yes", None, -1.0), ("P1", None, "F", "yes", None, -1.0), ("P2", "A", "F", "maybe", "T", 0.0), ("P3", "A", None, "No", "T", 1.0)],
        "reference string, status string, family string, food string, type string, selling_price double",
    )
    got = sorted((r["item_id"], r["is_food"], r["price"]) for r in old.catalog(catalog).collect())
    assert got == [("P1", True, -1.0), ("P2", None, 0.0)]
    names = ("bin", "brand", "type", "category", "issuer", "alpha_3", "country")
    bank = spark.createDataFrame([(None,) * 7, (None,) * 7, ("4", *[None] * 6)], ", ".join(f"{n} string" for n in names))
    assert sorted(tuple(r) for r in old.bank(bank).collect()) == [("4",) + ("UNKNOWN",) * 6, ("UNKNOWN",) * 7]


def test_wastage_takes_the_first_time_of_the_day(spark, cities):
    lines = spark.createDataFrame(
        [("L1", "XY1", "AAA", "BBB", "05/01/26 12:00", 1), ("L2", "XY1", "AAA", "BBB", "2026-01-05 07:30", 2)],
        "line_id string, flight_no string, iata_departure string, iata_destination string, scheduled_datetime string, order_no long",
    )
    scheduled = old.schedule(lines, cities)
    assert sorted(r["time"] for r in scheduled.collect()) == ["07:30:00", "12:00:00"]
    raw = spark.createDataFrame(
        [(1, "XY1", "AAA-BBB", "05-01-2026", "C", "P1", "T", 3, 2, 0, 0), (1, "XY1", "AAA", "06/01/26", None, "P1", None, 3, 2, 0, 0), (1, "XY1", "AAA-BBB", "05-01-2026", "C", "P2", "T", 3, 2, None, 0)],
        "order_no long, flight_no string, scheduled_route string, scheduled_date string, item_category string, item_reference string, item_type string, ordered_qty int, sold_qty int, damaged_waste_qty int, qty_fresh_waste int",
    )
    got = {r["date"].day: (r["time"], r["origin"], r["destination"]) for r in old.wastage(raw, scheduled, cities).collect()}
    assert got == {5: ("07:30:00", "city_1", "UNKNOWN"), 6: (None, "city_1", "UNKNOWN")}
