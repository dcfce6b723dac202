"""Flights, dimensions, bridge, facts and marts.

Shuffle plan for the facts: rows are summed by natural key *before* they meet the flights (a flight
has one row per number and day, so the join adds columns and never rows). The sum is combined inside
each task first, or (sales and loads) made where the distinct rows are; the join then ends the plan, so Spark is free to broadcast the flights or to split
a hot flight, and the md5 keys are computed on the reduced rows only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skygalley import functions as fn
from skygalley.config import UNKNOWN, WarehouseConfig
from skygalley.operators.cleaning import first_per_key
from skygalley.plans import staging
from skygalley.sources.sinks import overwrite, overwrite_by_month

FLIGHT = ["flight_no", "date"]
# What a fact is summed by.
SALE = ["slip_id", "item_id", "sales_type", *FLIGHT, "session_id", "load_id", "currency"]
LOAD = [*FLIGHT, "load_id", "item_id"]


# --- intermediate -------------------------------------------------------------------------------


def int_hours(spark: SparkSession) -> DataFrame:
    return spark.range(24).select(F.col("id").cast("int").alias("hour"))


def int_flights(
    schedule: DataFrame,
    items_load: DataFrame,
    wastage: DataFrame,
    sales: DataFrame,
    payments: DataFrame,
    pax: DataFrame,
) -> DataFrame:
    """The best record of each flight number and day over the six sources.

    Each source shrinks to its distinct flights before the union, so the ranking never sees fact
    rows. The load id ends the order to make the choice repeatable.
    """
    loads = (
        items_load.select(*FLIGHT, "time", "load_id")
        .distinct()
        .join(
            schedule.select(*FLIGHT, "load_id", "origin", "destination").distinct(),
            [*FLIGHT, "load_id"],
            "left",
        )
        .withColumn("origin", fn.or_unknown(F.col("origin")))
        .withColumn("destination", fn.or_unknown(F.col("destination")))
    )
    sources = {
        "SCHEDULE": schedule,
        "ITEMS_LOAD": loads,
        "WASTAGE": wastage.withColumn("time", F.lit(None).cast("string")),
        "SALES": sales,
        "PAYMENTS": payments,
        "PAX": pax.withColumn("load_id", F.lit(None).cast("bigint")),
    }
    flights = None
    for name, df in sources.items():
        seen = df.select(
            "flight_no", "origin", "destination", "date", "time", F.col("load_id").cast("bigint")
        ).distinct()
        seen = seen.withColumn("source", F.lit(name))
        flights = seen if flights is None else flights.unionByName(seen)
    known = (F.col("origin") != UNKNOWN) & (F.col("destination") != UNKNOWN)
    best = first_per_key(
        flights,
        FLIGHT,
        [
            F.when(F.col("source") == "SCHEDULE", 1).when(known, 2).otherwise(3),
            F.col("time").isNull(),
            F.col("source"),
            F.asc_nulls_last("time"),
            F.col("origin"),
            F.col("destination"),
            F.asc_nulls_last("load_id"),
        ],
    )
    return best.withColumn("rn", F.lit(1))


def int_flight_load(schedule: DataFrame) -> DataFrame:
    """Flights that carry a load id themselves, with the highest load id of their line.

    The maximum per line is an aggregate joined back, not a window: it is combined inside each task.
    """
    loaded = schedule.where(F.col("load_id").isNotNull())
    top = loaded.groupBy("line_id").agg(F.max("load_id").alias("load_id"))
    flights = loaded.select(
        "line_id", F.col("flight_no").alias("flight_number"), "origin", "destination", "date", "time"
    ).distinct()
    return flights.join(top, "line_id").select(*flights.columns, "load_id")


def int_line_route(line: DataFrame) -> DataFrame:
    """Per line and day: its flights in order and the cities they connect."""
    # nulls last: the flag leads inside the sorted structs; the names settle equal times
    leg = F.struct(
        F.col("time").isNull().alias("no_time"), "time", "flight_no", "origin", "destination"
    )
    # the first leg of the whole line, not of the day, opens the route
    first_leg = F.struct("date", *[leg[c].alias(c) for c in ("no_time", "time", "flight_no", "origin", "destination")])
    days = line.groupBy("line_id", "date").agg(
        F.max("load_id").alias("load_id"),
        F.array_sort(F.collect_list(leg)).alias("legs"),
        F.min(first_leg).alias("first_leg"),
    )
    line_start = F.min("first_leg").over(Window.partitionBy("line_id"))
    days = days.withColumn("opens_line", F.col("first_leg") == line_start)
    flights = F.transform("legs", lambda x: x["flight_no"])
    start = F.when(F.col("opens_line"), F.col("legs")[0]["origin"])
    routes = days.select(
        "line_id",
        "date",
        "load_id",
        flights.alias("connected_flights"),
        F.concat(F.array(start), F.transform("legs", lambda x: x["destination"])).alias("route"),
    )
    fits = (F.size("connected_flights") == 2) & (F.size("route") == 3)
    return routes.withColumn("potential_error", F.when(~fits, "potentially_incorrect_route"))


# --- dimensions ---------------------------------------------------------------------------------


def dim_date(spark: SparkSession, cfg: WarehouseConfig) -> DataFrame:
    date = F.col("date")
    return fn.date_spine(spark, cfg.calendar_start, cfg.calendar_end).select(
        fn.date_to_key(date).alias("date_key"),
        "date",
        fn.year_from_date(date).alias("year"),
        fn.month_from_date(date).alias("month"),
        fn.day_from_date(date).alias("day"),
        fn.quarter_from_date(date).alias("quarter"),
        fn.day_of_week(date).alias("week_day"),
        fn.month_name(date, cfg.padded_names).alias("month_name"),
        fn.weekday_name(date, cfg.padded_names).alias("weekday_name"),
        fn.is_weekend(date).alias("is_weekend"),
        fn.season_from_month(fn.month_from_date(date)).alias("season"),
    )


def dim_time(hours: DataFrame) -> DataFrame:
    hour = F.col("hour")
    return hours.select(
        hour.alias("time_key"),
        hour,
        fn.is_night(hour).alias("is_night"),
        fn.day_period(hour).alias("day_period"),
        F.when(hour < 12, "AM").otherwise("PM").alias("am_pm"),
    )


def dim_flights(flights: DataFrame) -> DataFrame:
    df = flights.select(
        F.col("flight_no").alias("flight_number"),
        "origin",
        "destination",
        fn.date_to_key(F.col("date")).alias("date"),
        fn.round_hour_from_time(F.col("time")).alias("hour_of_departure"),
        "time",
        "source",
        F.when(F.col("source") != "SCHEDULE", "not_in_schedule").alias("potential_error"),
    )
    return df.select(
        fn.surrogate_key("flight_number", "date", "hour_of_departure").alias("flight_key"),
        fn.surrogate_key("flight_number", "date").alias("flight_key_with_date"),
        *df.columns,
    )


def dim_products(catalog: DataFrame) -> DataFrame:
    return catalog.select(
        fn.surrogate_key("item_id").alias("product_key"),
        "item_id",
        "status",
        F.col("item_category").alias("category"),
        "is_food",
        "item_type",
        "price",
    )


def dim_sessions(payments: DataFrame, sales: DataFrame) -> DataFrame:
    """True beats false beats unknown, which is what a maximum over booleans gives.

    Distinct pairs before the union: the optimizer then drops the whole-row distinct of staging.
    """
    unknown = F.lit(None).cast("boolean").alias("is_offline_mode")
    both = (
        payments.select("session_id", "is_offline_mode")
        .distinct()
        .unionByName(sales.select("session_id").distinct().select("session_id", unknown))
    )
    return both.groupBy(F.col("session_id").alias("sales_session_id")).agg(
        F.max("is_offline_mode").alias("is_offline_mode")
    )


def dim_card(payments: DataFrame, bank: DataFrame) -> DataFrame:
    used = payments.select("card_number_prefix").where("card_number_prefix is not null").distinct()
    side = bank.select(
        F.col("card_number_prefix").cast("string").alias("_bin"),
        F.col("brand").alias("card_brand"),
        F.col("type").alias("reference_card_type"),
        F.col("category").alias("card_category"),
        F.col("issuer").alias("card_issuer"),
        F.col("country_short").alias("issuer_country"),
    )
    joined = used.join(side, F.col("card_number_prefix").cast("string") == F.col("_bin"), "left")
    return joined.drop("_bin").distinct()


def bridge_flight_load(schedule: DataFrame, flights_dim: DataFrame) -> DataFrame:
    """The load of a line spreads to all its flights, those without a load id of their own too."""
    top = schedule.groupBy("line_id").agg(F.max("load_id").alias("load_id"))
    keyed = schedule.select(
        "line_id",
        fn.surrogate_key(
            F.col("flight_no"),
            fn.date_to_key(F.col("date")),
            fn.round_hour_from_time(F.col("time")),
        ).alias("flight_key"),
    ).distinct()
    loaded = keyed.join(top.where("load_id is not null"), "line_id")
    known = loaded.join(flights_dim.select("flight_key"), "flight_key", "left_semi")
    return known.select("line_id", "flight_key", "load_id")


# --- facts --------------------------------------------------------------------------------------


def _at_flight(facts: DataFrame, flights: DataFrame) -> DataFrame:
    """Keep facts of known flights; add the flight's rounded hour and the date key."""
    hours = flights.select(*FLIGHT, fn.round_hour_from_time(F.col("time")).alias("hour_of_departure"))
    return facts.join(hours, FLIGHT).withColumn("date_key", fn.date_to_key(F.col("date")))


def _flight_key() -> Column:
    return fn.surrogate_key("flight_no", "date_key", "hour_of_departure").alias("flight_key")


def fact_sales(sales: DataFrame, flights: DataFrame) -> DataFrame:
    slips = sales.groupBy(*SALE).agg(
        F.sum("sold_quantity").alias("sold_quantity"),
        F.sum("purchase_amount").alias("purchase_amount"),
        F.sum("discount_amount").alias("discount_amount"),
    )
    df = _at_flight(slips, flights).withColumn("product_key", fn.surrogate_key("item_id"))
    return df.select(
        fn.surrogate_key("slip_id", "product_key", "sales_type").alias("sale_transaction_key"),
        "slip_id",
        _flight_key(),
        F.col("session_id").alias("sales_session_id"),
        "load_id",
        "sales_type",
        "currency",
        "product_key",
        "sold_quantity",
        "purchase_amount",
        "discount_amount",
    )


def fact_payments(payments: DataFrame, flights: DataFrame) -> DataFrame:
    slip = ["slip_id", "sales_type", "payment_type", "card_number_prefix"]
    paid = payments.groupBy(*slip, *FLIGHT, "session_id", "load_id").agg(
        F.sum("purchase_amount_main").alias("purchase_amount_main")
    )
    return _at_flight(paid, flights).select(
        fn.surrogate_key(*slip).alias("payment_transaction_key"),
        _flight_key(),
        F.col("session_id").alias("sales_session_id"),
        "load_id",
        *slip,
        "purchase_amount_main",
    )


def fact_pax(pax: DataFrame, flights: DataFrame) -> DataFrame:
    seats = pax.groupBy(*FLIGHT, F.col("class").alias("travel_class")).agg(
        F.sum("pax_quantity").alias("number_of_passengers")
    )
    return _at_flight(seats, flights).select(
        fn.surrogate_key("flight_no", "date_key", "hour_of_departure", "travel_class").alias(
            "passenger_count_key"
        ),
        _flight_key(),
        F.col("date_key").alias("date"),
        "hour_of_departure",
        "travel_class",
        "number_of_passengers",
        F.when(F.col("number_of_passengers") == 0, "zero_pax_count").alias("potential_error"),
    )


def fact_wastage(wastage: DataFrame) -> DataFrame:
    counts = ["load_quantity", "sold_quantity", "wastage_quantity", "fresh_wastage_quantity"]
    waste = wastage.groupBy(*FLIGHT, "item_id", "load_id").agg(*[F.sum(c).alias(c) for c in counts])
    waste = waste.withColumn("date_key", fn.date_to_key(F.col("date"))).withColumn(
        "product_key", fn.surrogate_key("item_id")
    )
    return waste.select(
        fn.surrogate_key("flight_no", "date_key", "product_key", "load_id").alias(
            "wastage_record_key"
        ),
        "load_id",
        fn.surrogate_key("flight_no", "date_key").alias("flight_key_with_date"),
        "product_key",
        *counts,
    )


def fact_items_load(items_load: DataFrame, flights: DataFrame) -> DataFrame:
    loads = items_load.groupBy(*LOAD).agg(
        F.sum("total_loaded_quantity").alias("total_loaded_quantity")
    )
    return _at_flight(loads, flights).select(
        _flight_key(),
        fn.surrogate_key("load_id", "item_id").alias("item_load_key"),
        "load_id",
        fn.surrogate_key("item_id").alias("product_key"),
        "total_loaded_quantity",
        F.when(F.col("total_loaded_quantity") == 0, "zero_load_error").alias("potential_error"),
    )


# --- marts --------------------------------------------------------------------------------------


def pax_by_flight(pax: DataFrame) -> DataFrame:
    return pax.groupBy("flight_key").agg(F.sum("number_of_passengers").alias("total_passengers"))


def fresh_products(products: DataFrame) -> DataFrame:
    """Products on sale that are fresh and not bought-on-board bundles."""
    return products.where(
        (F.col("item_type") == "Fresh Product")
        & (F.col("category") != "BOL Products")
        & (F.col("status") == "Active")
    )


def mart_fresh_food_order_sale(
    bridge: DataFrame,
    flights: DataFrame,
    dates: DataFrame,
    times: DataFrame,
    items_load: DataFrame,
    products: DataFrame,
    pax: DataFrame,
    sales: DataFrame,
) -> DataFrame:
    """Every loaded fresh product of every flight of a line, with its sales or zero.

    Loads meet flights on the load id alone, so a line's items reach all its flights. Keys meet first: what describes
    a flight is added to the result, so the rows shuffled to their sales do not carry it.
    """
    flight_pax = pax_by_flight(pax)
    number_pax = (
        flight_pax.join(flights.select("flight_key", "flight_number"), "flight_key")
        .groupBy("flight_number")
        .agg(F.avg("total_passengers").alias("avg_passengers"))
    )
    flown = (
        flights.select(
            "flight_key",
            "flight_number",
            "origin",
            "destination",
            F.col("date").alias("date_key"),
            "hour_of_departure",
        )
        .join(
            dates.select("date_key", "date", "month_name", "year", "weekday_name", "is_weekend"),
            "date_key",
        )
        .join(
            times.select(F.col("time_key").alias("hour_of_departure"), "day_period", "is_night", "am_pm"),
            "hour_of_departure",
        )
        .join(flight_pax, "flight_key", "left")
        .join(number_pax, "flight_number", "left")
    )
    # fresh items first: both large facts shrink before they are shuffled
    fresh = fresh_products(products).select("product_key", "item_id", "category", "price")
    loaded = (
        items_load.where("potential_error is null")
        .select("load_id", "product_key")
        .join(fresh, "product_key")
    )
    sold = (
        sales.join(fresh, "product_key", "left_semi")
        .groupBy("flight_key", "product_key")
        .agg(F.sum("sold_quantity").alias("sold_quantity"))
    )
    guests = F.coalesce("total_passengers", "avg_passengers")
    return (
        bridge.select("flight_key", "load_id")
        .join(loaded, "load_id")
        .join(sold, ["flight_key", "product_key"], "left")
        .join(flown, "flight_key")
        .select(
            "flight_key",
            "flight_number",
            "origin",
            "destination",
            "date",
            "month_name",
            "year",
            "weekday_name",
            "is_weekend",
            "hour_of_departure",
            "day_period",
            "is_night",
            "am_pm",
            guests.alias("number_of_passengers"),
            "item_id",
            "category",
            "price",
            F.coalesce("sold_quantity", F.lit(0)).alias("sold_quantity"),
            F.when(guests.isNull(), "no_pax_data")
            .when(guests == 0, "zero_pax_count")
            .alias("potential_error"),
        )
    )


def mart_pax_sales(
    sales: DataFrame,
    pax: DataFrame,
    flights: DataFrame,
    times: DataFrame,
    dates: DataFrame,
    per_flight: bool = False,
) -> DataFrame:
    """Tickets, quantity, revenue and passengers of each flight that has both sales and passengers.

    As published, a flight's sales are counted once per travel class. ``per_flight=True`` is the
    corrected form: passengers are added up first, so a flight's sales count once.
    """
    # Two steps instead of count(distinct): a hot flight's slips are spread by slip first.
    slips = sales.groupBy("flight_key", "slip_id").agg(
        F.sum("sold_quantity").alias("sold_quantity"),
        F.sum("purchase_amount").alias("purchase_amount"),
    )
    sold = slips.groupBy("flight_key").agg(
        F.count("slip_id").alias("number_of_tickets"),
        F.sum("sold_quantity").alias("sold_quantity"),
        F.sum("purchase_amount").alias("purchase_amount"),
    )
    classes = F.lit(1) if per_flight else F.count("*")
    seats = pax.groupBy("flight_key").agg(
        F.sum("number_of_passengers").alias("passenger_count"), classes.alias("classes")
    )
    calendar = dates.select(
        F.col("date_key"), "date", "year", "month", "day", "week_day", "weekday_name", "is_weekend"
    )
    times = times.select(F.col("time_key").alias("hour_of_departure"), "day_period", "am_pm", "is_night")
    return (
        sold.join(seats, "flight_key")
        .join(flights.withColumnRenamed("date", "date_key"), "flight_key")
        .join(times, "hour_of_departure")
        .join(calendar, "date_key")
        .select(
            "flight_key",
            "flight_number",
            "date",
            "year",
            "month",
            "day",
            "week_day",
            "weekday_name",
            "is_weekend",
            "origin",
            "destination",
            F.concat("origin", F.lit(" _ "), "destination").alias("route"),
            "day_period",
            "am_pm",
            "is_night",
            "passenger_count",
            (F.col("number_of_tickets") * F.col("classes")).alias("number_of_tickets"),
            (F.col("sold_quantity") * F.col("classes")).alias("sold_quantity"),
            (F.col("purchase_amount") * F.col("classes")).cast("decimal(38,2)").alias("purchase_amount"),
        )
    )


# --- wiring -------------------------------------------------------------------------------------

TABLES = (
    "dim_date",
    "dim_time",
    "dim_flights",
    "dim_products",
    "dim_sessions",
    "dim_card",
    "bridge_flight_load",
    "fact_sales",
    "fact_payments",
    "fact_pax",
    "fact_wastage",
    "fact_items_load",
    "mart_fresh_food_order_sale",
    "mart_pax_sales",
)
# Written once for readers of their whole rows, or every one of them would scan, look up and make distinct again.
STORED_INTERMEDIATE = (
    "stg_items_load",
    "stg_pax",
    "stg_payments",
    "stg_sales",
    "stg_schedule",
    "stg_wastage",
    "int_flights",
)
# Tables of dated rows: stored in one folder per month. The other facts carry keys only.
BY_MONTH = (
    *STORED_INTERMEDIATE,
    "fact_pax",
    "mart_fresh_food_order_sale",
    "mart_pax_sales",
)

# Tables of more rows than flights that ``once`` does not write.
READ_ONCE = ("fact_sales", "fact_payments", "fact_wastage", "fact_items_load", "mart_fresh_food_order_sale")

# Facts that the fresh-food mart reads: raw dataset and staging model behind each.
FRESH_SOURCES = {
    "fact_items_load": ("items_load", "stg_items_load"),
    "fact_sales": ("sales", "stg_sales"),
}


class _Replaced(Mapping):
    """Raw datasets of which one is replaced; the others are not touched before they are read."""

    def __init__(self, raw: Mapping[str, DataFrame], name: str, rows: DataFrame):
        self._raw, self._name, self._rows = raw, name, rows

    def __getitem__(self, name: str) -> DataFrame:
        return self._rows if name == self._name else self._raw[name]

    def __iter__(self):
        return iter(self._raw)

    def __len__(self) -> int:
        return len(self._raw)


class Warehouse:
    """Names the models and wires each to its inputs.

    ``model(name)`` is the plan of a model. ``ref(name)`` is what another model reads: a view for
    small staging and intermediate models, the written table for the rest when ``root`` is given. A table
    on shared storage survives lost executors, and its file size lets Spark choose broadcast joins
    while planning.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, DataFrame],
        config: WarehouseConfig | None = None,
        root: str | None = None,
    ):
        self.spark = spark
        self.raw = raw
        self.config = config or WarehouseConfig()
        self.root = root.rstrip("/") if root else None
        self._refs: dict[str, DataFrame] = {}

    def _builders(self, raw: Mapping[str, DataFrame] | None = None) -> dict[str, Callable[[], DataFrame]]:
        raw, ref, cfg, spark, seen = raw or self.raw, self.ref, self.config, self.spark, self.seen
        return {
            "stg_bank": lambda: staging.stg_bank(raw["bank"]),
            "stg_catalog": lambda: staging.stg_catalog(raw["product_catalog"]),
            "stg_items_load": lambda deal=None: staging.stg_items_load(raw["items_load"], cfg, deal),
            "stg_line": lambda: staging.stg_line(raw["line_load"], raw["cities"], cfg),
            "stg_pax": lambda: staging.stg_pax(raw["pax"], raw["cities"], cfg),
            "stg_payments": lambda: staging.stg_payments(
                raw["payments"], raw["cities"], raw["currencies"], cfg
            ),
            "stg_sales": lambda deal=None: staging.stg_sales(
                raw["sales"], raw["cities"], raw["currencies"], cfg, deal
            ),
            "stg_schedule": lambda: staging.stg_schedule(raw["schedule"], raw["cities"], cfg),
            "stg_wastage": lambda: staging.stg_wastage(raw["wastage"], raw["cities"], cfg),
            "int_hours": lambda: int_hours(spark),
            "int_flights": lambda: int_flights(
                ref("stg_schedule"),
                seen("stg_items_load"),
                seen("stg_wastage"),
                seen("stg_sales"),
                seen("stg_payments"),
                ref("stg_pax"),
            ),
            "int_flight_load": lambda: int_flight_load(ref("stg_schedule")),
            "int_line_route": lambda: int_line_route(ref("stg_line")),
            "dim_date": lambda: dim_date(spark, cfg),
            "dim_time": lambda: dim_time(ref("int_hours")),
            "dim_flights": lambda: dim_flights(ref("int_flights")),
            "dim_products": lambda: dim_products(ref("stg_catalog")),
            "dim_sessions": lambda: dim_sessions(seen("stg_payments"), seen("stg_sales")),
            "dim_card": lambda: dim_card(seen("stg_payments"), ref("stg_bank")),
            "bridge_flight_load": lambda: bridge_flight_load(
                ref("stg_schedule"), ref("dim_flights")
            ),
            "fact_sales": lambda: fact_sales(seen("stg_sales", SALE), ref("int_flights")),
            "fact_payments": lambda: fact_payments(seen("stg_payments"), ref("int_flights")),
            "fact_pax": lambda: fact_pax(ref("stg_pax"), ref("int_flights")),
            "fact_wastage": lambda: fact_wastage(seen("stg_wastage")),
            "fact_items_load": lambda: fact_items_load(
                seen("stg_items_load", LOAD), ref("int_flights")
            ),
            "mart_fresh_food_order_sale": lambda: mart_fresh_food_order_sale(
                ref("bridge_flight_load"),
                ref("dim_flights"),
                ref("dim_date"),
                ref("dim_time"),
                self._fresh("fact_items_load"),
                ref("dim_products"),
                ref("fact_pax"),
                self._fresh("fact_sales"),
            ),
            "mart_pax_sales": lambda: mart_pax_sales(
                ref("fact_sales"),
                ref("fact_pax"),
                ref("dim_flights"),
                ref("dim_time"),
                ref("dim_date"),
            ),
        }

    @property
    def names(self) -> list[str]:
        return list(self._builders())

    def model(self, name: str) -> DataFrame:
        return self._builders()[name]()

    def seen(self, name: str, deal: Sequence[str] | None = None) -> DataFrame:
        """A staging model for the flights, dimensions and facts: the stored table where a reader had it stored, else its plan.

        Flights and dimensions read a few columns of it, whose distinct replaces the whole-row distinct. A fact reads all rows
        once, dealt by what it sums by (``deal``), so that distinct and sum share a shuffle. Neither is a reason to write the wide
        rows and read them back.
        """
        if name in self._refs:
            return self._refs[name]
        return self._builders()[name](deal) if deal else self.model(name)

    def once(self, name: str) -> DataFrame:
        """A table for a single reader of few columns: a large one that nothing has stored is its plan, which then forms those columns
        only and is not written."""
        return self.model(name) if name in READ_ONCE and name not in self._refs else self.ref(name)

    def _fresh(self, name: str) -> DataFrame:
        """What the fresh-food mart reads of a fact: the stored fact where there is one, else the fact of fresh items only.

        Facts keep items apart, so rows of other items go before anything is shuffled. Items are compared as text, as keys are.
        """
        if name in self._refs:
            return self._refs[name]
        source, staged = FRESH_SOURCES[name]
        flights = self.ref("int_flights")
        items = fresh_products(self.ref("dim_products")).select(F.col("item_id").cast("string").alias("_item"))
        if staged in self._refs:
            rows = self._refs[staged]
            rows = rows.join(items, F.col("item_id").cast("string") == F.col("_item"), "left_semi")
        else:
            rows = self.raw[source]
            rows = rows.join(items, F.col("item_reference").cast("string") == F.col("_item"), "left_semi")
            rows = self._builders(_Replaced(self.raw, source, rows))[staged]()
        return {"fact_items_load": fact_items_load, "fact_sales": fact_sales}[name](rows, flights)

    def ref(self, name: str) -> DataFrame:
        if name not in self._refs:
            df = self.model(name)
            if self.root and name in (*TABLES, *STORED_INTERMEDIATE):
                path = f"{self.root}/{name}"
                # their plans end in a shuffle that spreads the rows: no other one before the write
                df = overwrite_by_month(df, path, deal=False) if name in BY_MONTH else overwrite(df, path)
            self._refs[name] = df
        return self._refs[name]

    def build(self) -> list[str]:
        """Write every dimension, bridge, fact and mart; inputs are written before their readers."""
        for name in TABLES:
            self.ref(name)
        return list(TABLES)
