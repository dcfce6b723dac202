from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygalley.config import ForecastConfig, WarehouseConfig
from skygalley.plans.legacy import LegacyWarehouse
from skygalley.plans.warehouse import Warehouse
from skygalley.registry.oracle import compose
from skygalley.session import new_table_root, small_tasks
from skygalley.sources.driver_tables import DriverTables

# A stated end keeps the calendar, and so the results, the same on every day.
CALENDAR_END = "2027-01-01"
MODULES = (
    "tables",
    "cleaning",
    "legacy_staging",
    "relational",
    "scalars",
    "metrics",
    "checks",
    "forecast",
    "explore",
)


class Lab:
    """One folder of test tables with its warehouse, shared by all queries of a session."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        small_tasks(spark, folder)
        self.root = new_table_root(spark)
        self.tables = DriverTables(spark, folder, self.root)
        self.config = WarehouseConfig(calendar_end=CALENDAR_END)
        self.forecast = ForecastConfig()
        self.wh = Warehouse(spark, self.tables.raw(), self.config, f"{self.root}/warehouse")
        self.legacy = LegacyWarehouse(
            self.wh, self.config.start_date, self.config.end_date, f"{self.root}/legacy"
        )
        self._kept: dict[str, object] = {}

    def table(self, name: str) -> DataFrame:
        return self.tables.table(name)

    def keep(self, name: str, build: Callable[[], object]) -> object:
        """A result that several queries read: built once per session."""
        if name not in self._kept:
            self._kept[name] = build()
        return self._kept[name]


_labs: dict[tuple[str, str], Lab] = {}


def lab(spark: SparkSession, folder: str) -> Lab:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _labs:
        _labs[key] = Lab(spark, folder)
    return _labs[key]


_queries: dict[str, Callable[[Lab], DataFrame]] = {}
_oracles: dict[str, str] = {}


def register(name: str, build: Callable[[Lab], DataFrame], sql: str | None = None) -> None:
    if name in _queries:
        raise ValueError(f"query {name} is registered twice")
    _queries[name] = build
    if sql is not None:
        _oracles[name] = sql


def query(name: str, sql: str | None = None):
    def wrap(build: Callable[[Lab], DataFrame]):
        register(name, build, sql)
        return build

    return wrap


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines show them alike."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"skygalley.registry.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(build: Callable[[Lab], DataFrame]):
        return lambda spark, folder: build(lab(spark, folder))

    return {name: bind(build) for name, build in _queries.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: compose(sql) for name, sql in _oracles.items()}
