"""Airline-retail analytics on Spark: warehouse, metrics, quality checks, demand forecast."""

from skygalley.config import ForecastConfig, WarehouseConfig
from skygalley.errors import ModelDegradationError, ValidationError
from skygalley.plans.warehouse import Warehouse

__all__ = [
    "ForecastConfig",
    "ModelDegradationError",
    "ValidationError",
    "Warehouse",
    "WarehouseConfig",
]
