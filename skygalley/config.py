"""Every tunable of the warehouse and of the forecast, with the published defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

UNKNOWN = "UNKNOWN"


@dataclass(frozen=True)
class WarehouseConfig:
    start_date: str = "2025-11-01"
    end_date: str = "2026-02-28"
    calendar_start: str = "2024-01-01"
    # None means one year after the day of the run; the end day itself is left out.
    calendar_end: str | None = None
    # The reference formats month and weekday names padded with blanks to nine characters.
    padded_names: bool = False


@dataclass(frozen=True)
class BoostingConfig:
    iterations: int = 500
    learning_rate: float = 0.05
    depth: int = 6
    random_seed: int = 42
    # The number of rounds, up to ``iterations``, is the one with the least loss on the last weeks of the training part; the
    # search for it ends when so many further rounds brought no less. None runs all rounds and holds no weeks back.
    early_stop_weeks: int | None = 2
    early_stop_patience: int = 20


@dataclass(frozen=True)
class ForecastConfig:
    target: str = "sold_quantity"
    categorical: tuple[str, ...] = ("item_id", "route", "day_period", "pax_bin")
    numerical: tuple[str, ...] = ("hist_avg",)
    required_columns: tuple[str, ...] = (
        "flight_key",
        "origin",
        "destination",
        "date",
        "item_id",
        "sold_quantity",
        "number_of_passengers",
        "is_night",
    )
    pax_edges: tuple[int, ...] = (0, 100, 150, 180, 1000)
    pax_labels: tuple[str, ...] = ("<100", "100 - 150", "150 - 180", "180 +")
    min_samples: int = 5
    hist_levels: int = 4
    start_date: str = "2025-11-01"
    end_date: str = "2026-02-28"
    test_weeks: int = 2
    block_days: int = 14
    degradation_threshold: float = 0.1
    thresholds: dict[str, float] = field(
        default_factory=lambda: {"low_missed_sales": 0.4, "low_wastage": 0.7}
    )
    classifier: BoostingConfig = BoostingConfig()
    regressor: BoostingConfig = BoostingConfig()
