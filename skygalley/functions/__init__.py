"""Column functions: Column in, Column out, all built from JVM-side expressions."""

from skygalley.functions.dates import (
    date_from_iso,
    date_from_short,
    date_from_slashes,
    date_spine,
    date_to_key,
    day_from_date,
    day_of_week,
    day_period,
    is_night,
    is_weekend,
    month_from_date,
    month_name,
    parse_dates,
    quarter_from_date,
    round_hour_from_time,
    season_from_month,
    try_dates,
    week_start,
    weekday_name,
    year_from_date,
)
from skygalley.functions.keys import pipe_md5, surrogate_key
from skygalley.functions.numeric import (
    absolute_error,
    bucket,
    floor_threshold,
    half_even,
    non_negative_int,
    null_if,
    ratio,
)
from skygalley.functions.text import anonymize_flight, concat_text, or_unknown, to_time

__all__ = [
    "absolute_error",
    "anonymize_flight",
    "bucket",
    "concat_text",
    "date_from_iso",
    "date_from_short",
    "date_from_slashes",
    "date_spine",
    "date_to_key",
    "day_from_date",
    "day_of_week",
    "day_period",
    "floor_threshold",
    "half_even",
    "is_night",
    "is_weekend",
    "month_from_date",
    "month_name",
    "non_negative_int",
    "null_if",
    "or_unknown",
    "parse_dates",
    "pipe_md5",
    "quarter_from_date",
    "ratio",
    "round_hour_from_time",
    "season_from_month",
    "surrogate_key",
    "to_time",
    "try_dates",
    "week_start",
    "weekday_name",
    "year_from_date",
]
