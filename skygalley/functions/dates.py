from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# PostgreSQL pads the names from to_char(.., 'Month') and to_char(.., 'Day') to this width.
NAME_WIDTH = 9


def date_to_key(date: Column) -> Column:
    """20251101 for 2025-11-01, by integer arithmetic: no text formatting per row."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def date_from_slashes(text: Column) -> Column:
    """``YYYY/MM/DD``, with or without a time behind it. A cast, far cheaper than a pattern parse."""
    return F.replace(text, F.lit("/"), F.lit("-")).cast("date")


def date_from_iso(text: Column) -> Column:
    """``YYYY-MM-DD``, with or without a time behind it."""
    return text.cast("date")


def date_from_short(text: Column) -> Column:
    """``DD/MM/YY`` in this century."""
    part = [F.split_part(text, F.lit("/"), F.lit(i)) for i in (1, 2, 3)]
    return F.concat(F.lit("20"), part[2], F.lit("-"), part[1], F.lit("-"), part[0]).cast("date")


def try_dates(text: Column, formats: Sequence[str]) -> Column:
    """The date by the first of the stated patterns that fits the whole text; null where none does."""
    return F.coalesce(*[F.try_to_date(text, pattern) for pattern in formats])


def parse_dates(text: Column, formats: Sequence[str]) -> Column:
    """As ``try_dates``, but a text that no pattern fits is an error that names it; a null stays null."""
    why = F.concat(F.lit(f"no date by {', '.join(formats)}: "), text)
    refused = F.when(text.isNotNull(), F.raise_error(why).cast("date"))
    return F.coalesce(try_dates(text, formats), refused)


def year_from_date(date: Column) -> Column:
    return F.year(date)


def month_from_date(date: Column) -> Column:
    return F.month(date)


def day_from_date(date: Column) -> Column:
    return F.dayofmonth(date)


def quarter_from_date(date: Column) -> Column:
    return F.quarter(date)


def day_of_week(date: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(date) + 1


def is_weekend(date: Column) -> Column:
    """False, not null, for a null date."""
    return F.coalesce(F.weekday(date) >= 5, F.lit(False))


def season_from_month(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.between(3, 5), "Spring")
        .when(month.between(6, 8), "Summer")
        .otherwise("Autumn")
    )


def _name(date: Column, pattern: str, padded: bool) -> Column:
    name = F.date_format(date, pattern)
    return F.rpad(name, NAME_WIDTH, " ") if padded else name


def month_name(date: Column, padded: bool = False) -> Column:
    return _name(date, "MMMM", padded)


def weekday_name(date: Column, padded: bool = False) -> Column:
    return _name(date, "EEEE", padded)


def week_start(date: Column) -> Column:
    """The Monday of the week, the grain of weekly charts."""
    return F.date_trunc("week", date).cast("date")


def round_hour_from_time(time: Column) -> Column:
    """Nearest hour of an ``HH:mm:ss`` text; half past 23 stays 23, null stays null."""
    hour = F.substring(time, 1, 2).cast("int")
    minute = F.substring(time, 4, 2).cast("int")
    return F.when(minute >= 30, F.least(hour + 1, F.lit(23))).otherwise(hour)


def is_night(hour: Column) -> Column:
    return F.coalesce((hour >= 22) | (hour <= 4), F.lit(False))


def day_period(hour: Column) -> Column:
    return (
        F.when(is_night(hour), "Night")
        .when(hour.between(5, 11), "Morning")
        .when(hour.between(12, 17), "Day")
        .otherwise("Evening")
    )


def date_spine(spark: SparkSession, start: str, end: str | None) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end`` (default: a year from today)."""
    first = F.to_date(F.lit(start))
    stop = F.to_date(F.lit(end)) if end else F.add_months(F.current_date(), 12)
    days = F.sequence(first, F.date_sub(stop, 1))
    return spark.range(1).select(F.explode(days).alias("date"))
