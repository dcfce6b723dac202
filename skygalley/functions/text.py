from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skygalley.config import UNKNOWN

# Fixed value: every carrier code becomes this one.
CARRIER = "AB"


def concat_text(*parts: Column) -> Column:
    """Text concatenation; null when any part is null."""
    return F.concat(*parts)


def anonymize_flight(flight_no: Column) -> Column:
    return F.concat(F.lit(CARRIER), F.substr(flight_no, F.lit(3)))


def or_unknown(value: Column) -> Column:
    return F.coalesce(value, F.lit(UNKNOWN))


def to_time(text: Column) -> Column:
    """Normalise ``H:mm[:ss]`` to ``HH:mm:ss``; null stays null, anything else is an error.

    The text form sorts like a time of day; this Spark build has no usable TIME type. One cast each
    way keeps the generated code small, which matters in projections over every fact row.
    """
    stamp = F.concat(F.lit("1970-01-01T"), text).cast("timestamp_ntz")
    return F.substring(stamp.cast("string"), 12, 8)
