from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skygalley.config import UNKNOWN

# How key parts are joined and what stands for a missing part.
NULL_PART = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
PIPE = "|"


def _digest(columns: tuple[str | Column, ...], separator: str, missing: str) -> Column:
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    texts = [F.coalesce(p.cast("string"), F.lit(missing)) for p in parts]
    return F.md5(F.concat_ws(separator, *texts))


def surrogate_key(*columns: str | Column) -> Column:
    """Hex md5 over the text forms of the columns. Hours and date keys must be integers first."""
    return _digest(columns, KEY_SEPARATOR, NULL_PART)


def pipe_md5(*columns: str | Column) -> Column:
    """Key of the older star schema: pipe-joined, missing parts are UNKNOWN."""
    return _digest(columns, PIPE, UNKNOWN)
