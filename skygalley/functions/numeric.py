from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column, digits: int = 0) -> Column:
    """Round a double as numpy does: scale, nearest even integer, scale back."""
    scale = float(10**digits)
    return F.rint(value.cast("double") * scale) / scale


def non_negative_int(value: Column) -> Column:
    """A raw prediction as a quantity: nearest even integer, never below zero."""
    return F.greatest(F.rint(value.cast("double")), F.lit(0.0)).cast("int")


def floor_threshold(raw: Column, threshold: Column | float = 0.5) -> Column:
    """Round up only when the fraction reaches the threshold; never below zero."""
    raw = raw.cast("double")
    up = F.when(raw - F.floor(raw) >= threshold, 1).otherwise(0)
    return F.greatest(F.floor(raw) + up, F.lit(0)).cast("int")


def null_if(value: Column, unwanted: object) -> Column:
    return F.nullif(value, F.lit(unwanted))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double; null where the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def absolute_error(fact: Column, predicted: Column) -> Column:
    return F.abs(fact.cast("double") - predicted.cast("double"))


def bucket(
    value: Column,
    edges: Sequence[float],
    labels: Sequence[str],
    *,
    include_lowest: bool = False,
    left_closed: bool = False,
) -> Column:
    """Label the interval a value falls in; outside every interval, or null, gives null.

    Intervals are closed on the right, ``(a, b]``; ``include_lowest`` also takes the first edge in.
    ``left_closed`` gives ``[a, b)`` with open outer ends, as used when a forecast is served.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    if left_closed:
        out = None
        for upper, label in zip(edges[1:-1], labels):
            out = F.when(value < upper, label) if out is None else out.when(value < upper, label)
        last = value.isNotNull()
        return F.when(last, labels[-1]) if out is None else out.when(last, labels[-1])
    lowest = value >= edges[0] if include_lowest else value > edges[0]
    out = F.when(~lowest, None)
    for upper, label in zip(edges[1:], labels):
        out = out.when(value <= upper, label)
    return out
