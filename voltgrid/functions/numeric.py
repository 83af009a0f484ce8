"""Null-safe arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value; null stays null (``greatest`` and ``least`` alone would skip it)."""
    bounded = c
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(c.isNotNull(), bounded)


def total(c: Column) -> Column:
    """Sum in which an empty or all-null group gives zero."""
    return F.coalesce(F.sum(c), F.lit(0))


def half_even(c: Column, digits: int = 0) -> Column:
    """Round with ties to the even neighbour."""
    return F.bround(c, digits)
