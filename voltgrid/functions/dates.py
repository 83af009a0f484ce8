"""Dates and month arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(c: Column, pattern: str) -> Column:
    """Date by pattern, null where the text is no such date."""
    return F.try_to_date(c, pattern)


def month_of(c: Column) -> Column:
    """First day of the month."""
    return F.trunc(c, "MM")


def months_between(start: dt.date, end: dt.date) -> int:
    """Whole months from ``start`` to ``end``."""
    return (end.year - start.year) * 12 + end.month - start.month


def file_name_date(length: int = 8, pattern: str = "yyyyMMdd", name: str = "_metadata.file_name") -> Column:
    """Date from the first characters of the name of the file a row came from."""
    return parse_date(F.substring(F.col(name), 1, length), pattern)
