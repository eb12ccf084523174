"""Calendar expressions for dim_date and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_key(d) -> Column:
    """yyyyMMdd as INT, computed arithmetically (no string formatting)."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def key_year(key) -> Column:
    return F.floor(_c(key) / 10000).cast("int")


def key_month(key) -> Column:
    return (F.floor(_c(key) / 100) % 100).cast("int")


def month_index(year, month) -> Column:
    """Months since year 0; consecutive months differ by exactly 1."""
    return (_c(year) * 12 + _c(month)).cast("int")


def calendar_columns(d="full_date") -> dict[str, Column]:
    """The dim_date attributes of a date column."""
    d = _c(d)
    return {
        "date_key": date_key(d),
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "day": F.dayofmonth(d),
        "day_of_week": F.date_format(d, "EEEE"),
        # Spark numbers Sunday=1 .. Saturday=7.
        "is_weekend": F.dayofweek(d).isin(1, 7),
    }
