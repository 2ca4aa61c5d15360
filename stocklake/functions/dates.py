"""Dates and timestamps."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The formats of the landed payloads and of the exported rows.
COMPACT_TS = "yyyyMMdd'T'HHmmss"
COMPACT_SHAPE = "^[0-9]{8}T[0-9]{6}$"
HTTP_DATE = "EEE, dd MMM yyyy HH:mm:ss 'GMT'"


def as_date(value) -> datetime.date:
    """Accept a date or its ISO text."""
    if isinstance(value, datetime.datetime):
        return value.date()
    if isinstance(value, datetime.date):
        return value
    return datetime.date.fromisoformat(value)


def parse_compact_ts(col: Column) -> Column:
    """``20250915T093000`` to a timestamp; anything else to null.

    A failed parse costs far more than a sound one, so only text of that shape is parsed.
    """
    return F.when(col.rlike(COMPACT_SHAPE), F.try_to_timestamp(col, F.lit(COMPACT_TS)))


def millis_to_ts(col: Column) -> Column:
    """Epoch milliseconds to a timestamp of whole seconds, cut towards zero."""
    return F.timestamp_millis(col - col % 1000)


def calendar_columns(df: DataFrame, date_col: str) -> DataFrame:
    """Weekday, month, quarter and year of a date, under their warehouse names."""
    day = F.col(date_col)
    return df.withColumns(
        {
            "time_day_of_week": F.date_format(day, "EEEE"),
            "time_month": F.date_format(day, "MMMM"),
            "time_quarter": F.quarter(day).cast("string"),
            "time_year": F.year(day),
        }
    )


def http_date(col: Column) -> Column:
    """Dates the way the serving rows show them: ``Mon, 15 Sep 2025 00:00:00 GMT``."""
    return F.date_format(col, HTTP_DATE)
