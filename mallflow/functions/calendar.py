"""Clock strings, their parts, and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted clock format, and the date-key formats by output name.
CLOCK_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
DATE_KEY_FORMATS = {
    "year": "yyyy",
    "month": "MM",
    "day": "dd",
    "hour": "HH",
    "minute": "mm",
    "second": "ss",
    "year_month": "yyyyMM",
    "date": "yyyyMMdd",
}

PARTS = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
    "minute": F.minute,
    "second": F.second,
}


def clock(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text as a timestamp in the session zone; null when it is no such instant.

    The shape test keeps out the other layouts a plain cast accepts; the cast is far cheaper than a pattern parser.
    """
    return F.when(text.rlike(CLOCK_SHAPE), text.try_cast("timestamp"))


def date_part(text: Column, part: str) -> Column:
    """One integer part of a clock string. Text of ten characters or fewer carries no clock and gives 0."""
    return F.when(F.length(text) <= 10, F.lit(0)).otherwise(PARTS[part](clock(text)))


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a timestamp; null when they do not fit into an integer."""
    return F.unix_timestamp(ts).try_cast("int")


def date_keys(ts: Column) -> dict[str, Column]:
    """Zero-padded text parts of a timestamp, by name."""
    return {name: F.date_format(ts, pattern) for name, pattern in DATE_KEY_FORMATS.items()}


def date_path(ts: Column) -> Column:
    """``yyyy/yyyyMM/yyyyMMdd`` directory path of a timestamp."""
    keys = date_keys(ts)
    return F.concat_ws("/", keys["year"], keys["year_month"], keys["date"])
