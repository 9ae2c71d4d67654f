"""Positional CSV messages to ping records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mallflow.functions import PARTS, cell, clock, epoch_seconds
from mallflow.schema import PING

# Field order of a message. Further fields are ignored.
MESSAGE_FIELDS = ["shopcode", "date_time", "mac", "ipAddr", "locID", "locName", "rawX", "rawY"]

# The ping columns that hold parts of the clock.
PART_COLUMNS = {
    "dt_year": "year",
    "dt_month": "month",
    "dt_day": "day",
    "dt_hour": "hour",
    "dt_min": "minute",
    "dt_sec": "second",
}


def _readable() -> Column:
    return F.col("time_stamp").isNotNull() & F.col("posX").isNotNull() & F.col("posY").isNotNull()


def _where(read: DataFrame, condition: Column) -> DataFrame:
    # A filter moved below the projections would split and parse every line a second time for its own use. A filter that
    # names the task's partition number cannot be moved.
    return read.where((F.col("task") >= 0) & condition)


def read_lines(lines: DataFrame) -> DataFrame:
    """The columns of ``lines`` with what was read from ``value``, for :func:`pings_of` and :func:`dead_letters_of`."""
    # Stacked projections: the split and the clock are each computed once and used by name further up.
    parts = F.split("value", ",")
    fields = lines.select(*lines.columns, *[F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(MESSAGE_FIELDS)])
    read = fields.select(
        "*",
        clock(F.col("date_time")).alias("ts"),
        cell(F.col("rawX")).alias("posX"),
        cell(F.col("rawY")).alias("posY"),
        F.spark_partition_id().alias("task"),
    )
    return read.select("*", epoch_seconds(F.col("ts")).alias("time_stamp"))


def pings_of(read: DataFrame) -> DataFrame:
    parts = {column: PARTS[part](F.col("ts")) for column, part in PART_COLUMNS.items()}
    return _where(read, _readable()).select(*[parts.get(c, F.col(c)).alias(c) for c in PING.names])


def dead_letters_of(read: DataFrame) -> DataFrame:
    return _where(read, ~_readable()).select("value")


def parse_pings(lines: DataFrame) -> DataFrame:
    """Ping records from the ``value`` column; unreadable lines are left to :func:`dead_letters`."""
    return pings_of(read_lines(lines))


def dead_letters(lines: DataFrame) -> DataFrame:
    """The lines that are no ping: too few fields, no such instant, one whose seconds no integer holds, or a coordinate that is no
    integer."""
    return dead_letters_of(read_lines(lines))
