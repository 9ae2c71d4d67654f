"""Mergeable per-device, per-cell summary of clean pings.

A visit row carries ``first_ts`` and ``last_ts``; a raw ping is a visit whose two ends coincide. The day metrics are
written against that common shape, so they give the same answer on raw pings, on one summary, or on several summaries of
parts of the day put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VISIT_KEYS = ["locName", "posX", "posY", "name", "type", "mac"]


def span(frame: DataFrame) -> tuple[Column, Column]:
    """The columns holding the earliest and latest second of a row."""
    if "first_ts" in frame.columns:
        return F.col("first_ts"), F.col("last_ts")
    return F.col("time_stamp"), F.col("time_stamp")


def visit_summary(frame: DataFrame, *keys: str) -> DataFrame:
    """Summarise pings, or merge visit rows, per cell, shop and device (and ``keys``)."""
    first, last = span(frame)
    pings = F.sum("pings") if "pings" in frame.columns else F.count(F.lit(1))
    return frame.groupBy(*keys, *VISIT_KEYS).agg(
        pings.alias("pings"), F.min(first).alias("first_ts"), F.max(last).alias("last_ts")
    )
