"""Trailing windows over one-minute panes.

A pane holds, for a minute, the first and last second of each cell, shop and device. A window of at least a minute cuts a pane on one side
only, and whether a device was seen on the right side of the cut is told by its first or last second: distinct devices of a window are exact,
to the second, without a ping. Panes of several batches are put together by simply reading all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallflow.operators.visits import visit_summary

PANE_SECONDS = 60


def pane_summary(pings: DataFrame, *keys: str) -> DataFrame:
    """First and last second by minute, cell, shop and device (and ``keys``). The number of pings is left out: a cut pane has no exact one."""
    paned = pings.withColumn("pane", F.floor(F.col("time_stamp") / PANE_SECONDS).cast("int"))
    return visit_summary(paned, *keys, "pane").drop("pings")


def trailing_panes(panes: DataFrame, as_of: int, seconds: int) -> DataFrame:
    """What was seen in the ``seconds`` up to and including ``as_of``; for counts of distinct devices, as of ``clean.trailing``."""
    if seconds < PANE_SECONDS:
        raise ValueError(f"a window of panes has at least {PANE_SECONDS} seconds")
    return panes.where((F.col("last_ts") > as_of - seconds) & (F.col("first_ts") <= as_of))
