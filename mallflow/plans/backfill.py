"""Rebuilding shop moves of past days."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from mallflow.operators.links import parted_links
from mallflow.schema import CLEAN_PING, LINK, with_keys
from mallflow.session import scratch_dir
from mallflow.sources.tables import replace_partition, replace_partitions, scan, scan_days

DATED_CLEAN_PING = with_keys(CLEAN_PING, ("p_dt", T.StringType()))
_DATED_LINK = with_keys(LINK, ("p_dt", T.StringType()), ("part", T.StringType()))


def _partitions(frame: DataFrame) -> set[tuple[str, str]]:
    # One row for each stored date and hour.
    return {tuple(row) for row in frame.select("p_dt", "part").distinct().collect()}


def backfill_links(spark: SparkSession, dw_root: str, links_root: str, days: Iterable[str] | None = None) -> None:
    """Overwrite the link partitions of the given processing dates from the clean pings, all days in one job.

    Without ``days``, every date that has pings or moves. A date or hour without any move is left empty.
    """
    if days is None:
        dw, old = scan(spark, dw_root, DATED_CLEAN_PING), scan(spark, links_root, _DATED_LINK)
    else:
        days = sorted(set(days))
        dw, old = scan_days(spark, dw_root, DATED_CLEAN_PING, days), scan_days(spark, links_root, _DATED_LINK, days)
    held = _partitions(old)
    # Written once, so that finding the dates does not walk the paths again.
    root = scratch_dir(spark, "moves")
    parted_links(dw).write.parquet(root)
    moves = spark.read.schema(_DATED_LINK).parquet(root)
    replace_partitions(moves, links_root, "p_dt", "part")
    for day, part in sorted(held - _partitions(moves)):
        replace_partition(moves.limit(0), links_root, f"p_dt={day}/part={part}")
