"""Per-floor flow, dwell, shop ranking and heat map."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mallflow.operators.visits import span
from mallflow.schema import CLEAN_PING, HEAT_MAP_FLOOR, PASSAGE, SHOPS_PER_FLOOR, WALKWAY

# The columns that fix a clean ping: the clock string determines its seven integer parts.
_IDENTITY = ["shopcode", "date_time", "mac", "ipAddr", "locID", "posX", "posY", "name", "type"]


def floor_uv(rt: DataFrame) -> DataFrame:
    """Distinct devices per floor."""
    return rt.groupBy("locName").agg(F.count_distinct("mac").alias("uv"))


def floor_dwell(visits: DataFrame) -> DataFrame:
    """Distinct devices per floor and their mean dwell on it, in minutes."""
    first, last = span(visits)
    per_mac = visits.groupBy("locName", "mac").agg((F.max(last) - F.min(first)).alias("stay"))
    totals = per_mac.groupBy("locName").agg(F.count("mac").alias("total_mac"), F.sum("stay").alias("total_stay"))
    mean = F.col("total_stay") / F.lit(60.0) / F.nullif("total_mac", F.lit(0))
    return totals.select("locName", "total_mac", mean.alias("stay_min"))


def floor_shop_rank(visits: DataFrame) -> DataFrame:
    """The three shops with most devices on each floor; equal counts by name."""
    flow = (
        visits.where(~F.col("name").isin(WALKWAY, PASSAGE))
        .groupBy("locName", "name")
        .agg(F.count_distinct("mac").alias("flow"))
    )
    order = Window.partitionBy("locName").orderBy(F.desc("flow"), "name")
    return flow.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SHOPS_PER_FLOOR)


def floor_summary(visits: DataFrame) -> DataFrame:
    """:func:`floor_dwell` and :func:`floor_shop_rank` in one pass: a row for each floor and top shop, with the floor's mean dwell.

    Visits are reduced by (floor, device) and by (floor, shop, device) at once; what is left then is a row per floor and shop.
    """
    first, last = span(visits)
    rows = visits.select("locName", "name", "mac", first.alias("first"), last.alias("last"))
    devices = rows.groupingSets([["locName", "mac"], ["locName", "name", "mac"]], "locName", "name", "mac").agg(
        F.grouping("name").alias("whole"), (F.max("last") - F.min("first")).alias("stay")
    )
    shares = devices.groupBy("locName", "whole", "name").agg(F.count("mac").alias("flow"), F.sum("stay").alias("stay"))
    floor = Window.partitionBy("locName")
    total_mac, total_stay = (F.max(F.when(F.col("whole") == 1, F.col(c))).over(floor) for c in ("flow", "stay"))
    shop = (F.col("whole") == 0) & ~F.col("name").isin(WALKWAY, PASSAGE)
    found = shares.withColumn("stay_min", total_stay / F.lit(60.0) / F.nullif(total_mac, F.lit(0))).where(shop)
    order = Window.partitionBy("locName").orderBy(F.desc("flow"), "name")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SHOPS_PER_FLOOR)
    return ranked.select("locName", "stay_min", "name", "flow", "rank")


def floor_flow(rt: DataFrame, visits: DataFrame) -> DataFrame:
    """Batch devices per floor with the day's mean dwell and its three top shops, one row per shop."""
    return (
        floor_uv(rt)
        .join(floor_summary(visits), "locName")
        .select(
            F.col("locName").alias("floor"),
            "uv",
            F.col("stay_min").alias("stay"),
            F.col("name").alias("shop"),
            "flow",
            "rank",
        )
    )


def rt_floor_flow(rt: DataFrame, visits: DataFrame) -> DataFrame:
    """:func:`floor_flow` by floor, the top shop last."""
    return floor_flow(rt, visits).orderBy("floor", F.desc("rank")).drop("rank")


def floor_minute_flow(dw: DataFrame, *keys: str) -> DataFrame:
    """Distinct whole records per floor, hour and minute.

    A record with any null column is not counted, but its floor and minute still appear, with 0 if nothing else is there.
    """
    whole = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in CLEAN_PING.names))
    head, *rest = _IDENTITY
    return dw.groupBy(*keys, "locName", "dt_hour", "dt_min").agg(
        F.count_distinct(F.when(whole, F.col(head)), *rest).alias("cnt")
    )


def minute_records(dw: DataFrame) -> DataFrame:
    """The distinct whole records per floor, hour and minute as 128-bit digests (``d1``, ``d2``).

    A record with a null column has no digest; one row without digest stands for all of them in a floor and minute, so that these still
    appear. Records of several batches unite to those of the day, and :func:`minute_counts` of disjoint sets of them add up.
    """
    whole = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in CLEAN_PING.names))
    digests = [F.when(whole, h).alias(name) for name, h in (("d1", F.xxhash64(*_IDENTITY)), ("d2", F.xxhash64(F.lit(1), *_IDENTITY)))]
    return dw.select("locName", "dt_hour", "dt_min", *digests).distinct()


def minute_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("locName", "dt_hour", "dt_min").agg(F.count("d1").alias("cnt"))


def merged_minutes(counts: DataFrame) -> DataFrame:
    """Counts of disjoint sets of records put together."""
    return counts.groupBy("locName", "dt_hour", "dt_min").agg(F.sum("cnt").alias("cnt"))


def heat_map(visits: DataFrame) -> DataFrame:
    """Distinct devices per grid cell, cells with more than five only."""
    return (
        visits.groupBy(F.col("locName").alias("floor"), F.col("posX").alias("x"), F.col("posY").alias("y"))
        .agg(F.count_distinct("mac").alias("cnt"))
        .where(F.col("cnt") > HEAT_MAP_FLOOR)
    )
