"""Mall-wide footfall and dwell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mallflow.operators.visits import span


def batch_counts(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Row counts of a batch before and after cleaning."""
    kept = clean.agg(F.count(F.lit(1)).alias("clean_rows"))
    return raw.agg(F.count(F.lit(1)).alias("raw_rows")).select("raw_rows", kept.scalar().alias("clean_rows"))


def minute_flow(pings: DataFrame) -> DataFrame:
    """Pings and distinct devices per event hour and minute."""
    return pings.groupBy("dt_hour", "dt_min").agg(
        F.count("mac").alias("all_flow"), F.count_distinct("mac").alias("all_customer")
    )


def mac_dwell(visits: DataFrame) -> DataFrame:
    """Seconds between a device's first and last sighting. Pings without a device id form one group of their own."""
    first, last = span(visits)
    return visits.groupBy("mac").agg((F.max(last) - F.min(first)).alias("stay"))


def dwell_totals(visits: DataFrame) -> DataFrame:
    """One row: distinct devices and the sum of their dwell; the sum is null when there are no rows."""
    # One row per device already, so counting non-null ids is the distinct count.
    return mac_dwell(visits).agg(F.count("mac").alias("total_mac"), F.sum("stay").alias("stay_time"))


def _mean_minutes(seconds: Column, devices: Column) -> Column:
    # nullif keeps a day whose pings all lack a device id at null instead of a division error.
    return seconds / F.nullif(devices, F.lit(0)) / F.lit(60.0)


def flow_and_dwell(rt: DataFrame, visits: DataFrame) -> DataFrame:
    """Minute flow of the batch, each row with the day's mean dwell in minutes."""
    mean = dwell_totals(visits).select(_mean_minutes(F.col("stay_time"), F.col("total_mac")))
    return minute_flow(rt).select("*", mean.scalar().alias("stay_min"))


def today_flow(rt: DataFrame, visits: DataFrame) -> DataFrame:
    """:func:`flow_and_dwell` in order of time."""
    return flow_and_dwell(rt, visits).orderBy("dt_hour", "dt_min")


def today_total(visits: DataFrame) -> DataFrame:
    """Distinct devices of the day and their mean dwell: whole seconds first, then minutes."""
    whole = F.expr("stay_time div nullif(total_mac, 0)")
    return dwell_totals(visits).select(
        F.col("total_mac").alias("all_customer"), (whole / F.lit(60.0)).alias("all_stay")
    )
