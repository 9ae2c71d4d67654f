"""Pings, shop map and blacklist derived from the provided tables.

Cuts, moduli and offsets below are fixed values of the test data derivation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mallflow.functions import snap
from mallflow.operators.lookup import Dimensions, load_dimensions
from mallflow.operators.parse import MESSAGE_FIELDS
from mallflow.schema import MALL_ID, PASSAGE, PING, WALKWAY

FOLDED_DAY = "2024-01-15"
FOLDED_DATE_KEY = "20240115"
FOLDED_MIDNIGHT = 1705276800


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _positions() -> dict[str, Column]:
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    spot = (k % 4 + 1).cast("string")
    raw_x = (F.col("event_id") * 7 + F.col("user_id") * 3) % 79
    raw_y = F.floor("value").cast("bigint") % 53
    return {
        "shopcode": F.lit(MALL_ID),
        "mac": F.concat(F.lit("m"), F.col("user_id").cast("string")),
        "ipAddr": F.concat(F.lit("10.0.0."), (F.col("user_id") % 200).cast("string")),
        "locID": F.concat(F.lit("L"), spot),
        "locName": F.concat(F.lit("F"), spot),
        "rawX": raw_x.cast("string"),
        "rawY": raw_y.cast("string"),
        "posX": snap(raw_x),
        "posY": snap(raw_y),
    }


def _clock_parts() -> dict[str, Column]:
    return {"dt_hour": F.hour("ts"), "dt_min": F.minute("ts"), "dt_sec": F.second("ts")}


def pings(events: DataFrame) -> DataFrame:
    """One ping per event, all events folded onto one day."""
    second_of_day = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    columns = {
        **_positions(),
        **_clock_parts(),
        "date_time": F.concat(F.lit(FOLDED_DAY + " "), F.date_format("ts", "HH:mm:ss")),
        "dt_year": F.lit(2024),
        "dt_month": F.lit(1),
        "dt_day": F.lit(15),
        "time_stamp": (F.lit(FOLDED_MIDNIGHT) + second_of_day).cast("int"),
    }
    return events.select(*[columns[c].alias(c) for c in PING.names])


def dated_pings(events: DataFrame) -> DataFrame:
    """One ping per event on its true date, with that date as ``p_dt``."""
    ts = F.col("ts").cast("timestamp")
    columns = {
        **_positions(),
        **_clock_parts(),
        "date_time": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        "dt_year": F.year("ts"),
        "dt_month": F.month("ts"),
        "dt_day": F.dayofmonth("ts"),
        "time_stamp": F.unix_timestamp(ts).cast("int"),
        "p_dt": F.date_format("ts", "yyyyMMdd"),
    }
    return events.select(*[columns[c].alias(c) for c in [*PING.names, "p_dt"]])


def messages(events: DataFrame) -> DataFrame:
    """The CSV text of each folded ping, in column ``value``."""
    columns = {
        **_positions(),
        "date_time": F.concat(F.lit(FOLDED_DAY + " "), F.date_format("ts", "HH:mm:ss")),
    }
    return events.select(F.concat_ws(",", *[columns[c] for c in MESSAGE_FIELDS]).alias("value"))


def shop_map(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    name = F.when(key % 10 == 0, F.lit(WALKWAY)).when(key % 10 == 1, F.lit(PASSAGE)).otherwise(F.col("p_brand"))
    return part.where(key % 10 != 2).select(
        ((key % 35 - key % 5) / 5).cast("int").alias("posx"),
        (key % 5).cast("int").alias("posy"),
        F.concat(F.lit("F"), ((key - key % 35) / 35 + 1).cast("int").cast("string")).alias("floor"),
        name.alias("name"),
        F.when(key % 17 != 3, F.col("p_type")).alias("type"),
    )


def blacklist(customer: DataFrame) -> DataFrame:
    return customer.where(F.col("c_custkey") % 20 == 0).select(
        F.concat(F.lit("m"), F.col("c_custkey").cast("string")).alias("mac")
    )


def dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    return load_dimensions(shop_map(table(spark, sf_dir, "part")), blacklist(table(spark, sf_dir, "customer")))
