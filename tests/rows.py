"""Hand-written rows for the tests."""

from __future__ import annotations

from datetime import datetime, timezone

from mallflow.operators.lookup import load_dimensions
from mallflow.schema import BLACKLIST, CLEAN_PING, PING, SHOP


def ping(clock="2018-04-03 10:00:00", mac="m1", floor="F1", x=0, y=0, **more):
    when = datetime.strptime(clock, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc)
    row = {
        "shopcode": "sh001",
        "date_time": clock,
        "dt_year": when.year,
        "dt_month": when.month,
        "dt_day": when.day,
        "dt_hour": when.hour,
        "dt_min": when.minute,
        "dt_sec": when.second,
        "time_stamp": int(when.timestamp()),
        "mac": mac,
        "ipAddr": "10.0.0.1",
        "locID": "L1",
        "locName": floor,
        "posX": x,
        "posY": y,
    }
    return {**row, **more}


def clean(clock="2018-04-03 10:00:00", mac="m1", name="Zara", type="Fashion", **more):
    return ping(clock, mac, **more) | {"name": name, "type": type}


def pings(spark, *rows):
    return spark.createDataFrame([tuple(r[c] for c in PING.names) for r in rows], PING)


def clean_pings(spark, *rows, p_dt=None):
    frame = spark.createDataFrame([tuple(r[c] for c in CLEAN_PING.names) for r in rows], CLEAN_PING)
    if p_dt is None:
        return frame
    from pyspark.sql import functions as F

    return frame.withColumn("p_dt", F.lit(p_dt))


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def message(clock="2018-04-03 10:00:00", mac="m1", floor="F1", x=0, y=0):
    return f"sh001,{clock},{mac},10.0.0.1,L1,{floor},{x},{y}"


def dims(spark, shops=(), blacklist=(), **more):
    return load_dimensions(
        spark.createDataFrame(list(shops), SHOP), spark.createDataFrame([(m,) for m in blacklist], BLACKLIST), **more
    )


def as_sets(frame, *columns):
    return sorted(tuple(r[c] for c in columns) for r in frame.collect())
