"""Table schemas and fixed values shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: part of the data contract, must not change -------------------------------------
WALKWAY = "走道"
PASSAGE = "过道"
MALL_ID = "sh001"
CELL_SIZE = 13.1
OPEN_HOUR = 9
CLOSE_HOUR = 23
HEAT_MAP_FLOOR = 5
TOP_N = 10
SHOPS_PER_FLOOR = 3
DATE_KEY = "yyyyMMdd"
# --------------------------------------------------------------------------------------------------

_S, _I = T.StringType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


PING = _struct(
    ("shopcode", _S),
    ("date_time", _S),
    ("dt_year", _I),
    ("dt_month", _I),
    ("dt_day", _I),
    ("dt_hour", _I),
    ("dt_min", _I),
    ("dt_sec", _I),
    ("time_stamp", _I),
    ("mac", _S),
    ("ipAddr", _S),
    ("locID", _S),
    ("locName", _S),
    ("posX", _I),
    ("posY", _I),
)

CLEAN_PING = T.StructType([*PING.fields, T.StructField("name", _S), T.StructField("type", _S)])

SHOP = _struct(("posx", _I), ("posy", _I), ("floor", _S), ("name", _S), ("type", _S))

BLACKLIST = _struct(("mac", _S))

LINK = _struct(("mac", _S), ("date_time", _S), ("from_name", _S), ("to_name", _S), ("times", _I))

METRIC = _struct(
    ("mall_id", _S),
    ("p_dt", _S),
    ("dt_year", _S),
    ("dt_month", _S),
    ("dt_day", _S),
    ("dt_hour", _S),
    ("dt_min", _S),
    ("bi_name", _S),
    ("bi_value", T.MapType(_S, _S)),
)

VISIT = _struct(
    ("locName", _S),
    ("posX", _I),
    ("posY", _I),
    ("name", _S),
    ("type", _S),
    ("mac", _S),
    ("pings", T.LongType()),
    ("first_ts", _I),
    ("last_ts", _I),
)


def with_keys(schema: T.StructType, *keys: tuple[str, T.DataType]) -> T.StructType:
    """``schema`` followed by partition columns, without repeating a column that is already a key."""
    names = {name for name, _ in keys}
    kept = [f for f in schema.fields if f.name not in names]
    return T.StructType([*kept, *[T.StructField(name, dtype) for name, dtype in keys]])
