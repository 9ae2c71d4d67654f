"""Shop enrichment, blacklist removal and the business-hours wash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallflow.operators.lookup import Dimensions
from mallflow.schema import CLOSE_HOUR, OPEN_HOUR


def enrich_shop(pings: DataFrame, shops: DataFrame) -> DataFrame:
    """Add the shop ``name`` and ``type`` of the ping's cell; both null outside the map, one row per matching map row."""
    on = (
        (pings["posX"] == shops["posx"]) & (pings["posY"] == shops["posy"]) & (pings["locName"] == shops["floor"])
    )
    return pings.join(shops, on, "left").select(*[pings[c] for c in pings.columns], shops["name"], shops["type"])


def exclude_blacklist(pings: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Drop pings of listed devices. A ping without a device id is kept."""
    return pings.join(blacklist, "mac", "left_anti").select(*pings.columns)


def clean_batch(pings: DataFrame, dims: Dimensions) -> DataFrame:
    """Current-batch cleaning: all hours, listed devices removed, shops attached."""
    return enrich_shop(exclude_blacklist(pings, dims.blacklist), dims.shops)


def business_hours(pings: DataFrame) -> DataFrame:
    return pings.where((F.col("dt_hour") >= OPEN_HOUR) & (F.col("dt_hour") < CLOSE_HOUR))


def wash_day(pings: DataFrame, dims: Dimensions) -> DataFrame:
    """Whole-day cleaning: business hours only, then as :func:`clean_batch`."""
    return clean_batch(business_hours(pings), dims)


def trailing(pings: DataFrame, as_of: int, seconds: int) -> DataFrame:
    """Pings of the ``seconds`` up to and including the epoch second ``as_of``."""
    return pings.where((F.col("time_stamp") > as_of - seconds) & (F.col("time_stamp") <= as_of))
