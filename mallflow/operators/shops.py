"""Shop and category rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallflow.schema import TOP_N, WALKWAY


def _in_shops(frame: DataFrame) -> DataFrame:
    # A null name fails the comparison, so cells outside the shop map go too.
    return frame.where(F.col("name") != WALKWAY)


def shop_flow(frame: DataFrame) -> DataFrame:
    """Distinct devices per shop name, walkways left out."""
    return (
        _in_shops(frame)
        .groupBy(F.col("name").alias("shop"))
        .agg(F.count_distinct("mac").alias("flow"))
    )


def rt_top_shops(rt: DataFrame) -> DataFrame:
    """The batch's ten shops with most devices; equal counts by name."""
    return shop_flow(rt).orderBy(F.desc("flow"), "shop").limit(TOP_N)


def day_shop_rank(visits: DataFrame) -> DataFrame:
    """All shops of the day by devices."""
    return shop_flow(visits).orderBy(F.desc("flow"), "shop")


def day_top_category(visits: DataFrame) -> DataFrame:
    """The day's ten categories with most distinct devices."""
    return (
        _in_shops(visits)
        .where(F.col("type").isNotNull())
        .groupBy(F.col("type").alias("catalog"))
        .agg(F.count_distinct("mac").alias("total"))
        .orderBy(F.desc("total"), "catalog")
        .limit(TOP_N)
    )


def rt_top_category(rt: DataFrame) -> DataFrame:
    """The batch's ten categories with most pings. Shops without a category are one group, labelled after grouping."""
    return (
        _in_shops(rt)
        .groupBy("type")
        .agg(F.count("mac").alias("total"))
        .orderBy(F.desc("total"), F.coalesce("type", F.lit(WALKWAY)), F.col("type").isNull())
        .limit(TOP_N)
        .select(F.coalesce("type", F.lit(WALKWAY)).alias("catalog"), "total")
    )
