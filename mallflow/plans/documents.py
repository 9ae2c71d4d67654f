"""Metric documents: a processing-time stamp, a metric name and a map of text values."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallflow.functions import date_keys
from mallflow.operators import floors, flow, shops
from mallflow.operators.links import consecutive_links, link_matrix, pair_counts
from mallflow.schema import MALL_ID, METRIC


@dataclass(frozen=True)
class Snapshot:
    """What the metrics of one batch read: the clean batch, the clean day, and the day's floor minutes and moves by shop pair.

    ``day`` holds clean pings or visit summaries of them. ``pairs`` is asked for when it is needed, as moves are ready last; it may give
    several counts of a pair, which add up.
    """

    rt: DataFrame
    day: DataFrame
    minutes: DataFrame
    pairs: Callable[[], DataFrame]


def snapshot(rt: DataFrame, dw: DataFrame) -> Snapshot:
    moves = consecutive_links(dw.withColumn("p_dt", F.lit("")))
    return Snapshot(rt, dw, floors.floor_minute_flow(dw), lambda: pair_counts(moves))


@dataclass(frozen=True)
class Product:
    """One metric: its rows, the map keys its columns go under, and whether batches add up or replace each other.

    ``hour`` and ``minute`` name columns that stand in for the processing clock; they are written without padding.
    """

    build: Callable[[Snapshot], DataFrame]
    values: dict[str, str]
    appends: bool = False
    hour: str | None = None
    minute: str | None = None


# Metric names and the keys of their value maps. Documents are stored without order.
PRODUCTS: dict[str, Product] = {
    "today_flow": Product(
        lambda s: flow.flow_and_dwell(s.rt, s.day), {"count": "all_customer", "staty": "stay_min"}, appends=True
    ),
    "today_total": Product(
        lambda s: flow.today_total(s.day), {"all_customer": "all_customer", "all_stay": "all_stay"}
    ),
    "rt_max_shop": Product(lambda s: shops.rt_top_shops(s.rt), {"shop": "shop", "flow": "flow"}),
    "day_max_shop": Product(lambda s: shops.shop_flow(s.day), {"shop": "shop", "flow": "flow"}),
    "rt_floor_flow": Product(
        lambda s: floors.floor_flow(s.rt, s.day),
        {"floor": "floor", "uv": "uv", "stay": "stay", "shop": "shop", "flow": "flow"},
    ),
    "day_catalog": Product(lambda s: shops.day_top_category(s.day), {"catalog": "catalog", "total": "total"}),
    "rt_catalog": Product(lambda s: shops.rt_top_category(s.rt), {"catalog": "catalog", "total": "total"}),
    "floor_day_flow": Product(
        lambda s: s.minutes,
        {"floor": "locName", "count": "cnt"},
        hour="dt_hour",
        minute="dt_min",
    ),
    "heat_map": Product(lambda s: floors.heat_map(s.day), {"floor": "floor", "x": "x", "y": "y", "count": "cnt"}),
    "brand_link": Product(
        lambda s: link_matrix(s.pairs()),
        {"from_name": "from_name", "to_name": "to_name", "times": "times", "total": "total"},
    ),
}


@dataclass(frozen=True)
class Trailing:
    """A metric over the last seconds before the batch's processing time: distinct devices, from what was seen in the window."""

    seconds: int
    build: Callable[[DataFrame], DataFrame]
    values: dict[str, str]


# Optional metrics; their windows are fixed values.
TRAILING: dict[str, Trailing] = {
    "trailing_shop": Trailing(600, shops.shop_flow, {"shop": "shop", "flow": "flow"}),
    "trailing_floor": Trailing(600, floors.floor_uv, {"floor": "locName", "uv": "uv"}),
    "trailing_catalog": Trailing(3600, shops.day_top_category, {"catalog": "catalog", "total": "total"}),
}


def metric_documents(
    rows: DataFrame, bi_name: str, as_of: str, values: dict[str, str], hour: str | None = None, minute: str | None = None
) -> DataFrame:
    """One document per row. ``as_of`` is the processing time as clock text; ``values`` maps document keys to columns."""
    keys = date_keys(F.to_timestamp(F.lit(as_of)))
    entries = [c for key, column in values.items() for c in (F.lit(key), F.col(column).cast("string"))]
    columns = {
        "mall_id": F.lit(MALL_ID),
        "p_dt": keys["date"],
        "dt_year": keys["year"],
        "dt_month": keys["month"],
        "dt_day": keys["day"],
        "dt_hour": F.col(hour).cast("string") if hour else keys["hour"],
        "dt_min": F.col(minute).cast("string") if minute else keys["minute"],
        "bi_name": F.lit(bi_name),
        "bi_value": F.create_map(*entries),
    }
    return rows.select(*[columns[name].alias(name) for name in METRIC.names])


def product_documents(bi_name: str, state: Snapshot, as_of: str) -> DataFrame:
    product = PRODUCTS[bi_name]
    return metric_documents(product.build(state), bi_name, as_of, product.values, product.hour, product.minute)


def trailing_documents(bi_name: str, seen: DataFrame, as_of: str) -> DataFrame:
    product = TRAILING[bi_name]
    return metric_documents(product.build(seen), bi_name, as_of, product.values)


def brand_link_documents(links: DataFrame, as_of: str) -> DataFrame:
    """Shop-pair moves as documents, from the moves themselves."""
    return metric_documents(link_matrix(links), "brand_link", as_of, PRODUCTS["brand_link"].values)
