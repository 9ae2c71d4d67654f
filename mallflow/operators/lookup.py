"""Small static tables joined to every ping, with their measured size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallflow.schema import BLACKLIST, SHOP

# A table is sent to every executor only when its measured size is at most this.
BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 64


@dataclass(frozen=True)
class Dimensions:
    """Shop map and device blacklist, hinted by size, with a version that changes when their rows do."""

    shops: DataFrame
    blacklist: DataFrame
    version: str


def _measure(table: DataFrame, label: str) -> DataFrame:
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns), F.lit(_ROW_OVERHEAD))
    # The hash passes over nulls, so each value goes in with a mark of whether it is one.
    marked = [c for name in table.columns for c in (F.col(name).isNull(), F.col(name))]
    digest = F.xxhash64(*marked).cast("decimal(38,0)")
    return table.agg(
        F.lit(label).alias("label"),
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(width), F.lit(0)).alias("size"),
        F.coalesce(F.sum(digest), F.lit(0)).cast("string").alias("digest"),
    )


def load_dimensions(shops: DataFrame, blacklist: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> Dimensions:
    """Measure both tables in one job and mark the ones that may be broadcast.

    A larger table stays unhinted: the join is then a shuffle join whose skewed partitions the adaptive planner splits.
    """
    shops = shops.select(*SHOP.names)
    blacklist = blacklist.select(*BLACKLIST.names)
    measured = {
        row["label"]: row for row in _measure(shops, "shops").unionAll(_measure(blacklist, "blacklist")).collect()
    }

    def hinted(table: DataFrame, label: str) -> DataFrame:
        return F.broadcast(table) if measured[label]["size"] <= broadcast_bytes else table

    version = "/".join(f"{label}:{measured[label]['n']}:{measured[label]['digest']}" for label in sorted(measured))
    return Dimensions(hinted(shops, "shops"), hinted(blacklist, "blacklist"), version)
