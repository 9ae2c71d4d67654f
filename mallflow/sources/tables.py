"""Date-partitioned parquet tables.

Every write replaces whole partitions, so a write that is run again after a failure leaves the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _named(root: str, partitions: Sequence[str]) -> str:
    """One path for the given partition directories below ``root``.

    Alternatives that hold a slash are looked up one by one; without it the whole, ever growing table would be listed.
    Alternatives that do not exist are passed over.
    """
    head, tail = root.rstrip("/").rsplit("/", 1)
    return f"{head}/{{{','.join(f'{tail}/{part}' for part in partitions)}}}"


def scan(spark: SparkSession, root: str, schema: T.StructType, partitions: Sequence[str] | None = None) -> DataFrame:
    """A table with a declared schema, so that ``p_dt`` stays text. A table never written yet has no rows.

    ``partitions`` names the partition directories to look into, such as ``p_dt=20240115``; by default all of them.
    """
    path = root if partitions is None else _named(root, partitions)
    try:
        return spark.read.schema(schema).option("basePath", root).parquet(path).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_days(spark: SparkSession, root: str, schema: T.StructType, days: Iterable[str]) -> DataFrame:
    """Only the partitions of the given processing dates; no other directory is listed."""
    days = list(days)
    return scan(spark, root, schema, [f"p_dt={day}" for day in days]).where(F.col("p_dt").isin(days))


def scan_day(spark: SparkSession, root: str, schema: T.StructType, p_dt: str, *below: str) -> DataFrame:
    """One processing date, or the partitions ``below`` it, such as ``dt_hour=14``."""
    partitions = [f"p_dt={p_dt}/{part}" for part in below] or [f"p_dt={p_dt}"]
    return scan(spark, root, schema, partitions).where(F.col("p_dt") == p_dt)


def _sized(frame: DataFrame, keys: tuple[str, ...], order: Sequence[str] = ()) -> DataFrame:
    # Gathers each partition's rows into files of the advisory size; an oversized partition is split over several tasks.
    rows = frame.hint("rebalance", *[F.col(k) for k in keys])
    return rows.sortWithinPartitions(*keys, *order) if order else rows


def replace_partitions(frame: DataFrame, root: str, *keys: str, sized: bool = True, order: Sequence[str] = ()) -> None:
    """Replace exactly the partitions that ``frame`` holds rows for; all others stay as they are.

    The rows of a file are in the given ``order``, so that readers of a range pass over the rest of it.
    """
    (
        (_sized(frame, keys, order) if sized else frame)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(root)
    )


def replace_day(
    frame: DataFrame, root: str, p_dt: str, *keys: str, sized: bool = True, order: Sequence[str] = ()
) -> None:
    """Replace everything stored for one processing date, also when ``frame`` is empty."""
    rows = frame.drop("p_dt")
    if keys and sized:
        rows = _sized(rows, keys, order)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*keys) if keys else writer).parquet(f"{root}/p_dt={p_dt}")


def replace_partition(frame: DataFrame, root: str, partition: str, sized: bool = True) -> None:
    """Replace the one partition directory, such as ``p_dt=20240115/run=0-3``, also when ``frame`` is empty."""
    keys = [level.split("=")[0] for level in partition.split("/")]
    rows = frame.drop(*keys)
    (rows.hint("rebalance") if sized else rows).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/{partition}")


def stamp(frame: DataFrame, p_dt: str, batch_id: int | None = None) -> DataFrame:
    """Add the processing date, and the batch a row arrived in."""
    frame = frame.withColumn("p_dt", F.lit(p_dt))
    return frame if batch_id is None else frame.withColumn("batch_id", F.lit(batch_id).cast("long"))


def append_batch(frame: DataFrame, root: str, p_dt: str, batch_id: int, *keys: str, sized: bool = True) -> None:
    """Add one batch to a processing date. The same batch written again takes its own place, not a second one."""
    replace_partitions(stamp(frame, p_dt, batch_id), root, "p_dt", *keys, "batch_id", sized=sized)


def overwrite_day(frame: DataFrame, root: str, p_dt: str, sized: bool = False) -> None:
    """Overwrite one processing date's partition; a frame without rows leaves the old partition in place.

    Scan-sized tasks already give good files for a whole day, so the rows are not regrouped by default.
    """
    replace_partitions(stamp(frame, p_dt), root, "p_dt", sized=sized)
