"""Closing a past day: the folders of its batches become files of a good size.

A day of one-minute batches leaves 1,440 folders in every table. Once a later day has begun, nothing is added to it any more, and each of
its tables is written anew as one batch, the last one; the mergeable tables as one run. Rows stay the same but for their batch.

A table is first written beside the day and marked, then put in its place, then the mark goes. A step that was lost on the way is
taken up from the mark, so closing can be run again at any time; a day that is closed already is left alone.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallflow.plans.documents import PRODUCTS
from mallflow.plans.runs import merged_run
from mallflow.plans.warehouse import DEAD, DW, MERGEABLE, ODS, PANES, RECORDS, SIGHTINGS, Warehouse
from mallflow.schema import METRIC, with_keys
from mallflow.session import together
from mallflow.sources.tables import replace_day, replace_partition, scan, scan_day
from mallflow.streaming.job import Run, date_key, note_run, noted_runs

# The tables that hold folders of batches, and the partitions above these.
_TABLES: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "ods": (ODS, ()),
    "dead_letters": (DEAD, ()),
    "dw": (DW, ("dt_hour",)),
    "records": (RECORDS, ("dt_hour",)),
    "sightings": (SIGHTINGS, ("part",)),
    "panes": (PANES, ("dt_hour",)),
}
_SERIES = with_keys(T.StructType([f for f in METRIC.fields if f.name != "bi_name"]), ("p_dt", T.StringType()), ("batch_id", T.LongType()))
_TABLES |= {f"metrics/bi_name={name}": (_SERIES, ()) for name, product in PRODUCTS.items() if product.appends}
_MARK = T.StructType([T.StructField("batch_id", T.LongType())])


class DayIsOpen(ValueError):
    """The day cannot be closed yet."""


def _last_run(house: Warehouse, p_dt: str) -> Run | None:
    """The last batch of the day; None if the day has none."""
    dated = noted_runs(house).withColumn("p_dt", F.regexp_replace(F.substring("as_of", 1, 10), "-", ""))
    newest = dated.agg(F.max("p_dt").alias("p_dt")).first()["p_dt"]
    row = dated.where(F.col("p_dt") == p_dt).orderBy(F.desc("batch_id")).drop("p_dt").first()
    if row is None:
        return None
    if newest <= p_dt:
        raise DayIsOpen(f"{p_dt} is the newest day; batches may still be added to it")
    return Run(**row.asDict())


def close_day(house: Warehouse, p_dt: str) -> None:
    """Merge what the batches of a past day have left."""
    last = _last_run(house, p_dt)
    if last is None:
        return
    waiting = house.spark.createDataFrame([(name,) for name in _pending_after(house, p_dt)], "name string")
    if not waiting.isEmpty():
        raise DayIsOpen(f"steps of {', '.join(row['name'] for row in waiting.collect())} are still to be run again")
    steps = [partial(_close, house, name, p_dt, last.batch_id) for name in _TABLES]
    together(house.spark, *steps)
    run = merged_run(last.batch_id)
    if last.after != [run]:
        for name, (schema, merged) in MERGEABLE.items():
            rows = merged(scan_day(house.spark, house.path(name), schema, p_dt, *[f"run={live}" for live in last.after]))
            house.put_run(rows, name, p_dt, run)
        note_run(house, last.closed(run))
    together(house.spark, *[partial(_drop_runs, house, name, p_dt, run) for name in MERGEABLE])


def _pending_after(house: Warehouse, p_dt: str) -> list[str]:
    """Batches of the day that the newest batch still has to take up again."""
    newest = noted_runs(house).orderBy(F.desc("batch_id")).first()
    return [name for name in newest["pending"] if name.startswith(f"{p_dt}/")]


def _mark(house: Warehouse, name: str, p_dt: str) -> tuple[str, str]:
    return house.path("closing"), f"table={name.replace('/', '-').replace('=', '-')}/p_dt={p_dt}"


def _close(house: Warehouse, name: str, p_dt: str, batch_id: int) -> None:
    schema, keys = _TABLES[name]
    root, mark = _mark(house, name, p_dt)
    staged, columns = f"{house.path('closed')}/{name}/p_dt={p_dt}", [c for c in schema.names if c != "p_dt"]
    marks = scan(house.spark, f"{root}/{mark}", _MARK)
    if marks.isEmpty():
        day = scan_day(house.spark, house.path(name), schema, p_dt)
        # One folder already, or none.
        if day.select("batch_id").distinct().limit(2).count() < 2:
            return
        rows = day.select(*columns).withColumn("batch_id", F.lit(batch_id).cast("long"))
        rows.hint("rebalance", *[F.col(k) for k in keys]).write.mode("overwrite").parquet(staged)
        replace_partition(house.spark.createDataFrame([(batch_id,)], _MARK), root, mark, sized=False)
    kept = house.spark.read.schema(T.StructType([schema[c] for c in columns])).parquet(staged)
    replace_day(kept, house.path(name), p_dt, *keys, "batch_id")
    replace_partition(_nothing(house, _MARK), root, mark, sized=False)
    # What was written beside the day is not needed any more.
    _nothing(house, kept.schema).write.mode("overwrite").parquet(staged)


def _nothing(house: Warehouse, schema: T.StructType) -> DataFrame:
    return house.spark.createDataFrame([], schema)


def _drop_runs(house: Warehouse, name: str, p_dt: str, run: str) -> None:
    """Leave only the given run of the day."""
    schema, _ = MERGEABLE[name]
    day = scan_day(house.spark, house.path(name), schema, p_dt, f"run={run}")
    others = scan_day(house.spark, house.path(name), schema, p_dt).select("run").distinct()
    for row in others.where(F.col("run") != run).collect():
        replace_partition(day.limit(0), house.path(name), f"p_dt={p_dt}/run={row['run']}", sized=False)
