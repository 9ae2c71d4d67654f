"""A changed shop map or blacklist worked into the day, without washing all of it again.

Both versions are compared by key. Only pings of changed cells and changed devices are cleaned again; they take the place of the old ones in
the partitions that hold some, in the visits, in the minutes they fall into and in the paths of their devices. Raw pings are passed
over once to find them. Partitions, minutes and hours without such a ping stay as they are.

What is replaced here depends on what was there before, so it is done once: a batch that is run again after a change makes the day
anew from the raw pings (:meth:`Warehouse.rebuild`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mallflow.operators import floors, links
from mallflow.operators.clean import business_hours, clean_batch
from mallflow.operators.lookup import Dimensions
from mallflow.operators.panes import pane_summary
from mallflow.operators.visits import visit_summary
from mallflow.plans.runs import merged_run
from mallflow.plans.warehouse import DW, RECORDS, SIGHTINGS, Warehouse, slot_of
from mallflow.session import together
from mallflow.sources.tables import replace_partition, replace_partitions, scan

_CELL = ["posx", "posy", "floor"]


@dataclass(frozen=True)
class Changes:
    """Keys whose rows differ between two versions: cells (``posx``, ``posy``, ``floor``) and devices (``mac``)."""

    cells: DataFrame
    macs: DataFrame

    def hit(self, pings: DataFrame) -> DataFrame:
        """The rows of changed cells or devices."""
        return self._marked(pings, lambda cell, mac: cell | mac)

    def missed(self, pings: DataFrame) -> DataFrame:
        """All other rows."""
        return self._marked(pings, lambda cell, mac: ~(cell | mac))

    def _marked(self, pings: DataFrame, condition: Callable[[Column, Column], Column]) -> DataFrame:
        cells = self.cells.select(*[F.col(c).alias(f"c_{c}") for c in _CELL], F.lit(True).alias("c_hit"))
        macs = self.macs.select(F.col("mac").alias("c_mac"), F.lit(True).alias("m_hit"))
        cell = (pings["posX"] == cells["c_posx"]) & (pings["posY"] == cells["c_posy"]) & (pings["locName"] == cells["c_floor"])
        marked = pings.join(cells, cell, "left").join(macs, pings["mac"] == macs["c_mac"], "left")
        no = F.lit(False)
        return marked.where(condition(F.coalesce("c_hit", no), F.coalesce("m_hit", no))).select(*[pings[c] for c in pings.columns])


def dimension_changes(old: Dimensions, new: Dimensions) -> Changes:
    """Cells whose map rows differ in number or content, and devices that are on one list only. Null keys match no ping."""

    def summed(shops: DataFrame, label: str) -> DataFrame:
        marked = [c for name in ("name", "type") for c in (F.col(name).isNull(), F.col(name))]
        digest = F.sum(F.xxhash64(*marked).cast("decimal(38,0)")).alias(f"digest_{label}")
        return shops.dropna(subset=_CELL).groupBy(*_CELL).agg(F.count(F.lit(1)).alias(f"n_{label}"), digest)

    cells = summed(old.shops, "old").join(summed(new.shops, "new"), _CELL, "full")
    same = F.col("n_old").eqNullSafe(F.col("n_new")) & F.col("digest_old").eqNullSafe(F.col("digest_new"))
    lists = [d.blacklist.dropna().select("mac").distinct() for d in (old, new)]
    macs = lists[0].select("mac", F.lit(1).alias("side")).unionByName(lists[1].select("mac", F.lit(2).alias("side")))
    once = macs.groupBy("mac").agg(F.count(F.lit(1)).alias("n")).where("n = 1")
    return Changes(cells.where(~same).select(*_CELL), once.select("mac"))


def _stored(frame: DataFrame, path: str) -> DataFrame:
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def apply_changes(
    house: Warehouse, p_dt: str, batch_id: int, live: Sequence[str], old: Dimensions, new: Dimensions, moves: bool = True, panes: bool = False
) -> list[str]:
    """Bring the day up to, but without, the given batch from ``old`` to ``new``. Returns the runs that are live then."""
    spark: SparkSession = house.spark
    work = f"{house.path('changes')}/batch_id={batch_id}"
    found = dimension_changes(old, new)
    changes = Changes(_stored(found.cells, f"{work}/cells"), _stored(found.macs, f"{work}/macs"))
    raw = business_hours(house.pings(p_dt).where(F.col("batch_id") < batch_id)).drop("p_dt")
    hit = _stored(changes.hit(raw), f"{work}/hit")
    # At most one row for each hour and batch, and one for each minute of the day.
    touched = [tuple(row) for row in hit.select("dt_hour", "batch_id").distinct().collect()]
    if not touched:
        return list(live)
    slots = [row[0] for row in hit.select(slot_of()).distinct().collect()]
    hours = sorted({hour for hour, _ in touched})
    fresh = _stored(clean_batch(hit, new), f"{work}/fresh")

    before = house.clean_parts(p_dt, touched)
    rows = _stored(changes.missed(before).unionByName(fresh.withColumn("p_dt", F.lit(p_dt)).select(*DW.names)), f"{work}/dw")
    replace_partitions(rows, house.path("dw"), "p_dt", "dt_hour", "batch_id")
    left = {tuple(row) for row in rows.select("dt_hour", "batch_id").distinct().collect()}
    for hour, batch in sorted(set(touched) - left):
        replace_partition(rows.limit(0), house.path("dw"), f"p_dt={p_dt}/dt_hour={hour}/batch_id={batch}")

    run = merged_run(batch_id - 1)
    steps = [
        partial(_visits, house, p_dt, live, changes, fresh, run),
        partial(_minutes, house, p_dt, batch_id, live, hours, slots, run),
    ]
    if moves:
        steps.append(partial(_moves, house, p_dt, batch_id, hit, hours))
    if panes:
        steps.append(partial(_panes, house, p_dt, batch_id, changes, fresh, hours))
    together(spark, *steps)
    return [run]


def _visits(house: Warehouse, p_dt: str, live: Sequence[str], changes: Changes, fresh: DataFrame, run: str) -> None:
    kept = changes.missed(visit_summary(house.visits(p_dt, live)))
    house.put_run(kept.unionByName(visit_summary(fresh)), "visits", p_dt, run)


def _panes(house: Warehouse, p_dt: str, batch_id: int, changes: Changes, fresh: DataFrame, hours: Sequence[int]) -> None:
    kept = changes.missed(house.panes(p_dt, hours).drop("p_dt", "batch_id"))
    rows = _stored(kept.unionByName(pane_summary(fresh, "dt_hour")), f"{house.path('changes')}/batch_id={batch_id}/panes")
    put = partial(_replace_below, house.path("panes"), p_dt, "dt_hour", batch_id - 1)
    together(house.spark, *[partial(put, hour, rows.where(F.col("dt_hour") == hour)) for hour in hours])


def _minutes(
    house: Warehouse, p_dt: str, batch_id: int, live: Sequence[str], hours: Sequence[int], slots: Sequence[int], run: str
) -> None:
    work = f"{house.path('changes')}/batch_id={batch_id}"
    again = house.clean_pings(p_dt, *hours).where(slot_of().isin(*slots) & (F.col("batch_id") < batch_id))
    made = floors.minute_records(again).withColumn("slot", slot_of())
    below = [f"dt_hour={hour}" for hour in hours]
    rest = scan(house.spark, house.path("records"), RECORDS, [f"p_dt={p_dt}/{part}" for part in below]).where(~F.col("slot").isin(*slots))
    made = _stored(made, f"{work}/made")
    records = _stored(rest.drop("p_dt", "batch_id").unionByName(made), f"{work}/records")
    put = partial(_replace_below, house.path("records"), p_dt, "dt_hour", batch_id - 1)
    together(house.spark, *[partial(put, hour, records.where(F.col("dt_hour") == hour)) for hour in hours])
    kept = house.minutes(p_dt, live).where(~slot_of().isin(*slots))
    house.put_run(kept.unionByName(floors.minute_counts(made)), "minutes", p_dt, run)


def _moves(house: Warehouse, p_dt: str, batch_id: int, hit: DataFrame, hours: Sequence[int]) -> None:
    work = f"{house.path('changes')}/batch_id={batch_id}"
    devices = _stored(hit.where(F.col("mac").isNotNull()).select(links.part_of().alias("part"), "mac").distinct(), f"{work}/devices")
    parts = [row["part"] for row in devices.select("part").distinct().collect()]
    clean = house.clean_pings(p_dt, *hours).where(F.col("batch_id") < batch_id)
    again = links.sightings(clean).join(devices, ["part", "mac"], "left_semi")
    rest = scan(house.spark, house.path("sightings"), SIGHTINGS, [f"p_dt={p_dt}/part={part}" for part in parts])
    rest = rest.drop("batch_id").distinct().join(devices, ["part", "mac"], "left_anti")
    sightings = _stored(rest.unionByName(again), f"{work}/sightings")
    put = partial(_replace_below, house.path("sightings"), p_dt, "part", batch_id - 1)
    together(house.spark, *[partial(put, part, sightings.where(F.col("part") == part)) for part in parts])
    house.walk(p_dt, sightings, parts, fewer=True)


def _replace_below(root: str, p_dt: str, key: str, batch_id: int, value: object, rows: DataFrame) -> None:
    """Everything stored of one hour, as if it had come with one batch."""
    path = f"{root}/p_dt={p_dt}/{key}={value}"
    stamped = rows.drop("p_dt", key).withColumn("batch_id", F.lit(batch_id).cast("long"))
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch_id").parquet(path)
