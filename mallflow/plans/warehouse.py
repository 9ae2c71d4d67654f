"""The day's tables and how a batch of pings moves through them.

A batch is worked into the day without reading the pings of other batches:

* *visits* (pings, first and last second by cell, shop and device) and *minutes* (distinct records by floor and minute) are partial
  aggregates, one run per batch (:mod:`mallflow.plans.runs`). They add up to the day, and runs are merged level by level.
* *records* are the digests of the records that are counted in ``minutes``, by event hour and batch. A batch is compared with those
  of its own minutes, and only digests that are new are stored and counted, so counts of batches are of disjoint sets.
* *sightings* are the distinct (device, second, shop) by event hour and batch. Only the hours that a batch touches are walked again:
  their inner moves, the first and last sighting of each device (*edges*) and the moves by pair (*pairs*) take the place of the
  old ones. Moves from hour to hour come from the edges of the whole day, at most two rows per device and hour, and are a partition
  of their own. The files of an untouched hour stay as they are.

Every write replaces whole partitions named by the batch or the hour, so a batch that is run again gives the same tables. A batch's
row of the runs says which runs it builds on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallflow.operators import floors, links
from mallflow.operators.clean import wash_day
from mallflow.operators.lookup import Dimensions, load_dimensions
from mallflow.operators.panes import pane_summary, trailing_panes
from mallflow.operators.visits import visit_summary
from mallflow.plans.runs import Merge, own_run
from mallflow.schema import BLACKLIST, CLEAN_PING, LINK, PING, SHOP, VISIT, with_keys
from mallflow.session import held, together
from mallflow.sources.ledger import Ledger
from mallflow.sources.metrics import MetricStore
from mallflow.sources.tables import append_batch, replace_day, replace_partition, replace_partitions, scan_day, stamp

_P_DT = ("p_dt", T.StringType())
_HOUR = ("dt_hour", T.IntegerType())
_BATCH = ("batch_id", T.LongType())
_RUN = ("run", T.StringType())
_PART = ("part", T.StringType())


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_TEXT, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()

ODS = with_keys(PING, _P_DT, _BATCH)
DW = with_keys(CLEAN_PING, _P_DT, _HOUR, _BATCH)
DEAD = _table(("value", _TEXT), _P_DT, _BATCH)
VISITS = with_keys(VISIT, _P_DT, _RUN)
MINUTES = _table(("locName", _TEXT), _HOUR, ("dt_min", _INT), ("cnt", _LONG), _P_DT, _RUN)
RECORDS = _table(("locName", _TEXT), ("dt_min", _INT), ("slot", _INT), ("d1", _LONG), ("d2", _LONG), _P_DT, _HOUR, _BATCH)
SIGHTINGS = _table(("mac", _TEXT), ("time_stamp", _INT), ("date_time", _TEXT), ("name", _TEXT), _P_DT, _PART, _BATCH)
EDGES = _table(
    ("mac", _TEXT),
    ("time_stamp", _INT),
    ("date_time", _TEXT),
    ("to_name", _TEXT),
    ("opens", T.BooleanType()),
    ("closes", T.BooleanType()),
    _P_DT,
    _PART,
)
PANES = with_keys(
    T.StructType([T.StructField("pane", _INT), *[f for f in VISIT.fields if f.name != "pings"]]), _P_DT, _HOUR, _BATCH
)
LINKS = with_keys(LINK, _P_DT, _PART)
PAIRS = _table(("from_name", _TEXT), ("to_name", _TEXT), ("times", _LONG), _P_DT, _PART)

# The partition of the moves from one hour to another.
BETWEEN = links.BETWEEN


def slot_of() -> Column:
    """The minute of the day."""
    return F.col("dt_hour") * 60 + F.col("dt_min")


# Tables of runs, and how runs are merged.
MERGEABLE: dict[str, tuple[T.StructType, Callable[[DataFrame], DataFrame]]] = {
    "visits": (VISITS, visit_summary),
    "minutes": (MINUTES, floors.merged_minutes),
}


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def metrics(self) -> MetricStore:
        return MetricStore(self.spark, self.path("metrics"))

    @property
    def ledger(self) -> Ledger:
        return Ledger(self.spark, self.path("ledger"))

    def _day(self, name: str, schema: T.StructType, p_dt: str, *below: str) -> DataFrame:
        return scan_day(self.spark, self.path(name), schema, p_dt, *below)

    # --- raw and clean pings ---

    def append_pings(self, pings: DataFrame, p_dt: str, batch_id: int) -> None:
        """Store a batch's raw pings, one file per task."""
        append_batch(pings, self.path("ods"), p_dt, batch_id, sized=False)

    def append_dead_letters(self, lines: DataFrame, p_dt: str, batch_id: int) -> None:
        append_batch(lines, self.path("dead_letters"), p_dt, batch_id, sized=False)

    def dead_letters(self, p_dt: str) -> DataFrame:
        return self._day("dead_letters", DEAD, p_dt)

    def pings(self, p_dt: str, *batch_ids: int) -> DataFrame:
        """Raw pings of a processing date, or of some of its batches."""
        return self._day("ods", ODS, p_dt, *[f"batch_id={batch_id}" for batch_id in batch_ids])

    def clean_pings(self, p_dt: str, *hours: int) -> DataFrame:
        """Clean pings of a processing date, or of some event hours of it."""
        return self._day("dw", DW, p_dt, *[f"dt_hour={hour}" for hour in hours])

    def clean_parts(self, p_dt: str, parts: Iterable[tuple[int, int]]) -> DataFrame:
        """Clean pings of some event hours and batches."""
        return self._day("dw", DW, p_dt, *[f"dt_hour={hour}/batch_id={batch_id}" for hour, batch_id in parts])

    def rewash(self, p_dt: str, dims: Dimensions) -> None:
        """Clean the whole day again from its raw pings, for a changed shop map or blacklist."""
        replace_day(wash_day(self.pings(p_dt), dims), self.path("dw"), p_dt, "dt_hour", "batch_id")

    # --- static tables ---

    def keep_dimensions(self, dims: Dimensions, batch_id: int) -> None:
        """Store the static tables that a batch is the first to be cleaned with."""
        for name in ("shops", "blacklist"):
            getattr(dims, name).write.mode("overwrite").parquet(self.path(f"dims/batch_id={batch_id}/{name}"))

    def kept_dimensions(self, batch_id: int) -> Dimensions:
        read = [
            self.spark.read.schema(schema).parquet(self.path(f"dims/batch_id={batch_id}/{name}"))
            for name, schema in (("shops", SHOP), ("blacklist", BLACKLIST))
        ]
        return load_dimensions(*read)

    # --- the day's state ---

    def refresh(self, clean: DataFrame, p_dt: str, batch_id: int, panes: bool = False) -> None:
        """Work a batch's clean pings of the business hours into the day, but for the moves. They are read several times."""
        clean = clean.drop("p_dt", "batch_id")
        steps = [
            lambda: append_batch(clean, self.path("dw"), p_dt, batch_id, "dt_hour"),
            partial(self._add_visits, clean, p_dt, batch_id),
            partial(self._add_minutes, clean, p_dt, batch_id, whole_day=False),
        ]
        if panes:
            steps.append(partial(self._add_panes, clean, p_dt, batch_id, whole_day=False))
        together(self.spark, *steps)

    def refresh_moves(self, clean: DataFrame, p_dt: str, batch_id: int) -> None:
        self._add_moves(clean.drop("p_dt", "batch_id"), p_dt, batch_id, whole_day=False)

    def rebuild(self, p_dt: str, dims: Dimensions, batch_id: int, moves: bool = True, panes: bool = False) -> None:
        """Clean the whole day again and make its state anew, as if all of it had come with this batch."""
        self.rewash(p_dt, dims)
        clean = self.clean_pings(p_dt).drop("p_dt", "batch_id")
        steps = [
            partial(self._add_visits, clean, p_dt, batch_id),
            partial(self._add_minutes, clean, p_dt, batch_id, whole_day=True),
        ]
        if moves:
            steps.append(partial(self._add_moves, clean, p_dt, batch_id, whole_day=True))
        if panes:
            steps.append(partial(self._add_panes, clean, p_dt, batch_id, whole_day=True))
        together(self.spark, *steps)

    def merge(self, p_dt: str, merges: Sequence[Merge]) -> None:
        """Put runs together. The old ones stay until the day is closed, for readers that still hold them."""
        for merge in merges:
            together(self.spark, *[partial(self._merge, name, p_dt, merge) for name in MERGEABLE])

    def _merge(self, name: str, p_dt: str, merge: Merge) -> None:
        _, merged = MERGEABLE[name]
        self.put_run(merged(self._runs(name, p_dt, merge.runs)), name, p_dt, merge.into)

    def put_run(self, frame: DataFrame, name: str, p_dt: str, run: str) -> None:
        """Store a run of a mergeable table; the same run written again takes its own place."""
        # Its rows come out of an aggregation, whose partitions the adaptive planner has already sized.
        replace_partition(frame, self.path(name), f"p_dt={p_dt}/run={run}", sized=False)

    def _runs(self, name: str, p_dt: str, runs: Iterable[str]) -> DataFrame:
        schema, _ = MERGEABLE[name]
        below = [f"run={run}" for run in runs]
        return self._day(name, schema, p_dt, *below) if below else self.spark.createDataFrame([], schema)

    def _put(self, frame: DataFrame, name: str, p_dt: str, *keys: str, whole_day: bool, order: Sequence[str] = ()) -> None:
        if whole_day:
            replace_day(frame, self.path(name), p_dt, *keys, order=order)
        else:
            replace_partitions(frame.withColumn("p_dt", F.lit(p_dt)), self.path(name), "p_dt", *keys, order=order)

    def _add_visits(self, clean: DataFrame, p_dt: str, batch_id: int) -> None:
        self.put_run(visit_summary(clean), "visits", p_dt, own_run(batch_id))

    # --- panes ---

    def _add_panes(self, clean: DataFrame, p_dt: str, batch_id: int, whole_day: bool) -> None:
        made = stamp(pane_summary(clean, "dt_hour"), p_dt, batch_id)
        # In order of time, so that a reader of a window passes over the rest of a file.
        self._put(made, "panes", p_dt, "dt_hour", "batch_id", whole_day=whole_day, order=["pane"])

    def panes(self, p_dt: str, hours: Iterable[int]) -> DataFrame:
        return self._day("panes", PANES, p_dt, *[f"dt_hour={hour}" for hour in hours])

    def trailing(self, p_dt: str, as_of: int, seconds: int) -> DataFrame:
        """What was seen in the ``seconds`` up to the epoch second ``as_of``, from the panes of the hours that these fall into."""
        places = f"concat(sequence({as_of - seconds + 1}, {as_of}, 3600), array({as_of}))"
        hours = self.spark.sql(f"SELECT DISTINCT hour(timestamp_seconds(t)) AS h FROM (SELECT explode({places}) AS t)").collect()
        return trailing_panes(self.panes(p_dt, [row["h"] for row in hours]), as_of, seconds)

    # --- minutes ---

    def _add_minutes(self, clean: DataFrame, p_dt: str, batch_id: int, whole_day: bool) -> None:
        """Store the digests that no earlier batch of the day had in these minutes, and count them."""
        records = stamp(floors.minute_records(clean).withColumn("slot", slot_of()), p_dt, batch_id)
        # At most one for each minute of the day.
        slots = [] if whole_day else [row["slot"] for row in clean.select(slot_of().alias("slot")).distinct().collect()]
        if slots:
            hours = sorted({value // 60 for value in slots})
            records = self._unseen(records, self._records(p_dt, hours).where(F.col("batch_id") != batch_id), slots)
        with held(records) as records:
            # In order of time, so that a reader of some minutes passes over the rest of a file.
            put = partial(self._put, records, "records", p_dt, "dt_hour", "batch_id", whole_day=whole_day, order=["slot"])
            count = partial(self.put_run, floors.minute_counts(records), "minutes", p_dt, own_run(batch_id))
            together(self.spark, put, count)

    def _records(self, p_dt: str, hours: Iterable[int]) -> DataFrame:
        return self._day("records", RECORDS, p_dt, *[f"dt_hour={hour}" for hour in hours])

    @staticmethod
    def _unseen(records: DataFrame, earlier: DataFrame, slots: Sequence[int]) -> DataFrame:
        keys = ["locName", "dt_hour", "dt_min", "d1", "d2"]
        old = earlier.where(F.col("slot").between(min(slots), max(slots)) & F.col("slot").isin(*slots))
        old = old.select(*[F.col(c).alias(f"old_{c}") for c in keys])
        same = [F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in keys]
        return records.join(old, same[0] & same[1] & same[2] & same[3] & same[4], "left_anti")

    # --- moves ---

    def _add_moves(self, clean: DataFrame, p_dt: str, batch_id: int, whole_day: bool) -> None:
        """Store the sightings, walk the touched hours again, and tie the hours of the day together."""
        seen = stamp(links.sightings(clean.withColumn("p_dt", F.lit(p_dt))), p_dt, batch_id)
        put = partial(self._put, seen, "sightings", p_dt, "part", "batch_id", whole_day=whole_day)
        # One row for each clock hour that the batch's events fall on.
        touched = clean.select(links.hour_of_sighting().alias("part")).where("part is not null").distinct()
        rows, _ = together(self.spark, touched.collect, put)
        parts = None if whole_day else sorted(row["part"] for row in rows)
        if parts is not None and not parts:
            return
        folded = self._day("sightings", SIGHTINGS, p_dt, *[f"part={part}" for part in parts or ()])
        # A sighting may have come with several batches.
        self.walk(p_dt, folded.drop("batch_id").distinct(), parts)

    def walk(self, p_dt: str, sightings: DataFrame, parts: Sequence[str] | None, fewer: bool = False) -> None:
        """Make the moves of some clock hours, or of the whole day, from all their distinct sightings, and those between the hours.

        ``fewer`` says that the hours may have lost sightings, and with them all their moves.
        """
        with held(links.steps_of(sightings)) as steps:
            inner = links.hour_links(steps)
            derived = {"edges": links.edges(steps), "links": inner, "pairs": links.pair_counts(inner, "part")}
            put = [partial(self._put, frame, name, p_dt, "part", whole_day=parts is None) for name, frame in derived.items()]
            together(self.spark, *put)
            if fewer:
                self._clear(p_dt, parts, steps, inner)
        between = links.edge_links(self._day("edges", EDGES, p_dt))
        replace_partition(between, self.path("links"), f"p_dt={p_dt}/part={BETWEEN}")

    def _clear(self, p_dt: str, parts: Sequence[str], steps: DataFrame, inner: DataFrame) -> None:
        """Empty what the hours had before and have no more."""
        seen, moved = ({row["part"] for row in frame.select("part").distinct().collect()} for frame in (steps, inner))
        gone = [("edges", EDGES, part) for part in sorted(set(parts) - seen)]
        gone += [(name, schema, part) for name, schema in (("links", LINKS), ("pairs", PAIRS)) for part in sorted(set(parts) - moved)]
        for name, schema, part in gone:
            old = self._day(name, schema, p_dt, f"part={part}")
            if not old.isEmpty():
                replace_partition(self.spark.createDataFrame([], schema), self.path(name), f"p_dt={p_dt}/part={part}")

    def links(self, p_dt: str) -> DataFrame:
        return self._day("links", LINKS, p_dt).drop("part")

    def pairs(self, p_dt: str) -> DataFrame:
        """Moves of the day per shop pair: those inside the hours as they were counted, those between hours counted now."""
        between = links.pair_counts(self._day("links", LINKS, p_dt, f"part={BETWEEN}"))
        return self._day("pairs", PAIRS, p_dt).drop("p_dt", "part").unionByName(between)

    # --- what the metrics read ---

    def visits(self, p_dt: str, runs: Iterable[str]) -> DataFrame:
        """Visit rows of the day; the day metrics merge them."""
        return self._runs("visits", p_dt, runs)

    def minutes(self, p_dt: str, runs: Iterable[str]) -> DataFrame:
        return floors.merged_minutes(self._runs("minutes", p_dt, runs))
