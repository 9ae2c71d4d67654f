"""The mall job: each micro-batch of messages becomes stored pings, refreshed day tables and metric documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import Future
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mallflow.operators.clean import business_hours, clean_batch
from mallflow.operators.flow import batch_counts
from mallflow.operators.lookup import Dimensions
from mallflow.operators.visits import visit_summary
from mallflow.plans.changes import apply_changes
from mallflow.plans.documents import PRODUCTS, TRAILING, Snapshot, product_documents, trailing_documents
from mallflow.plans.runs import compacted, own_run
from mallflow.plans.warehouse import Warehouse
from mallflow.session import held, meanwhile, size_for, stored_bytes, together
from mallflow.sources.tables import replace_partitions, scan, scan_day, stamp
from mallflow.streaming.landing import land, messages_of

_RUN = T.StructType(
    [
        T.StructField("as_of", T.StringType()),
        T.StructField("dims_version", T.StringType()),
        # The runs of the day that the batch builds on, whether it adds one, and whether it makes the day anew instead.
        T.StructField("live", T.ArrayType(T.StringType())),
        T.StructField("adds", T.BooleanType()),
        T.StructField("rebuilds", T.BooleanType()),
        # The batch that the static tables were last stored with.
        T.StructField("dims_at", T.LongType()),
        # Date and number of the batches with failed steps that are still to be run again.
        T.StructField("pending", T.ArrayType(T.StringType())),
        T.StructField("batch_id", T.LongType()),
    ]
)
_OUTCOME = T.StructType(
    [
        T.StructField("step", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("detail", T.StringType()),
        # How often the step was run for the batch.
        T.StructField("tries", T.IntegerType()),
    ]
)
STATUS = T.StructType([*_OUTCOME.fields, T.StructField("p_dt", T.StringType()), T.StructField("batch_id", T.LongType())])


# A failed step is run this often at most, and a batch takes up at most this many earlier batches again, the oldest first; the others wait.
TRIES = 3
CATCH_UP = 4


def date_key(as_of: str) -> str:
    return as_of[:10].replace("-", "")


@dataclass(frozen=True)
class Run:
    """What is noted of a batch."""

    as_of: str
    dims_version: str
    live: list[str]
    adds: bool
    rebuilds: bool
    dims_at: int
    pending: list[str]
    batch_id: int

    @property
    def name(self) -> str:
        return f"{date_key(self.as_of)}/{self.batch_id}"

    @property
    def after(self) -> list[str]:
        """The runs of the day once the batch is done."""
        return [*self.live, own_run(self.batch_id)] if self.adds else list(self.live)


    def closed(self, run: str) -> Run:
        """The note of a day's last batch once all runs of the day are one."""
        return replace(self, live=[run], adds=False)


def noted_runs(house: Warehouse, *batch_ids: int) -> DataFrame:
    """The notes of all batches, or of some."""
    return scan(house.spark, house.path("runs"), _RUN, [f"batch_id={n}" for n in batch_ids] or None)


def note_run(house: Warehouse, run: Run) -> None:
    row = house.spark.createDataFrame([tuple(getattr(run, name) for name in _RUN.names)], _RUN)
    replace_partitions(row, house.path("runs"), "batch_id", sized=False)


@dataclass(frozen=True)
class MallJob:
    """``dimensions`` is read again for every batch. ``clock`` gives a batch's processing time as clock text; by default
    the session's current time. The checkpoint lies beside the tables: batch numbers are only unique together with it.
    """

    warehouse: Warehouse
    dimensions: Callable[[], Dimensions]
    clock: Callable[[int], str] | None = None
    products: Sequence[str] = tuple(PRODUCTS)
    links: bool = True
    # Names of the metrics over trailing windows that are kept as well.
    trailing: Sequence[str] = ()

    def start(self, lines: DataFrame, **trigger) -> StreamingQuery:
        return (
            lines.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", self.warehouse.path("checkpoint"))
            .trigger(**(trigger or {"processingTime": "60 seconds"}))
            .start()
        )

    def process(self, batch: DataFrame, batch_id: int) -> None:
        house = self.warehouse
        known = [self.dimensions, partial(self._run, batch_id), partial(self._run, batch_id - 1)]
        with meanwhile(house.spark, *known) as (dims, seen, before), messages_of(batch) as messages:
            if messages is None:
                self._skip(before.result(), batch_id)
                return
            size_for(house.spark, messages.size)
            dims = dims.result()
            run = self._open(batch_id, dims, seen.result(), before.result())
            p_dt = date_key(run.as_of)
            land(house, messages, p_dt, batch_id)

        raw = house.pings(p_dt, batch_id).drop("p_dt", "batch_id")
        with held(clean_batch(raw, dims)) as rt:
            if run.rebuilds:
                size_for(house.spark, stored_bytes(house.spark, f"{house.path('ods')}/p_dt={p_dt}"))
                house.rebuild(p_dt, dims, batch_id, self.links, bool(self.trailing))
                self._report(raw, rt, run)
            else:
                clean = business_hours(rt)
                walks = [partial(house.refresh_moves, clean, p_dt, batch_id)] if self.links else []
                # The moves take longest and only their own metric waits for them. If they fail, so does the batch.
                with meanwhile(house.spark, *walks) as moved:
                    house.refresh(clean, p_dt, batch_id, bool(self.trailing))
                    self._report(raw, rt, run, *moved)
                    for walk in moved:
                        walk.result()

    def _open(self, batch_id: int, dims: Dimensions, seen: Run | None, before: Run | None) -> Run:
        """Note the batch: its processing time, the runs of the day before it, and whether the day must be made anew.

        The note is written before any other output, so a batch that is run again after midnight keeps its date and builds on the
        same runs. Changes of the static tables since the batch before are worked into the day first. The day is made anew from its raw
        pings when a batch with changes, or with other static tables, is run again, when a part of the state was left out before, and when
        nothing is known of the batch before.
        """
        house = self.warehouse
        # What else the state of the day holds goes with the version: a part that was left out before is made from the raw pings.
        extras = "+".join(name for name, wanted in (("links", self.links), ("panes", self.trailing)) if wanted)
        version = f"{dims.version}#{extras}"
        as_of = seen.as_of if seen else self._now(batch_id)
        p_dt = date_key(as_of)
        same_day = before is not None and date_key(before.as_of) == p_dt
        changed = before is not None and before.dims_version != version
        alike = before is None or before.dims_version.split("#")[-1] == extras
        # A batch that was begun with other static tables has left rows of theirs.
        again = seen is not None and (seen.rebuilds or seen.dims_version != version)
        rebuilds = again or (before is None and batch_id > 0) or (same_day and not alike)
        dims_at = before.dims_at if before is not None and not changed else batch_id
        if dims_at == batch_id:
            house.keep_dimensions(dims, batch_id)
        pending = seen.pending if seen else self._pending(before)
        run = Run(as_of, version, [], True, rebuilds, dims_at, pending, batch_id)
        if rebuilds or not same_day:
            self._note(run)
        elif changed:
            # If this batch is run again, the day is made anew.
            self._note(replace(run, rebuilds=True))
            old = house.kept_dimensions(before.dims_at)
            live = apply_changes(house, p_dt, batch_id, before.after, old, dims, self.links, bool(self.trailing))
            run = replace(run, live=live)
            self._note(replace(run, rebuilds=True))
        else:
            run = replace(run, live=self._merged(before, p_dt))
            self._note(run)
        return run

    def _merged(self, before: Run, p_dt: str) -> list[str]:
        """The runs after a batch, full levels put together."""
        live, merges = compacted(before.after)
        self.warehouse.merge(p_dt, merges)
        return live

    def _skip(self, before: Run | None, batch_id: int) -> None:
        """Hand the note of the batch before on, so that a change of the static tables is still seen by the next batch."""
        if before is not None:
            pending = self._pending(before)
            self._note(replace(before, live=before.after, adds=False, rebuilds=False, pending=pending, batch_id=batch_id))

    def _run(self, batch_id: int) -> Run | None:
        row = noted_runs(self.warehouse, batch_id).first()
        return Run(**row.asDict()) if row else None

    def _note(self, run: Run) -> None:
        note_run(self.warehouse, run)

    def _now(self, batch_id: int) -> str:
        if self.clock is not None:
            return self.clock(batch_id)
        now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
        return self.warehouse.spark.range(1).select(now.alias("now")).first()["now"]

    def _seconds(self, as_of: str) -> int:
        """Clock text of the session's zone as epoch seconds."""
        return self.warehouse.spark.range(1).select(F.unix_timestamp(F.lit(as_of)).alias("t")).first()["t"]

    def _steps(self, raw: DataFrame, state: Snapshot, run: Run) -> dict[str, Callable[[], str | None]]:
        """What is done for a batch, each on its own."""
        metrics, p_dt = self.warehouse.metrics, date_key(run.as_of)

        def count() -> str:
            row = batch_counts(raw, state.rt).first()
            return f"raw={row['raw_rows']} clean={row['clean_rows']}"

        def store(bi_name: str) -> None:
            documents = product_documents(bi_name, state, run.as_of)
            put = metrics.append if PRODUCTS[bi_name].appends else metrics.replace
            put(documents, bi_name, p_dt, run.batch_id)

        names = [bi_name for bi_name in self.products if self.links or bi_name != "brand_link"]
        def store_trailing(bi_name: str) -> None:
            seen = self.warehouse.trailing(p_dt, self._seconds(run.as_of), TRAILING[bi_name].seconds)
            metrics.replace(trailing_documents(bi_name, seen, run.as_of), bi_name, p_dt, run.batch_id)

        steps = {"batch_counts": count} | {bi_name: partial(store, bi_name) for bi_name in names}
        return steps | {bi_name: partial(store_trailing, bi_name) for bi_name in self.trailing}

    def _outcomes(self, steps: dict[str, Callable[[], str | None]], tries: int = 1) -> list[tuple]:
        """A failing step is recorded and does not stop the others."""

        def outcome(name: str, step: Callable[[], str | None]) -> tuple[str, bool, str | None, int]:
            try:
                return name, True, step(), tries
            except Exception as error:  # noqa: BLE001 - recorded, not hidden
                return name, False, str(error), tries

        return together(self.warehouse.spark, *[partial(outcome, name, step) for name, step in steps.items()])

    def _record(self, outcomes: list[tuple], name: str) -> None:
        p_dt, batch_id = name.split("/")
        spark = self.warehouse.spark
        rows = stamp(spark.createDataFrame(outcomes, _OUTCOME).coalesce(1), p_dt, int(batch_id))
        replace_partitions(rows, self.warehouse.path("status"), "p_dt", "batch_id", sized=False)

    def _report(self, raw: DataFrame, rt: DataFrame, run: Run, *waits: Future[None]) -> None:
        """Refresh every metric, that of the moves after ``waits``, then run again what failed for earlier batches."""
        with self._snapshot(rt, run, *waits) as state:
            self._record(self._outcomes(self._steps(raw, state, run)), run.name)
        for name in run.pending[:CATCH_UP]:
            self._again(name)

    @contextmanager
    def _snapshot(self, rt: DataFrame, run: Run, *waits: Future[None]) -> Iterator[Snapshot]:
        """What the metrics of a batch read; the day's visits are held in memory."""
        house, p_dt = self.warehouse, date_key(run.as_of)

        def pairs() -> DataFrame:
            for wait in waits:
                wait.result()
            return house.pairs(p_dt)

        # The day's visits are merged over the runs once for all day metrics. They are dealt by device, so that what is counted or timed
        # by device stays in its task; a device has a row for each cell and shop of each run at most, however many pings it sent.
        with held(visit_summary(house.visits(p_dt, run.after).repartition("mac"))) as day:
            yield Snapshot(rt, day, house.minutes(p_dt, run.after), pairs)

    # --- catching up ---

    def _failed(self, names: Sequence[str]) -> DataFrame:
        """Steps of some batches that are to be run again: those that no later batch makes up for."""
        once = [step for step in ("batch_counts", *self.products) if step not in PRODUCTS or PRODUCTS[step].appends]
        below = ["p_dt={}/batch_id={}".format(*name.split("/")) for name in names]
        rows = scan(self.warehouse.spark, self.warehouse.path("status"), STATUS, below)
        return rows.where(~F.col("ok") & F.col("step").isin(once) & (F.col("tries") < TRIES))

    def _pending(self, before: Run | None) -> list[str]:
        """Batches up to the one before that have failed steps."""
        if before is None:
            return []
        names = [*before.pending, before.name]
        left = {f"{row['p_dt']}/{row['batch_id']}" for row in self._failed(names).select("p_dt", "batch_id").distinct().collect()}
        return [name for name in dict.fromkeys(names) if name in left]

    def _again(self, name: str) -> None:
        """Run the failed steps of an earlier batch on what that batch had: its pings, static tables and runs of the day."""
        house = self.warehouse
        p_dt, number = name.split("/")
        run = self._run(int(number))
        failed = {row["step"]: row["tries"] for row in self._failed([name]).collect()}
        below = [f"p_dt={p_dt}/batch_id={number}"]
        rows = scan(house.spark, house.path("status"), STATUS, below).select(*_OUTCOME.names).collect()
        raw = house.pings(p_dt, run.batch_id).drop("p_dt", "batch_id")
        with self._snapshot(clean_batch(raw, house.kept_dimensions(run.dims_at)), run) as state:
            steps = {step: run_it for step, run_it in self._steps(raw, state, run).items() if step in failed}
            done = self._outcomes(steps, max(failed.values(), default=0) + 1)
        self._record([tuple(row) for row in rows if row["step"] not in steps] + done, name)

    def status(self, p_dt: str) -> DataFrame:
        return scan_day(self.warehouse.spark, self.warehouse.path("status"), STATUS, p_dt)
