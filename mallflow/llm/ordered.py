"""Places and digests along groups of any size: nothing here gathers a group in memory."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallflow.llm.frames import fresh, in_batches, stored


def _differ(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Where two columns differ; two nulls do not."""
    unequal = pc.fill_null(pc.not_equal(a, b), False)
    return np.asarray(pc.or_(unequal, pc.xor(pc.is_null(a), pc.is_null(b))))


def _numbered(at: int, names: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = batch.column(at)
            new = np.ones(n, dtype=bool)
            new[1:] = _differ(key.slice(1), key.slice(0, n - 1))
            if last is not None:
                new[0] = _differ(key.slice(0, 1), last)[0]
            row = np.arange(n)
            first = np.maximum.accumulate(np.where(new, row, -1))
            place = np.where(first < 0, row + 1 + count, row - first + 1)
            last, count = key.slice(n - 1, 1), int(place[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64()), pa.array(np.full(n, task), pa.int32())], names)

    return work


def with_places(frame: DataFrame, group: str, order: list[str], name: str, label: str) -> DataFrame:
    """``frame`` with the place (from 1) of each row in its ``group``, by the columns of ``order``, nulls first.

    The rows are range-partitioned by group and order, equal rows too, so a group of any size is spread over tasks. Each task
    numbers its own rows; a group that goes on in the next task gets the number of its rows before, one row for each task at most.
    """
    salt, local, task = (fresh([*frame.columns, name], n) for n in ("salt", "local", "task"))
    keys = [group, *order, salt]
    ranged = frame.withColumn(salt, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop(salt)
    schema = T.StructType([*frame.schema.fields, T.StructField(local, T.LongType()), T.StructField(task, T.IntegerType())])
    rows = stored(in_batches(ranged, _numbered(frame.columns.index(group), schema.names), schema), label)
    spans = rows.groupBy(group, task).agg(F.max(local).alias("n"))
    before = Window.partitionBy(group).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    ahead = spans.select(F.col(group).alias("group_"), F.col(task).alias("task_"), F.sum("n").over(before).alias("ahead_"))
    # A task can only go on with the group that the task before it ended in.
    ahead = F.broadcast(stored(ahead.where("ahead_ > 0"), f"{label}-ahead", narrow=True))
    found = rows.join(ahead, F.col(group).eqNullSafe(F.col("group_")) & (F.col(task) == F.col("task_")), "left")
    return found.withColumn(name, F.col(local) + F.coalesce("ahead_", F.lit(0))).select(*frame.columns, name)


def joined_digest(pieces: DataFrame, keys: list[str], order: list[str], piece: str, name: str, separator: str) -> DataFrame:
    """One row for each ``keys``: the SHA-256 of its pieces in order, with ``separator`` between them, as lower-case hex.

    A digest is taken from front to back, so a group's pieces go through one task, one at a time.
    """
    rows = pieces.select(*keys, *[c for c in order if c not in keys], piece).repartition(*[F.col(k) for k in keys])
    rows = rows.sortWithinPartitions(*keys, *order).select(*keys, piece)
    schema = T.StructType([*[pieces.schema[k] for k in keys], T.StructField(name, T.StringType())])
    kinds, between = [None] * len(keys), separator.encode()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done: list[tuple] = []
            columns = [batch.column(i).to_pylist() for i in range(len(keys))]
            for key, text in zip(zip(*columns), batch.column(len(keys)).to_pylist()):
                if state is None or key != now:
                    if state is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(between + text.encode())
            kinds[:] = [batch.schema.field(i).type for i in range(len(keys))]
            if done:
                yield _batch(done, kinds, schema.names)
        if state is not None:
            yield _batch([(*now, state.hexdigest())], kinds, schema.names)

    return in_batches(rows, work, schema)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), [*kinds, pa.string()])]
    return pa.RecordBatch.from_arrays(arrays, names)
