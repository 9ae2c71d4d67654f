"""What the operators of this package share: stored tables, appended columns, shuffle widths."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallflow.session import scratch_dir


# Rows and bytes in one Arrow batch: texts are long, and a task holds a batch several times over. With its last text a batch stays
# below a megabyte, as a rule.
_BATCH_ROWS, _BATCH_BYTES = 1000, 15 << 16

_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, which need not have it installed. Done once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        archive = Path(tempfile.mkdtemp(prefix="mallflow-")) / f"{_PACKAGE.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(_PACKAGE.rglob("*.py")):
                out.write(path, path.relative_to(_PACKAGE.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)


def in_batches(
    frame: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """``mapInArrow`` with this package at hand in the tasks, in batches that suit long texts."""
    ship(frame.sparkSession)
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_BATCH_ROWS))
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(_BATCH_BYTES))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return frame.mapInArrow(task, schema)


def give_back() -> None:
    """Return freed memory to the system: Python workers are used again, and would keep the most that any task before has held."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


# Shuffle partitions that one task of a narrow table works on.
_NARROW = 8


def stored(frame: DataFrame, label: str, narrow: bool = False) -> DataFrame:
    """The frame written to the shared scratch folder and read back: cuts the lineage and survives a lost executor.

    ``narrow`` says that its rows are few and short beside the documents, so that fewer tasks, and files, will do.
    """
    path = scratch_dir(frame.sparkSession, label)
    rows = frame.coalesce(max(1, shuffle_width(frame.sparkSession) // _NARROW)) if narrow else frame
    rows.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores added until no column has it, whatever the case."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def add_in_batches(
    frame: DataFrame, name: str, kind: T.DataType, make: Callable[[pa.RecordBatch], pa.Array], drop: Iterable[str] = ()
) -> DataFrame:
    """Append a column that ``make`` computes from each Arrow batch, optionally leaving out some columns it has read."""
    gone = set(drop)
    kept = [f for f in frame.schema.fields if f.name not in gone]
    places = [i for i, f in enumerate(frame.schema.fields) if f.name not in gone]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = make(batch)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in places), made], [*(f.name for f in kept), name]
                )

    return in_batches(frame, work, T.StructType([*kept, T.StructField(name, kind)]))


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_key(column: str = "text"):
    """128-bit digest of a text, 16 bytes; null for a null text."""
    return F.unhex(F.md5(F.col(column).cast("binary")))
