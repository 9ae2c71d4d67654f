"""Session settings and the shared scratch location."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from functools import lru_cache
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

_SETTINGS = {
    # Coalesces small shuffle partitions, swaps in broadcast joins by measured size and splits skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splits them also where a later step would have used the join's partitioning: a hot device must not fill one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# What one shuffle partition should hold at the start, and the most partitions and scan tasks an input is cut into: beyond these,
# tasks grow instead, since the driver keeps books on every one of them.
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 20_000
MAX_SCAN_TASKS = 100_000
_SPLIT = "spark.sql.files.maxPartitionBytes"
_CONCURRENT_ACTIONS = 12


def configure(spark: SparkSession, zone: str = "UTC") -> SparkSession:
    """Apply the runtime settings every query relies on. Clock text and processing dates are read in ``zone``."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of the files at or below the paths, from their listing; contents are not read. No such path: 0."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("size")).first()["size"]


def _bytes(text: str) -> int:
    """A size setting such as ``16m`` or ``134217728b`` in bytes."""
    number = text.strip().lower().removesuffix("b")
    for place, unit in enumerate("kmgt", start=1):
        if number.endswith(unit):
            return int(number[:-1]) << 10 * place
    return int(number)


@lru_cache(maxsize=4)
def _own_split(spark: SparkSession) -> int:
    """The session's scan split as it was before any query was sized."""
    return _bytes(spark.conf.get(_SPLIT))


def size_for(
    spark: SparkSession,
    size: int,
    max_shuffle_partitions: int = MAX_SHUFFLE_PARTITIONS,
    max_scan_tasks: int = MAX_SCAN_TASKS,
) -> None:
    """Let shuffles start with enough partitions for an input of ``size`` bytes; small ones are merged again at run time.

    The session's own partition count is the lower limit, and its own scan split too: a very large input gets wider splits, which
    bounds the number of scan tasks, and the next one its own again.
    """
    partitions = min(max_shuffle_partitions, -(-size // SHUFFLE_PARTITION_BYTES))
    partitions = max(partitions, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    split = max(_own_split(spark), -(-size // max_scan_tasks))
    if split != _bytes(spark.conf.get(_SPLIT)):
        spark.conf.set(_SPLIT, str(split))


def together(spark: SparkSession, *actions: Callable[[], T]) -> list[T]:
    """Run independent actions at the same time, so that small jobs do not wait for each other's start-up."""
    with ThreadPoolExecutor(max_workers=_CONCURRENT_ACTIONS) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]]


@contextmanager
def meanwhile(spark: SparkSession, *actions: Callable[[], T]) -> Iterator[list[Future[T]]]:
    """Start independent actions, to go on with something else until their results are asked for."""
    with ThreadPoolExecutor(max_workers=_CONCURRENT_ACTIONS) as pool:
        yield [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]


@contextmanager
def held(frame: DataFrame) -> Iterator[DataFrame]:
    """The frame kept in memory for several actions, worked out first by a job of its own.

    Actions that start together on a frame that is not there yet would each fill the cores with tasks that wait for the same few partitions.
    """
    kept = frame.persist()
    try:
        kept.count()
        yield kept
    finally:
        kept.unpersist()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new directory for tables a query writes and reads back.

    On a cluster it lies under the shared folder named by ``spark.checkpoint.dir``. Only a local-mode session without that
    setting falls back to a temporary folder on this machine, which goes when the session's process ends. Folders under the shared one
    stay, as another process may still read them: they have one parent, ``mallflow``, to be cleared by age.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/mallflow/{label}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix=f"mallflow-{label}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
