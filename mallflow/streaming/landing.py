"""Storing the messages of a micro-batch.

The frame handed to ``foreachBatch`` belongs to the stream's own session, where adaptive execution may be off. It is only parsed
and stored, without a shuffle; everything else reads the stored pings in the ordinary session.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallflow.operators.parse import dead_letters_of, pings_of, read_lines
from mallflow.plans.warehouse import Warehouse
from mallflow.session import together

# Of a batch's text in one file. Up to the number of cores there are more and smaller files, so that no core waits for the writers.
_FILE_BYTES = 128 * 1024 * 1024
_LEAST_FILE_BYTES = 16 * 1024 * 1024


@dataclass(frozen=True)
class Messages:
    """The parsed lines of a batch, held in memory, and their size in bytes."""

    read: DataFrame
    size: int

    def in_files(self, rows: DataFrame) -> DataFrame:
        """``rows`` of the batch in as many tasks as there are files to write; the parsing is done by then."""
        cores = rows.sparkSession.sparkContext.defaultParallelism
        return rows.coalesce(max(1, -(-self.size // _FILE_BYTES), min(cores, self.size // _LEAST_FILE_BYTES)))


@contextmanager
def messages_of(batch: DataFrame) -> Iterator[Messages | None]:
    """The batch's lines, read and parsed once, in the source's own partitions; None when there are none."""
    known = [c for c in ("value", "origin", "place") if c in batch.columns]
    read = read_lines(batch.select(*known)).persist()
    try:
        size = read.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value")).alias("bytes")).first()
        yield Messages(read, size["bytes"] or 0) if size["n"] else None
    finally:
        read.unpersist()


def land(house: Warehouse, messages: Messages, p_dt: str, batch_id: int) -> None:
    """Store the readable lines as pings and the others as dead letters, and note where they came from, if the source says so."""
    steps = [
        lambda: house.append_pings(messages.in_files(pings_of(messages.read)), p_dt, batch_id),
        lambda: house.append_dead_letters(messages.in_files(dead_letters_of(messages.read)), p_dt, batch_id),
    ]
    if "origin" in messages.read.columns:
        steps.append(lambda: house.ledger.note(messages.read, batch_id))
    together(house.spark, *steps)
