"""Batches of long texts, and what a task leaves behind."""

import resource
from pathlib import Path

import numpy as np
import pyarrow as pa

from mallflow.llm import frames


def test_batches_of_long_texts_are_short(spark):
    docs = spark.range(600).selectExpr("id", "repeat('word ', 4000) AS text").coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "size"])

    met = frames.in_batches(docs, sizes, "rows bigint, size bigint").collect()
    assert sum(row["rows"] for row in met) == 600
    assert max(row["size"] for row in met) <= 1 << 20


def _held() -> int:
    return int(Path("/proc/self/statm").read_text().split()[1]) * resource.getpagesize()


def test_freed_memory_goes_back_to_the_system():
    pieces = [np.ones(8000) for _ in range(3000)]
    full, last = _held(), pieces[-1]
    pieces.clear()
    frames.give_back()
    assert _held() < full - 100_000_000 and len(last) == 8000
