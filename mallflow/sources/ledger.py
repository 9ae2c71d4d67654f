"""What each batch took from its source, and what was left out or taken twice.

A row of the ledger is a batch and an origin: a partition of a topic with its first and last offset, or a file, which is taken whole. The
rows are stored by batch, so a batch that is run again replaces its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallflow.sources.tables import replace_partitions, scan

LEDGER = T.StructType(
    [
        T.StructField("origin", T.StringType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
        T.StructField("messages", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def taken(messages: DataFrame) -> DataFrame:
    """First and last place and number of a batch's messages by origin."""
    places = [fn("place").alias(name) for name, fn in (("first", F.min), ("last", F.max))]
    return messages.groupBy("origin").agg(*places, F.count(F.lit(1)).alias("messages"))


def breaks(ledger: DataFrame) -> DataFrame:
    """Where an origin does not go on as the batch before left it: ``kind`` and the ``messages`` concerned.

    ``gap``: places between two batches that no batch took; ``repeat``: places, or a whole file, that a later batch took again;
    ``hole``: places inside a batch that held no message, as after compaction of the topic.
    """
    order = Window.partitionBy("origin").orderBy("batch_id")
    known = ledger.select("*", F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("reached"), F.row_number().over(order).alias("nth"))
    ahead = F.col("first") - F.col("reached") - 1
    whole = F.col("first").isNull() & (F.col("nth") > 1)
    again = F.when(F.col("reached").isNotNull(), F.least("last", "reached") - F.col("first") + 1)
    repeated = F.when(whole, F.col("messages")).otherwise(again)
    inside = F.col("last") - F.col("first") + 1 - F.col("messages")
    kinds = F.array(*[F.struct(F.lit(kind).alias("kind"), n.cast("bigint").alias("n")) for kind, n in (("gap", ahead), ("repeat", repeated), ("hole", inside))])
    found = known.select("batch_id", "origin", F.explode(kinds).alias("found")).where("found.n > 0")
    return found.select("batch_id", "origin", "found.kind", F.col("found.n").alias("messages"))


def missed_files(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """Files (``origin``, ``messages``: their lines) that no batch took, or not as many lines of."""
    held = ledger.groupBy("origin").agg(F.max("messages").alias("held"))
    joined = files.join(held, "origin", "left").withColumn("left", F.col("messages") - F.coalesce("held", F.lit(0)))
    return joined.where("left > 0").select("origin", F.col("left").alias("messages"))


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    root: str

    def note(self, messages: DataFrame, batch_id: int) -> None:
        rows = taken(messages).withColumn("batch_id", F.lit(batch_id).cast("long"))
        replace_partitions(rows, self.root, "batch_id", sized=False)

    def read(self) -> DataFrame:
        return scan(self.spark, self.root, LEDGER)
