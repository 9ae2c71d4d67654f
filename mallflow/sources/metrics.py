"""The metric store: one partition per metric, processing date and batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallflow.schema import METRIC, with_keys
from mallflow.sources.tables import scan

_STORED = with_keys(METRIC, ("bi_name", T.StringType()), ("p_dt", T.StringType()), ("batch_id", T.LongType()))


@dataclass(frozen=True)
class MetricStore:
    spark: SparkSession
    root: str

    def _partition(self, bi_name: str, p_dt: str) -> str:
        return f"{self.root}/bi_name={bi_name}/p_dt={p_dt}"

    def replace(self, documents: DataFrame, bi_name: str, p_dt: str, batch_id: int) -> None:
        """Delete the metric's documents of the date, then store these. No documents: only the deletion."""
        (
            documents.drop("bi_name", "p_dt")
            .withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("batch_id")
            .parquet(self._partition(bi_name, p_dt))
        )

    def append(self, documents: DataFrame, bi_name: str, p_dt: str, batch_id: int) -> None:
        """Keep earlier batches' documents and store these. A batch run again replaces its own documents only."""
        (
            documents.drop("bi_name", "p_dt")
            .write.mode("overwrite")
            .parquet(f"{self._partition(bi_name, p_dt)}/batch_id={batch_id}")
        )

    def read(self) -> DataFrame:
        return scan(self.spark, self.root, _STORED)

    def read_day(self, p_dt: str, *bi_names: str) -> DataFrame:
        """The documents of the named metrics on one date; no other directory is listed."""
        return scan(self.spark, self.root, _STORED, [f"bi_name={name}/p_dt={p_dt}" for name in bi_names])
