"""From raw documents to shards: quality rules, near-duplicates, benchmark passages, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next stage's docs.
All but the last return the columns of ``documents``; the last adds the shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mallflow.llm import decontaminate, mixing, near, quality, shards
from mallflow.llm.frames import fresh, stored
from mallflow.session import configure


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counts and lie within their language's perplexity band."""
    score = fresh(docs.columns, "quality")
    return quality.quality(_configured(spark, docs), into=score).where(F.col(f"{score}.kept")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-copies."""
    return near.drop_near_copies(_configured(spark, docs))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.decontaminate(_configured(spark, docs), _table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A draw of the documents whose expected words by domain meet the targets, without repeats."""
    return mixing.sampled(_configured(spark, docs), _table(spark, sf_dir, "labels"))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard."""
    return shards.with_shard(_configured(spark, docs))


def _configured(spark: SparkSession, docs: DataFrame) -> DataFrame:
    configure(spark)
    return docs


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("mixture", mixture),
    ("sharding", sharding),
]

# The perplexity model has no SQL; the stages are tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
