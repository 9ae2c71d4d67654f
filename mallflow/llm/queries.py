"""The registered queries of this package, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mallflow.llm import chat, decontaminate, licenses, lines, mixing, near, pii, quality, repair, shards, substrings, trie, warc
from mallflow.session import configure

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    _REGISTRY[fn.__name__] = run
    return run


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def oracle_sql() -> dict[str, str]:
    """The rest are tested against brute force: their methods (models, packings, spans) have no SQL that is quick enough."""
    return {
        "op6_positional_index": decontaminate.ORACLE_SQL,
        "op7_revisits": warc.ORACLE_SQL,
        "op9_perspectives": chat.ORACLE_SQL,
        "op10_suffix_trees": substrings.ORACLE_SQL,
        "op11_centroids": trie.ORACLE_SQL,
        "op12_viterbi": repair.ORACLE_SQL,
        "op13_line_runs": lines.ORACLE_SQL,
    }


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.quality(docs, ["doc_id"]).select("doc_id", "quality.*")


@query
def op6_positional_index(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.verdicts(decontaminate.matches(docs, _table(spark, sf_dir, "benchmark")))


@query
def op10_suffix_trees(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept_sha = F.sha2(F.col("rest.text").cast("binary"), 256).alias("kept_sha256")
    return substrings.remove_repeats(docs, ["doc_id"]).select("doc_id", "rest.n_words", "rest.n_removed", kept_sha)


@query
def op1_order_minhash(spark, sf_dir):
    return near.near_classes(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_best_fit(spark, sf_dir):
    return shards.into_shards(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op8_pii(spark, sf_dir):
    return pii.digest(pii.find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op5_licences(spark, sf_dir):
    docs = licenses.with_paths(_table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("source")
    return licenses.scan_licences(docs).select(
        "doc_id",
        "path",
        F.col("own.name").alias("own_licence"),
        F.col("own.score").alias("score"),
        F.col("own.line").alias("line"),
        F.col("inherited.name").alias("inherited_licence"),
        F.col("inherited.from").alias("inherited_from"),
        "licence",
    )


@query
def op2_soft_mix(spark, sf_dir):
    return mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))


@query
def op7_revisits(spark, sf_dir):
    found = warc.resolve_revisits(warc.captures(_table(spark, sf_dir, "pages")))
    return found.withColumn("headers", warc.listed(F.col("headers")))


@query
def op9_perspectives(spark, sf_dir):
    return chat.rotate(_table(spark, sf_dir, "conversations"))


@query
def op11_centroids(spark, sf_dir):
    return trie.digest(_table(spark, sf_dir, "conversations"))


@query
def op12_viterbi(spark, sf_dir):
    return repair.digest(_table(spark, sf_dir, "conversations"))


@query
def op13_line_runs(spark, sf_dir):
    found = lines.drop_common_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2(F.col("lines.text").cast("binary"), 256).alias("kept_sha256"))
