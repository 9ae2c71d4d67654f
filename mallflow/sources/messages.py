"""Message streams with one CSV line per row in ``value``.

With ``origins``, also where it came from (``origin``: partition of the topic, or file) and its ``place`` there if it has one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mallflow.sources.text import LINE_END


def kafka_messages(spark: SparkSession, servers: str, topic: str, origins: bool = False, **options: str) -> DataFrame:
    """Values of a topic, from its newest offsets on the first start and from the checkpoint afterwards.

    Needs the Spark Kafka connector on the class path.
    """
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    messages = reader.option("startingOffsets", "latest").options(**options).load()
    columns = [F.col("value").cast("string").alias("value")]
    if origins:
        columns += [F.concat_ws("/", "topic", "partition").alias("origin"), F.col("offset").alias("place")]
    return messages.select(*columns)


def file_messages(spark: SparkSession, directory: str, max_files: int | None = None, origins: bool = False) -> DataFrame:
    """Lines of the text files arriving in a directory; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema("value string").option("lineSep", LINE_END)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(directory)
    if not origins:
        return lines
    return lines.select("value", F.col("_metadata.file_path").alias("origin"), F.lit(None).cast("bigint").alias("place"))
