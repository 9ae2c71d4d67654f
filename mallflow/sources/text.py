"""Text files as lines, read in parallel."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Lines end at a line feed only, so a carriage return stays part of its line.
LINE_END = "\n"

# Scheme and host of a path, which may be left out or filled in by the file system.
_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines of the given files in ``value``, with the ``file`` each came from."""
    lines = spark.read.option("lineSep", LINE_END).text(list(paths))
    return lines.select("value", F.col("_metadata.file_path").alias("file"))


def read_directory(spark: SparkSession, *directories: str) -> DataFrame:
    """Lines of every file directly in the given directories; files further down are left out.

    Adds ``directory``, the name of the directory a line was found in.
    """
    roots = [d.rstrip("/") for d in directories]
    # Naming the entries one by one keeps directory names from being taken for partition columns.
    lines = read_lines(spark, *[f"{root}/*" for root in roots])
    # File names come back as encoded URIs; a plus sign stands for itself there.
    parent = F.regexp_replace(F.regexp_replace("file", "/[^/]+$", ""), _SCHEME, "")
    parent = F.url_decode(F.replace(parent, F.lit("+"), F.lit("%2B")))
    bare = [re.sub(_SCHEME, "", root) for root in roots]
    direct = reduce(
        lambda a, b: a | b, (parent == root if root.startswith("/") else parent.endswith(f"/{root}") for root in bare)
    )
    return lines.where(direct).select("value", "file", F.regexp_extract(parent, "([^/]+)$", 1).alias("directory"))
