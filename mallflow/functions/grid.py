"""Raw coordinates to grid cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mallflow.schema import CELL_SIZE


def snap(raw: Column) -> Column:
    """Index of the grid cell holding an integer coordinate; negative coordinates round towards minus infinity."""
    return F.floor(raw / F.lit(CELL_SIZE)).cast("int")


def cell(text: Column) -> Column:
    """Grid cell of a coordinate given as text; null when the trimmed text is no integer."""
    return snap(F.trim(text).try_cast("int"))
