"""Shop-to-shop moves of each device.

A device's path is its named sightings in order of (time_stamp, name). One device may hold a large share of a day's pings, so a
path is never gathered in one task. Repeats of a sighting within one second change no move and are folded first, on the map
side; the path is then cut into clock hours and walked inside each hour. The hours are tied together through their edges: the
first and last sighting of a device in an hour, at most two rows however many pings there were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The part that moves between hours fall into.
BETWEEN = "between"

# Longest array used to repeat a row.
_COPIES = 10_000


def part_of() -> Column:
    """The clock hour of a ping."""
    # Clock texts need not be padded, so the hour is put together from the clock's parts.
    return F.format_string("%04d%02d%02d%02d", "dt_year", "dt_month", "dt_day", "dt_hour")


def _sightings(dw: DataFrame) -> DataFrame:
    named = dw.where(F.col("name").isNotNull() & F.col("mac").isNotNull())
    return named.select("p_dt", part_of().alias("part"), "mac", "time_stamp", "date_time", "name")


def _differ(a: str, b: str) -> Column:
    # Some letters have two small or two capital forms, so both ways must tell the names apart.
    return (F.upper(a) != F.upper(b)) & (F.lower(a) != F.lower(b))


def _links(steps: DataFrame, *more: str) -> DataFrame:
    return steps.where(_differ("from_name", "to_name")).select(
        "mac", "date_time", "from_name", "to_name", F.lit(1).alias("times"), "p_dt", *more
    )


def sightings(dw: DataFrame) -> DataFrame:
    """The distinct named sightings, with the clock hour (``part``) they fall into. Those of several batches unite to those of the day."""
    return _sightings(dw).distinct()


def hour_of_sighting() -> Column:
    """The clock hour of a ping that is a named sighting of a device; null for others."""
    return F.when(F.col("name").isNotNull() & F.col("mac").isNotNull(), part_of())


def hour_steps(dw: DataFrame) -> DataFrame:
    """Every sighting with the shop before it in its hour, and whether it opens or closes the device's hour."""
    return steps_of(sightings(dw))


def steps_of(folded: DataFrame) -> DataFrame:
    """:func:`hour_steps` of distinct sightings."""
    path = Window.partitionBy("p_dt", "part", "mac").orderBy("time_stamp", "name")
    return folded.select(
        "p_dt",
        "part",
        "mac",
        "time_stamp",
        "date_time",
        F.lag("name").over(path).alias("from_name"),
        F.col("name").alias("to_name"),
        F.lag("name").over(path).isNull().alias("opens"),
        F.lead("name").over(path).isNull().alias("closes"),
    )


def edges(steps: DataFrame) -> DataFrame:
    """The first and last sighting of each device in an hour."""
    return steps.where(F.col("opens") | F.col("closes")).drop("from_name")


def hour_links(steps: DataFrame) -> DataFrame:
    """Moves inside the hours, with their hour as ``part``."""
    return _links(steps, "part")


def edge_links(steps: DataFrame) -> DataFrame:
    """Moves from the last shop of one hour to the first of the device's next one, from all steps or from their edges."""
    path = Window.partitionBy("p_dt", "mac").orderBy("time_stamp", "to_name")
    return _links(edges(steps).withColumn("from_name", F.lag("to_name").over(path)).where("opens"))


def parted_links(dw: DataFrame) -> DataFrame:
    """:func:`consecutive_links` with the part each move falls into."""
    steps = hour_steps(dw)
    return hour_links(steps).unionByName(edge_links(steps).withColumn("part", F.lit(BETWEEN)))


def consecutive_links(dw: DataFrame) -> DataFrame:
    """Moves between consecutive differently named shops, per device and ``p_dt``."""
    return parted_links(dw).drop("part")


def anchor_links(dw: DataFrame) -> DataFrame:
    """Moves from a device's first shop of the ``p_dt`` to every later sighting with another name.

    Every sighting counts here, also repeats within a second: they are folded with their number, joined to the device's first
    shop hour by hour, and unfolded at the end.
    """
    sightings = _sightings(dw)
    folded = sightings.groupBy(*sightings.columns).agg(F.count(F.lit(1)).alias("n"))
    heads = folded.groupBy("p_dt", "mac", "part").agg(F.min(F.struct("time_stamp", "name")).alias("head"))
    first = F.min("head").over(Window.partitionBy("p_dt", "mac"))["name"]
    firsts = heads.select("p_dt", "mac", "part", first.alias("from_name"))
    moves = folded.withColumnRenamed("name", "to_name").join(firsts, ["p_dt", "mac", "part"])
    return _links(_unfold(moves.where(_differ("from_name", "to_name"))))


def _unfold(moves: DataFrame) -> DataFrame:
    """Each row ``n`` times over, through arrays of bounded length."""
    last = F.expr(f"(n - 1) div {_COPIES}")
    chunks = moves.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    left = F.least(F.lit(_COPIES).cast("bigint"), F.col("n") - F.col("chunk") * _COPIES)
    return chunks.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), left)))


def pair_counts(links: DataFrame, *keys: str) -> DataFrame:
    """Moves per shop pair (and ``keys``). Counts of parts of the day add up."""
    return links.groupBy(*keys, "from_name", "to_name").agg(F.sum("times").alias("times"))


def link_matrix(links: DataFrame) -> DataFrame:
    """Moves per shop pair, from moves or from pair counts of parts, with all moves out of the first shop."""
    pairs = pair_counts(links)
    out = Window.partitionBy("from_name")
    return pairs.withColumn("total", F.sum("times").over(out))
