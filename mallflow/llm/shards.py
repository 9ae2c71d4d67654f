"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups (rows with equal texts) are packed in order of falling size: each enters the bin whose remaining capacity is the least that
still holds it, found in a balanced tree over the remaining capacities. Groups of one size are interchangeable, so the packing works
on the number of groups of each size: a run of equal groups fills the tightest bin as far as it holds, then the next. The tree is a
treap, so a step takes a time that grows with the logarithm of the open bins. Sizes and their numbers are all that comes to the driver; since different sizes add up to
the bytes of the corpus at least, there are at most ``sqrt(2 * bytes)`` of them (14 million for 100 TB). Which group of a size goes
to which of the bins chosen for it is settled on the cluster, by the groups' rank within their size.

With a ``capacity``, ``into_shards`` gives as few shards of it as the heuristic finds. With a number of ``shards`` it looks for the
least capacity that fits: groups larger than an even share get a shard of their own, and the others are packed into
the rest.

Defined results: a null text counts as empty (size 1, checksum 0); equal texts, empty ones too, are one group; repeated rows get a
slot each; an empty table gives an empty table.
"""

from __future__ import annotations

from random import Random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mallflow.llm.frames import fresh, shuffle_width, stored

SHARDS = 16
LAW = "bytes"
# Capacities are tried this finely, as shares of the even load.
_FINE = 4096

Runs = list[tuple[int, int]]
Plan = list[tuple[int, int, int, int]]


class _Bins:
    """Open bins in a treap: a search tree by (capacity left, bin), kept balanced by drawn priorities.

    A node is a list: its key, its priority, the tree of smaller and that of greater keys.
    """

    def __init__(self) -> None:
        self.root: list | None = None
        self.draw = Random(0)

    def add(self, left: int, shard: int) -> None:
        low, high = _split(self.root, (left, shard))
        self.root = _joined(_joined(low, [(left, shard), self.draw.random(), None, None]), high)

    def take(self, size: int) -> tuple[int, int] | None:
        """Take out the bin with the least capacity left that holds ``size``; None if none does."""
        low, high = _split(self.root, (size, -1))
        found = None
        if high is not None:
            above, node = None, high
            while node[2] is not None:
                above, node = node, node[2]
            found = node[0]
            if above is None:
                high = node[3]
            else:
                above[2] = node[3]
        self.root = _joined(low, high)
        return found


def _split(node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
    """The trees of the keys below ``key`` and of all others."""
    if node is None:
        return None, None
    if node[0] < key:
        node[3], high = _split(node[3], key)
        return node, high
    low, node[2] = _split(node[2], key)
    return low, node


def _joined(low: list | None, high: list | None) -> list | None:
    """One tree of two, all keys of the first being below those of the second."""
    if low is None or high is None:
        return high if low is None else low
    if low[1] > high[1]:
        low[3] = _joined(low[3], high)
        return low
    high[2] = _joined(low, high[2])
    return high


def pack(runs: Runs, capacity: int, bins: int | None = None) -> tuple[Plan, int] | None:
    """Best-fit decreasing of (size, number) runs in falling order of size; None if ``bins`` bins do not suffice.

    The plan has (size, first, last, bin): the groups ranked ``first`` to ``last`` (exclusive) of that size go to the bin.
    """
    tree = _Bins()
    plan: Plan = []
    opened = 0
    for size, number in runs:
        if size > capacity:
            return None
        rank = 0
        while rank < number:
            tightest = tree.take(size)
            if tightest is not None:
                left, shard = tightest
            elif bins is None or opened < bins:
                left, shard = capacity, opened
                opened += 1
            else:
                return None
            take = min(left // size, number - rank)
            plan.append((size, rank, rank + take, shard))
            rank += take
            if left > take * size:
                tree.add(left - take * size, shard)
    return plan, opened


def least_capacity(runs: Runs, bins: int) -> Plan:
    """The plan of the least capacity for which best fit needs at most ``bins`` bins, a group too large for it apart."""
    alone: Plan = []
    rest = [run for run in runs if run[1]]
    left = sum(size * number for size, number in rest)
    # A group of more than an even share of what is left fills a shard by itself.
    while rest and len(alone) < bins - 1 and rest[0][0] * (bins - len(alone)) > left:
        size, number = rest[0]
        rank = sum(last - first for s, first, last, _ in alone if s == size)
        alone.append((size, rank, rank + 1, len(alone)))
        left -= size
        rest = ([(size, number - 1)] if number > 1 else []) + rest[1:]
    taken = {}
    for size, _, last, _ in alone:
        taken[size] = last
    bins -= len(alone)
    even = -(-left // bins)
    low, high = even, max(even, rest[0][0] if rest else 0)
    step = max(1, even // _FINE)
    while (found := pack(rest, high, bins)) is None:
        low, high = high + 1, high + step
        step *= 2
    while low < high:
        middle = (low + high) // 2
        better = pack(rest, middle, bins)
        if better is None:
            low = middle + 1
        else:
            found, high = better, middle
    shifted = [(size, first + taken.get(size, 0), last + taken.get(size, 0), shard + len(alone)) for size, first, last, shard in found[0]]
    return alone + shifted


def _sub(width: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(width)).cast("int")


def ranked(frame: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Add gapless ranks from 0 within ``key``: a key's rows are cut into parts by hash, so no key fills one task.

    Rows that agree in all of ``order`` are equal for every purpose, so which of them comes first does not matter. ``frame`` must be
    stored.
    """
    part, before = fresh(frame.columns, "part"), fresh(frame.columns, "before")
    cut = frame.withColumn(part, _sub(16 * shuffle_width(frame.sparkSession), *order))
    sizes = stored(cut.groupBy(key, part).agg(F.count(F.lit(1)).alias("n")), "parts")
    ahead = F.sum("n").over(Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(key, part, F.coalesce(ahead, F.lit(0)).alias(before))
    within = F.row_number().over(Window.partitionBy(key, part).orderBy(*order))
    placed = cut.withColumn(name, within).join(stored(offsets, "offsets"), [key, part])
    return placed.withColumn(name, (F.col(name) - 1 + F.col(before)).cast("bigint")).drop(part, before)


def _plan_frame(groups: DataFrame, bins: int | None, capacity: int | None) -> DataFrame:
    spark = groups.sparkSession
    rows = groups.groupBy("size").agg(F.count(F.lit(1)).alias("n")).toArrow()
    runs = sorted(zip(rows["size"].to_pylist(), rows["n"].to_pylist(), strict=True), reverse=True)
    if bins is not None:
        plan = least_capacity(runs, bins) if runs else []
    else:
        packed = pack(runs, max(capacity, runs[0][0]) if runs else capacity)
        plan = packed[0]
    return stored(spark.createDataFrame(plan, "size bigint, low bigint, high bigint, shard int"), "plan")


def _shard_of_group(sized: DataFrame, bins: int | None, capacity: int | None) -> DataFrame:
    """``digest`` and ``shard`` for each group of ``sized`` (digest, size of a row)."""
    groups = stored(sized.groupBy("digest").agg(F.sum("size").cast("bigint").alias("size")), "groups")
    plan = _plan_frame(groups, bins, capacity)
    placed = ranked(groups, "size", ["digest"], "rank")
    on = (placed["size"] == plan["size"]) & (placed["rank"] >= plan["low"]) & (placed["rank"] < plan["high"])
    return stored(placed.join(plan, on).select("digest", "shard"), "shards")


def _size(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def _digest(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def into_shards(docs: DataFrame, shards: int | None = SHARDS, capacity: int | None = None, id_column: str = "doc_id") -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``.

    Either the number of shards is given, or, with ``shards=None``, their ``capacity`` in bytes.
    """
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = stored(docs.select(id_column, _digest("text").alias("digest"), _size("text").alias("size"), crc.alias("text_crc32")), "sized")
    placed = rows.join(_shard_of_group(rows.select("digest", "size"), shards, capacity), "digest")
    slotted = ranked(stored(placed, "placed"), "shard", [id_column, "digest"], "slot")
    return slotted.select(
        id_column,
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def with_shard(docs: DataFrame, shards: int = SHARDS, name: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row's group, in a column not there before."""
    sized = docs.select(_digest("text").alias("digest"), _size("text").alias("size"))
    groups = _shard_of_group(sized, shards, None)
    digest = _digest("text")
    return docs.join(groups, digest == groups["digest"]).select(*[docs[c] for c in docs.columns], groups["shard"].alias(fresh(docs.columns, name)))
