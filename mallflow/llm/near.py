"""Near-duplicates by Order MinHash, verified by banded alignment.

A text's words are cut into runs of ``SHINGLE`` words, each labelled with the number of equal runs before it. For each of
``SKETCHES`` hash functions, the ``SAMPLE`` labelled runs with the least hashes are taken, put back into the order of the text, and
hashed into one bucket. Two texts share a bucket with a probability that falls with their edit distance, since moved runs change the
order. Texts that share a bucket are compared by their words: they are linked when their edit distance is at most a fifth of the
longer text's words (edit similarity 0.8 or more). The distance is found along a band of diagonals that is doubled until the
distance fits into it or the limit is reached.

First, each text is compared with two others only: the hubs of the largest and of the smallest bucket it is in. Classes are the connected
components of the links. In the buckets that then still hold several classes, each text is compared with the one of another class before
it in order of length, as near-copies are about equally long. Buckets that still hold several classes after that are searched in full:
texts of different classes are compared in blocks, so near-copies by the thousand, which are one class by then, cost nothing here. A bucket of over ``BLOCK`` texts is cut into parts of about so many, by length and then by hash, and each part makes a
block with itself and with every other part, but for parts whose lengths allow no link and parts of one and the same class. A block
emits only pairs whose lengths and profiles allow a link, never all its pairs. One link joins two classes, so of the texts of another
class the ``NEAREST`` by profile are tried first; blocks with pairs left over are searched again with the classes found by then and
``MORE`` times as many, until no block has a likely pair of two classes that was not tried. A pair belongs to the block of the least
bucket that its texts share, and to one search, so that it is emitted once. Equal texts are one node from the start.

A profile is the numbers of a text's words in ``PLACES`` hashed places: each edit takes away one word at most and adds one at most, so
texts one of which has more words than the limit that the other lacks are no candidates, and their texts are not moved.

Defined results: equal texts are in one class, also empty ones; a null text is a class of its own; a text of fewer than ``SHINGLE``
words is one run; a text without words is only like its equals; repeated rows are in one class; the class id is its least doc_id.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mallflow.llm.components import components
from mallflow.llm.frames import fresh, in_batches, shuffle_width, stored
from mallflow.llm.words import FOLDED, Chunk, chunks, grams, mix

SHINGLE = 5
SKETCHES = 24
SAMPLE = 2
# A link needs a distance of at most one word in so many.
SHARE = 5
PLACES, _COARSE = 1024, 128
BLOCK, NEAREST, MORE = 1000, 4, 8
# Texts are cut by length at powers of this: a text and those that may be linked to it are at most one band apart.
_BAND = SHARE / (SHARE - 1)
# Pairs in one batch that a block emits.
_EMITTED = 1 << 15
_STEP = np.uint64(0x9E3779B97F4A7C15)


# --- sketches ------------------------------------------------------------------------------------


def _labelled(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every labelled run, the places of the runs, and the bounds of the texts among them."""
    counts = chunk.counts
    size = np.minimum(counts, SHINGLE)
    n_runs = np.where(counts > 0, counts - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), n_runs)
    bounds = np.concatenate([[0], np.cumsum(n_runs)])
    at = np.arange(len(text)) - np.repeat(bounds[:-1], n_runs) + np.repeat(chunk.edges[:-1], n_runs)
    runs = np.zeros(len(at), np.uint64)
    for width in range(1, SHINGLE + 1):
        mine = size[text] == width
        if mine.any():
            runs[mine] = grams(chunk.hashes, width)[at[mine]]
    keys = mix(runs + text.astype(np.uint64) * _STEP)
    order = np.argsort(keys, kind="stable")
    new = np.diff(keys[order], prepend=~keys[order][:1]) != 0
    place = np.arange(len(order))
    before = np.empty(len(order), np.uint64)
    before[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return mix(runs + before * _STEP), text, bounds


def _sketch_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    for batch in batches:
        for chunk in chunks(batch.column(1), FOLDED):
            runs, text, bounds = _labelled(chunk)
            some = np.flatnonzero(np.diff(bounds))
            if not len(some):
                continue
            starts = bounds[some]
            bits = np.uint64(max(1, int(len(runs)).bit_length()))
            low = (np.uint64(1) << bits) - np.uint64(1)
            places = np.arange(len(runs), dtype=np.uint64)
            buckets = []
            for number in range(SKETCHES):
                ranked = (mix(runs ^ mix(_STEP * np.array([number + 1], np.uint64))) & ~low) | places
                taken = np.full((SAMPLE, len(some)), most, np.uint64)
                for i in range(SAMPLE):
                    least = np.minimum.reduceat(ranked, starts)
                    met = least != most
                    taken[i, met] = least[met] & low
                    ranked[taken[i, met].astype(np.int64)] = most
                # Back into the order of the text; a text with fewer runs keeps the mark of the missing ones last.
                taken.sort(axis=0)
                sketch = np.full(len(some), number + 1, np.uint64)
                for i in range(SAMPLE):
                    met = taken[i] != most
                    run = np.where(met, runs[np.where(met, taken[i], 0).astype(np.int64)], most)
                    sketch = mix(sketch * _STEP + run)
                buckets.append(sketch)
            digests = batch.column(0).take(pa.array(np.tile(some, SKETCHES) + chunk.rows.start))
            size = pa.array(np.tile(chunk.counts[some], SKETCHES).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [digests, size, pa.array(np.concatenate(buckets).view(np.int64))], ["digest", "size", "bucket"]
            )


def buckets_of(docs: DataFrame) -> DataFrame:
    """The buckets of each distinct text: ``digest``, ``size`` in words, ``bucket`` and its number ``n`` of texts, two at least. Stored."""
    made = in_batches(docs.select("digest", "text"), _sketch_task, "digest binary, size int, bucket bigint")
    found = stored(made.distinct(), "sketches")
    shared = stored(found.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared", narrow=True)
    return stored(found.join(shared, "bucket"), "buckets")


# --- alignment -----------------------------------------------------------------------------------


def banded_distance(a: list[int], b: list[int], limit: int) -> int | None:
    """Edit distance of two sequences, or None if it is over ``limit``."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > limit:
        return None
    low = 0
    while low < len(b) and a[low] == b[low]:
        low += 1
    high = 0
    while high < len(b) - low and a[len(a) - 1 - high] == b[len(b) - 1 - high]:
        high += 1
    a, b = a[low : len(a) - high], b[low : len(b) - high]
    if not b:
        return len(a) if len(a) <= limit else None
    # Words of one that the other lacks must each be changed or removed.
    least = max((Counter(a) - Counter(b)).total(), (Counter(b) - Counter(a)).total())
    if least > limit:
        return None
    band = max(8, 2 * least, len(a) - len(b))
    while True:
        band = min(band, limit)
        found = _within_band(a, b, band)
        if found is not None or band == limit:
            return found
        band *= 2


def _within_band(a: list[int], b: list[int], band: int) -> int | None:
    """Edit distance if it is at most ``band``: bit-parallel, one column a word of ``b``, over the diagonals within the band.

    Bit ``k`` of a column's numbers stands for row ``column + k - band``; ``up`` and ``down`` mark rows that are one more or one less
    than the row before. A row above the matrix counts as its column number, one below the band as one more than the last.
    """
    skew = len(a) - len(b)
    if skew > band:
        return None
    width = 2 * band + 1
    every = (1 << width) - 1
    top = 1 << (width - 1)
    follow = skew + band
    rows: dict[int, int] = {}
    for place, word in enumerate(a):
        rows[word] = rows.get(word, 0) | (1 << place)
    up, down = every & ~((1 << (band + 1)) - 1), 0
    distance = skew
    for column in range(1, len(b) + 1):
        up = (up >> 1) | top
        down >>= 1
        equal = rows.get(b[column - 1], 0)
        shift = column - band - 1
        equal = (equal >> shift if shift >= 0 else equal << -shift) & every
        level = ((((equal & up) + up) ^ up) | equal | down) & every
        right_up = down | (every & ~(level | up))
        right_down = level & up
        distance += not (level >> follow) & 1
        if distance > band:
            return None
        right_up = ((right_up << 1) | 1) & every
        right_down = (right_down << 1) & every
        up = right_down | (every & ~(level | right_up))
        down = right_up & level
    return distance


def _verify_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def words(column: pa.Array) -> Iterator[list[int]]:
        for chunk in chunks(column, FOLDED):
            for low, high in zip(chunk.edges[:-1], chunk.edges[1:], strict=True):
                yield chunk.hashes[low:high].tolist()

    for batch in batches:
        found = [
            banded_distance(x, y, max(len(x), len(y)) // SHARE) is not None
            for x, y in zip(words(batch.column(2)), words(batch.column(3)), strict=True)
        ]
        yield batch.select(["root_a", "root_b"]).filter(pa.array(found, pa.bool_()))


def _profile_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each text and their numbers by hashed place, up to 255 each."""
    for batch in batches:
        sizes, profiles = [], []
        for chunk in chunks(batch.column(1), FOLDED):
            place = chunk.text_of_word() * PLACES + (chunk.hashes % np.uint64(PLACES)).astype(np.int64)
            numbers = np.bincount(place, minlength=len(chunk.rows) * PLACES)
            profiles.append(np.minimum(numbers, 255).astype(np.uint8))
            sizes.append(chunk.counts)
        flat = np.concatenate(profiles)
        packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(PLACES), batch.num_rows, [None, pa.py_buffer(flat)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.concatenate(sizes)), packed.cast(pa.binary())],
            ["digest", "text", "words", "profile"],
        )


def _likely(size: np.ndarray, profiles: list[np.ndarray], i: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the other texts the lengths and profiles, the coarser first, allow to be within the limit of text ``i``; how far off
    their profiles are."""
    limit = np.maximum(size[others], size[i]) // SHARE
    others, limit = (x[np.abs(size[others] - size[i]) <= limit] for x in (others, limit))
    off = limit
    for profile in profiles:
        # Twice the words that the longer has over the shorter, by place: what they differ by, and by how much it is longer.
        off = np.abs(profile[others] - profile[i]).sum(axis=1) + np.abs(size[others] - size[i])
        near = off <= 2 * limit
        others, limit, off = others[near], limit[near], off[near]
    return others, off


def _rank(text: np.ndarray, kind: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Place of each pair among those of its text with the same class, by how far off they are."""
    order = np.lexsort((off, kind, text))
    new = (np.diff(text[order], prepend=-1) != 0) | (np.diff(kind[order], prepend=-1) != 0)
    place = np.arange(len(order))
    out = np.empty(len(order), np.int64)
    out[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return out


def _marks(lists: list[list[int]]) -> np.ndarray:
    """The buckets of each text as a row, filled up with a number that no bucket is below."""
    marks = np.full((len(lists), max(map(len, lists))), np.iinfo(np.int64).max)
    for row, buckets in zip(marks, lists, strict=True):
        row[: len(buckets)] = buckets
    return marks


def _numbers(roots: list[bytes]) -> np.ndarray:
    number = {root: i for i, root in enumerate(dict.fromkeys(roots))}
    return np.array([number[root] for root in roots])


def _block_pairs(table: pa.Table, done: int, most: int) -> Iterator[pa.RecordBatch]:
    """Likely pairs of different classes, for rows of whole blocks in order of block and digest: of each class, the ``most`` nearest to a
    text without the ``done`` nearest, which an earlier search had. In a block of two parts (sides 1 and 2), pairs of both. Blocks with
    other pairs left over follow in ``left``.

    Classes for this order are those of the first search (``first``), so that a pair keeps its place in all of them.
    """
    block, bucket, size, side = (table[c].to_numpy() for c in ("block", "bucket", "words", "side"))
    fine = np.frombuffer(b"".join(table["profile"].to_pylist()), np.uint8).reshape(-1, PLACES).astype(np.int16)
    profiles = [fine.reshape(len(fine), _COARSE, -1).sum(axis=2, dtype=np.int16), fine]
    kind, first = (_numbers(table[c].to_pylist()) for c in ("root", "first"))
    marks = _marks(table["buckets"].to_pylist())
    ends = np.searchsorted(block, block, side="right")
    one, other, off = [], [], []
    for i, end in enumerate(ends):
        rest = np.arange(i + 1, end)
        apart = (first[rest] != first[i]) & ((side[rest] != side[i]) | (side[i] == 0))
        found, far = _likely(size, profiles, i, rest[apart])
        own = ~np.isin(marks[found], marks[i][marks[i] < bucket[i]]).any(axis=1)
        one.append(np.full(int(own.sum()), i))
        other.append(found[own])
        off.append(far[own])
    one, other, off = (np.concatenate(part).astype(np.int64) for part in (one, other, off))
    place = np.maximum(_rank(one, first[other], off), _rank(other, first[one], off))
    apart = kind[one] != kind[other]
    left = np.unique(block[one[apart & (place >= most)]])
    now = apart & (place >= done) & (place < most)
    one, other = one[now], other[now]
    digest, root = (table[c].combine_chunks() for c in ("digest", "root"))
    names = ["a", "b", "root_a", "root_b", "left"]
    for low in range(0, len(one), _EMITTED):
        x, y = (pa.array(part[low : low + _EMITTED]) for part in (one, other))
        yield pa.RecordBatch.from_arrays([digest.take(x), digest.take(y), root.take(x), root.take(y), pa.nulls(len(x), pa.int64())], names)
    yield pa.RecordBatch.from_arrays([pa.nulls(len(left), pa.binary())] * 4 + [pa.array(left)], names)


def _block_task(done: int, most: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            block = table["block"].to_numpy()
            cut = int(np.searchsorted(block, block[-1]))
            if cut:
                yield from _block_pairs(table.slice(0, cut).combine_chunks(), done, most)
            held = table.slice(cut)
        if held is not None and held.num_rows:
            yield from _block_pairs(held.combine_chunks(), done, most)

    return work


# --- links and classes ---------------------------------------------------------------------------

_PAIR = "a binary, b binary, root_a binary, root_b binary, left bigint"


def _hub_pairs(members: DataFrame) -> DataFrame:
    """Texts with the hubs of the largest and of the smallest bucket they are in: two pairs a text at most, whatever the buckets' sizes."""
    hubs = stored(members.groupBy("bucket").agg(F.min("digest").alias("y")), "hubs", narrow=True)
    sized = F.struct("n", "bucket")
    ends = members.groupBy(F.col("digest").alias("x")).agg(F.array_distinct(F.array(F.max(sized), F.min(sized))).alias("ends"))
    pairs = ends.select("x", F.explode("ends.bucket").alias("bucket")).join(hubs, "bucket").where("x <> y")
    pairs = pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
    return pairs.select("a", "b", F.col("a").alias("root_a"), F.col("b").alias("root_b"))


def _length_pairs(rows: DataFrame) -> DataFrame:
    """Texts with the one before them in order of length, where that is of another class (``root``): one pair a text, of the smallest
    bucket that has one."""
    draw = F.xxhash64("digest")
    order = Window.partitionBy("bucket", F.pmod(draw, F.expr(f"(n + {BLOCK - 1}) div {BLOCK}"))).orderBy("size", draw)
    last = F.lag(F.struct("digest", "root")).over(order)
    met = rows.select(F.struct("digest", "root").alias("x"), last.alias("y"), "n").where("x.root <> y.root")
    pairs = met.groupBy("x").agg(F.min(F.struct("n", "y")).alias("least")).select("x", "least.y")
    pairs = pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
    return pairs.select("a.digest", "b.digest", "a.root", "b.root").toDF("a", "b", "root_a", "root_b")


def _blocks(members: DataFrame) -> DataFrame:
    """``block``, ``bucket``, ``side``, ``digest`` and ``root`` of the members of buckets, each pair of them with a possible link together in a block.
    Members of side 0 meet all others of their block, those of side 1 or 2 the other sides. Stored."""
    small = members.where(F.col("n") <= BLOCK).select(F.col("bucket").alias("block"), "bucket", F.lit(0).alias("side"), "digest", "root")
    band = F.floor(F.log(F.greatest("size", F.lit(1))) / F.log(F.lit(_BAND)))
    large = stored(members.where(F.col("n") > BLOCK).select("bucket", "digest", "size", "root", band.alias("band")), "large")
    if large.isEmpty():
        return stored(small, "blocks")
    # A class of more than a part has parts of its own, which need not meet each other. All other classes share parts.
    each = large.groupBy("bucket", "band", "root").agg(F.count(F.lit(1)).alias("n"))
    each = stored(each.withColumn("own", F.when(F.col("n") > BLOCK, F.col("root")).otherwise(F.lit(b""))), "cells", narrow=True)
    parts = F.expr(f"(sum(n) + {BLOCK - 1}) div {BLOCK}").alias("parts")
    number = stored(each.groupBy("bucket", "band", "own").agg(parts), "part-numbers", narrow=True)
    cells = stored(each.drop("n").join(number, ["bucket", "band", "own"]), "parts", narrow=True)
    part = F.xxhash64("band", "own", F.pmod(F.xxhash64("digest", "bucket"), F.col("parts")))
    placed = large.join(cells, ["bucket", "band", "root"]).select("bucket", "digest", "root", "size", "own", part.alias("part"))
    placed = stored(placed, "part-members")
    spans = placed.groupBy("bucket", "part", "own").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    spans = stored(spans, "spans", narrow=True)
    x, y = (spans.select("bucket", *[F.col(c).alias(f"{c}_{s}") for c in ("part", "own", "low", "high")]) for s in "xy")
    # What a text lacks of another's words may be a share of the longer one, so the shortest of the longer part decides.
    apart = F.greatest("low_x", "low_y") - F.least("high_x", "high_y") <= F.expr(f"greatest(low_x, low_y) div {SHARE}")
    one_class = (F.col("own_x") == F.col("own_y")) & (F.col("own_x") != F.lit(b""))
    met = x.join(y, "bucket").where((F.col("part_x") <= F.col("part_y")) & apart & ~one_class)
    block = F.xxhash64("bucket", "part_x", "part_y").alias("block")
    ends = F.array(*[F.struct(F.col(f"part_{p}").alias("part"), F.col(f"part_{q}").alias("other"), F.col(f"own_{p}").alias("own")) for p, q in ("xy", "yx")])
    sides = met.select("bucket", block, F.explode(F.array_distinct(ends)).alias("s")).select("bucket", "block", "s.*")
    # A part meets itself in its block with the least of the other parts, and has a block alone only if there are none: a bucket whose lengths
    # spread over many bands is then stored about twice.
    alone = F.col("part") == F.col("other")
    sides = sides.withColumn("least", F.min(F.when(~alone, F.col("other"))).over(Window.partitionBy("bucket", "part")))
    sides = sides.where(~alone | F.col("least").isNull())
    home = alone | ((F.col("other") == F.col("least")) & (F.col("own") == F.lit(b"")))
    side = F.when(home, 0).when(F.col("part") < F.col("other"), 1).otherwise(2)
    sides = stored(sides.select("bucket", "block", "part", side.alias("side")), "sides", narrow=True)
    return stored(small.unionByName(placed.join(sides, ["bucket", "part"]).select("block", "bucket", "side", "digest", "root")), "blocks")


def _open_pairs(rows: DataFrame, profiles: DataFrame, done: int, most: int) -> DataFrame:
    """Likely pairs of different classes (``root``) of a block, and in rows of their own the blocks that have more of them (``left``)."""
    rows = rows.join(profiles, "digest").select("block", "bucket", "side", "digest", "root", "first", "words", "profile", "buckets")
    blocks = rows.repartition(shuffle_width(rows.sparkSession), "block").sortWithinPartitions("block", "digest")
    pairs = in_batches(blocks, _block_task(done, most), _PAIR)
    turned = F.col("a") < F.col("b")
    return pairs.select(
        F.greatest("a", "b").alias("a"),
        F.least("a", "b").alias("b"),
        F.when(turned, F.col("root_b")).otherwise(F.col("root_a")).alias("root_a"),
        F.when(turned, F.col("root_a")).otherwise(F.col("root_b")).alias("root_b"),
        "left",
    )


def _side(texts: DataFrame, side: str) -> DataFrame:
    # Texts are always shuffled to their pairs: neither side has a bound that allows a broadcast.
    return texts.select(F.col("digest").alias(side), F.col("text").alias(f"text_{side}")).hint("merge")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The classes of the pairs that are alike, as edges ``a`` and ``b``. Stored."""
    both = pairs.join(_side(texts, "a"), "a").join(_side(texts, "b"), "b").select("root_a", "root_b", "text_a", "text_b")
    found = in_batches(both, _verify_task, "root_a binary, root_b binary").distinct()
    return stored(found.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), "links")


def _texts(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """Each needed text once, with its profile. Copies are put together inside the tasks, before the shuffle."""
    wanted = docs.select("digest", "text").join(stored(needed.select("digest").distinct(), "needed", narrow=True).hint("merge"), "digest", "left_semi")
    once = wanted.groupBy("digest").agg(F.first("text").alias("text"))
    return stored(in_batches(once, _profile_task, "digest binary, text string, words bigint, profile binary"), "texts")


def _several(rows: DataFrame, roots: DataFrame, group: str, among: DataFrame | None = None) -> DataFrame:
    """Rows with their ``root``, without the groups that are one class by now, or are not ``among`` some. Stored."""
    # Members without a link keep themselves.
    placed = rows.join(roots.withColumnRenamed("node", "digest"), "digest", "left")
    placed = stored(placed.withColumn("root", F.coalesce("root", "digest")), "placed")
    mixed = placed.groupBy(group).agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    mixed = mixed.select(group) if among is None else mixed.join(among, group, "left_semi").select(group)
    return stored(placed.join(stored(mixed, "mixed", narrow=True), group, "left_semi"), "several")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The classes after links between them: only classes that are linked take part in the search for components."""
    if links.isEmpty():
        return roots
    moved = stored(components(links), "moved", narrow=True)
    kept = roots.join(moved.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    alone = moved.join(roots, "node", "left_anti")
    return stored(kept.select("node", F.coalesce("to", "root").alias("root")).unionByName(alone), "roots", narrow=True)


def link_classes(docs: DataFrame) -> DataFrame:
    """``node`` and ``root`` of every text (by digest) that is linked to another. ``docs`` has ``digest`` and ``text``."""
    buckets = buckets_of(docs)
    texts = _texts(docs, buckets)
    pairs = stored(_hub_pairs(buckets), "pairs")
    tried = pairs.select("a", "b")
    roots = stored(components(_verified(pairs, texts)), "roots", narrow=True)
    rows = _several(buckets, roots, "bucket")
    pairs = stored(_length_pairs(rows).join(tried, ["a", "b"], "left_anti"), "pairs")
    tried = tried.unionByName(pairs.select("a", "b"))
    roots = _merged(roots, _verified(pairs, texts))
    rows = _several(rows.drop("root"), roots, "bucket")
    buckets = rows.groupBy("digest").agg(F.collect_list("bucket").alias("buckets"))
    profiles = stored(texts.select("digest", "words", "profile").join(buckets, "digest"), "profiles")
    rows = _blocks(rows).withColumn("first", F.col("root"))
    done, most = 0, NEAREST
    while True:
        found = stored(_open_pairs(rows, profiles, done, most), "open")
        pairs = stored(found.where("a is not null").drop("left").join(tried, ["a", "b"], "left_anti"), "untried")
        roots = _merged(roots, _verified(pairs, texts))
        left = stored(found.where("left is not null").select(F.col("left").alias("block")).distinct(), "left", narrow=True)
        if left.isEmpty():
            return roots
        rows = _several(rows.drop("root"), roots, "block", left)
        done, most = most, most * MORE


def with_digest(docs: DataFrame, name: str = "digest") -> DataFrame:
    return docs.withColumn(name, F.unhex(F.md5(F.col("text").cast("binary"))))


def _classes(keyed: DataFrame) -> DataFrame:
    """``digest``, ``id`` (the least of its rows) and ``class``, the least ``id`` of its class. ``keyed`` has digest, text, id."""
    roots = link_classes(keyed)
    each = stored(keyed.where("digest is not null").groupBy("digest").agg(F.min("id").alias("id")), "texts", narrow=True)
    placed = each.join(roots.withColumnRenamed("node", "digest"), "digest", "left")
    placed = stored(placed.withColumn("root", F.coalesce("root", "digest")), "rooted")
    least = stored(placed.groupBy("root").agg(F.min("id").alias("class")), "classes", narrow=True)
    return placed.join(least, "root").select("digest", "id", "class")


def near_classes(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id`` and ``class_id``, the least doc_id among the documents like it."""
    keyed = with_digest(docs.select("doc_id", "text"))
    classes = stored(_classes(keyed.withColumn("id", F.col("doc_id"))).select("digest", "class"), "class-of")
    narrow = keyed.select("doc_id", F.col("digest").alias("own"))
    joined = narrow.join(classes, narrow["own"] == classes["digest"], "left")
    return joined.select("doc_id", F.when(F.col("own").isNull(), F.col("doc_id")).otherwise(F.col("class")).alias("class_id"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each class, the one with the least doc_id, all columns. ``docs`` must give its rows in the same order each
    time it is read, as stored tables do."""
    row = fresh(docs.columns, "row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    narrow = numbered.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(row).alias("row")).alias("id"), "text")
    classes = _classes(with_digest(narrow))
    kept = classes.where(F.col("id") == F.col("class")).select(F.col("id.row").alias(row))
    nulls = numbered.where("text is null").select(row)
    return numbered.join(stored(kept.unionByName(nulls), "kept"), row, "left_semi").drop(row)
