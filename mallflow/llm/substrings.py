"""Removal of passages that occur twice: prefix-partitioned, sparse suffix trees over words.

A passage of ``length`` words or more that occurs twice is found through its anchors. In every run of ``length`` words, the word
whose next ``PREFIX`` words have the least hash is the run's anchor: equal runs have their anchor at the same place, and about one
word in fourteen is one. Only suffixes that start at anchors are put into trees, each with the words before it that its runs reach
back to.

The suffixes are split by their first ``PREFIX`` words. Those whose prefix occurs once have no partner and end there, as a key and two
numbers: only suffixes with a repeated prefix move with their words. Prefixes with more than ``GROUP`` suffixes are lengthened to the
whole run, below which no node is left to find: counting the runs settles them, however many there are. Each other group becomes one
subtree. Its suffixes are sorted by their words and common-prefix depths of neighbours give the nodes; the words before the anchors,
read backwards, make a second tree. A run whose anchor stands ``o`` words after its start is repeated when two suffixes or more share
a node of depth ``length - o`` in the first and one of depth ``o`` in the second. Repeated runs that follow one another in a text make
up its longest repeated stretches (:func:`repeated_stretches`).

The first ``PREFIX`` words are hashed to deal suffixes to groups; within a group words are compared as they are, those of over
``_LONG_WORD`` bytes by SHA-256. Runs with a common prefix are counted by 128 bits of their words. Equal suffixes of one piece of the
input are merged by 64 bits of their runs, so that a passage that stands in a third of all documents stays a few rows.

Defined results: a null text has no words and an empty result; a text shorter than ``length`` words is kept whole; equal texts are
repeats of each other; repeated rows are two texts. Rows are numbered where they are read: ``docs`` must give its rows in the same
order each time it is read, as stored tables do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallflow.llm.frames import add_in_batches, fresh, in_batches, stored
from mallflow.llm.words import Chunk, chunks, grams, mix

LENGTH = 35
PREFIX = 8
GROUP = 1 << 10
# Runs have an anchor at most 63 words on, and a suffix is the anchor of at most 63 runs.
_MOST_LENGTH = 63 + PREFIX - 1
# Suffixes that are sorted at a time, whole groups each.
_HELD_ROWS = 1 << 14
# Equal suffixes are merged within texts of so many bytes.
_MERGED_BYTES = 1 << 19
_LONG_WORD = 32

# A suffix's place: the word number of its first run, the words from there to the anchor, the number of its runs, and these marks.
# One of several equal ones of its piece of the input; one of the others, for which the first stands; one with a common prefix.
_SEVERAL, _KNOWN, _COMMON = 1, 2, 4
_MARKS, _NUMBER = 3, 6

_RUNS = "row bigint, first bigint, bits bigint"
_PARTS = T.StructType(
    [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("text", T.StringType())]
)


def _packed(first: np.ndarray, back: np.ndarray, n: np.ndarray, marks: np.ndarray) -> np.ndarray:
    return ((((first << _NUMBER) | back) << _NUMBER | n) << _MARKS) | marks


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    low = (1 << _NUMBER) - 1
    rest = place >> _MARKS
    return rest >> 2 * _NUMBER, (rest >> _NUMBER) & low, rest & low, place & ((1 << _MARKS) - 1)


def _marked(place: str, marks: int) -> Column:
    return F.col(place).bitwiseAND(F.lit(marks)) != 0


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


class _Suffixes:
    """The suffixes of a chunk that start at anchors, with the runs that have them as their anchor."""

    def __init__(self, chunk: Chunk, length: int):
        prefixes = grams(chunk.hashes, PREFIX)
        starts = np.flatnonzero(chunk.room() >= length)
        bits = np.uint64(max(1, int(len(prefixes)).bit_length()))
        places = np.arange(len(prefixes), dtype=np.uint64)
        ranked = (prefixes >> bits << bits) | places
        least = _least(ranked, length - PREFIX + 1)
        anchors = (least[starts] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        self.whole = grams(chunk.hashes, length)[starts]
        new = np.concatenate([[True], (np.diff(starts) != 1) | (np.diff(anchors) != 0)])[: len(starts)]
        self.low = np.flatnonzero(new)
        self.high = np.concatenate([self.low[1:], [len(starts)]])[: len(self.low)]
        head = starts[self.low]
        self.key = prefixes[anchors[self.low]]
        self.back = anchors[self.low] - head
        self.text = np.searchsorted(chunk.edges, head, side="right") - 1
        self.first = head - chunk.edges[self.text]

    def marks(self) -> np.ndarray:
        """The marks of each suffix, when equal ones are told from the first of them."""
        if not len(self.key):
            return np.zeros(0, np.int64)
        size = self.high - self.low
        ends = np.cumsum(size)
        flat = np.repeat(self.low - (ends - size), size) + np.arange(ends[-1])
        step = np.arange(ends[-1]) - np.repeat(ends - size, size)
        sums = np.add.reduceat(mix(self.whole[flat] + step.astype(np.uint64)), ends - size)
        same = mix(self.key + mix(sums + self.back.astype(np.uint64)))
        _, first, number = np.unique(same, return_index=True, return_counts=True)
        marks = np.full(len(same), _KNOWN, np.int64)
        marks[first] = np.where(number > 1, _SEVERAL, 0)
        return marks


# --- suffixes that have a partner ----------------------------------------------------------------


def _count_task(length: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0), limit=_MERGED_BYTES):
                found = _Suffixes(chunk, length)
                marks = found.marks()
                some = marks != _KNOWN
                key, where, number = np.unique(found.key[some], return_inverse=True, return_counts=True)
                more = np.bincount(where[marks[some] == _SEVERAL], minlength=len(key))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(number), pa.array(number + more)], ["key", "n", "leaves"]
                )

    return work


def _place_task(length: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1), limit=_MERGED_BYTES):
                found = _Suffixes(chunk, length)
                marks = found.marks()
                row = batch.column(0).take(pa.array(found.text + chunk.rows.start))
                # Known ones need no partner; their row number deals them out as well as any key.
                key = np.where(marks == _KNOWN, np.asarray(row), found.key.view(np.int64))
                place = _packed(found.first, found.back, found.high - found.low, marks)
                yield pa.RecordBatch.from_arrays([pa.array(key), row, pa.array(place)], ["key", "row", "place"])

    return work


def _with_partner(docs: DataFrame, length: int, group: int) -> DataFrame:
    """``row`` and ``places`` of the suffixes that may be repeated, or are known to be. Stored."""
    counts = in_batches(docs.select("text"), _count_task(length), "key bigint, n bigint, leaves bigint")
    counts = counts.groupBy("key").agg(F.sum("n").alias("n"), F.sum("leaves").alias("leaves")).where("leaves > 1")
    shared = stored(counts.select("key", (F.col("n") > group).alias("common")), "prefixes", narrow=True)
    places = in_batches(docs.select("row", "text"), _place_task(length), "key bigint, row bigint, place bigint")
    met = places.join(shared, "key", "left").where(F.col("common").isNotNull() | _marked("place", _KNOWN))
    common = F.col("common") & ~_marked("place", _KNOWN)
    place = F.when(common, F.col("place").bitwiseOR(F.lit(_COMMON))).otherwise(F.col("place"))
    # A list is no longer than its text.
    return stored(met.groupBy("row").agg(F.collect_list(place).alias("places")), "anchors")


class _Words:
    """The words of a chunk one after another, each with one space behind it."""

    def __init__(self, chunk: Chunk):
        size = chunk.ends - chunk.starts
        long = np.flatnonzero(size > _LONG_WORD)
        if len(long):
            raw = chunk.data.tobytes()
            words = [raw[low:high] for low, high in zip(chunk.starts.tolist(), chunk.ends.tolist(), strict=True)]
            for i in long.tolist():
                words[i] = hashlib.sha256(words[i]).hexdigest().encode()
            size = np.array([len(w) for w in words], np.int64)
            self.data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
        else:
            ends = np.cumsum(size + 1)
            flat = np.repeat(chunk.starts - (ends - size - 1), size + 1) + np.arange(ends[-1] if len(ends) else 0)
            self.data = np.append(chunk.data, np.uint8(32))[flat]
            self.data[ends - 1] = 32
        self.ends = np.concatenate([[0], np.cumsum(size + 1)])

    def slices(self, first: np.ndarray, n: np.ndarray) -> pa.Array:
        low, size = self.ends[first], self.ends[first + n] - self.ends[first] - 1
        tops = np.cumsum(size)
        flat = np.repeat(low - (tops - size), size) + np.arange(tops[-1] if len(tops) else 0)
        offsets = np.concatenate([[0], tops]).astype(np.int64)
        array = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(self.data[flat])])
        return array.cast(pa.binary())


# Suffixes that are handed on at a time.
_HANDED_ON = 1 << 12


def _slice_task(length: int, common: bool):
    """Suffixes with the words of their runs; those with common prefixes as single runs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1), limit=_MERGED_BYTES):
                lists = batch.column(2).slice(chunk.rows.start, len(chunk.rows))
                text = np.repeat(np.arange(len(chunk.rows)), np.asarray(lists.value_lengths()))
                place = np.asarray(lists.flatten())
                marks = place & ((1 << _MARKS) - 1)
                mine = (marks & _KNOWN == 0) & ((marks & _COMMON != 0) == common)
                text, place = text[mine], place[mine]
                if not len(place):
                    continue
                first, back, n, marks = _unpacked(place)
                if common:
                    row = np.repeat(np.arange(len(n)), n)
                    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                    text, first, back, marks = text[row], first[row] + step, back[row] - step, marks[row]
                    n = np.ones(len(row), np.int64)
                    place = _packed(first, back, n, marks)
                head = chunk.edges[text] + first
                key = grams(chunk.hashes, PREFIX)[head + back].view(np.int64)
                words = _Words(chunk)
                for low in range(0, len(head), _HANDED_ON):
                    part = slice(low, low + _HANDED_ON)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key[part]),
                            batch.column(0).take(pa.array(text[part] + chunk.rows.start)),
                            pa.array(place[part]),
                            words.slices(head[part], n[part] + length - 1),
                        ],
                        ["key", "row", "place", "words"],
                    )

    return work


# --- trees ---------------------------------------------------------------------------------------


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def _sorted_tree(first: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows by ``first`` and then by their words, and how many words each has in common with the one before it: the
    depth of the node where the two part; -1 where ``first`` differs."""
    order = np.lexsort((*words.T[::-1], first))
    same = words[order][1:] == words[order][:-1]
    depth = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    depth[first[order][1:] != first[order][:-1]] = -1
    return order, np.concatenate([[-1], depth])


def _at_depth(tree: tuple[np.ndarray, np.ndarray], depth: int) -> np.ndarray:
    """For each row, the number of its node at this depth (or of the edge that crosses it)."""
    order, common = tree
    node = np.empty(len(order), np.int64)
    node[order] = np.cumsum(common < depth)
    return node


def _deep_nodes(table: pa.Table, length: int) -> np.ndarray:
    """For each suffix of whole groups, a bit for every run of it that lies below deep nodes with two leaves or more."""
    _, back, n, marks = _unpacked(_numbers(table, "place"))
    group = np.cumsum(np.diff(_numbers(table, "key"), prepend=0) != 0)
    split = pc.split_pattern(table["words"].combine_chunks(), pattern=b" ")
    split = split.combine_chunks() if isinstance(split, pa.ChunkedArray) else split
    number = np.asarray(split.flatten().dictionary_encode().indices)
    ends = np.cumsum(n + length - 1)
    anchor = ends - (n + length - 1) + back

    def words(places: np.ndarray, there: np.ndarray) -> np.ndarray:
        return np.where(there, number[np.clip(places, 0, len(number) - 1)], -1)

    ahead, behind = anchor[:, None] + np.arange(length), anchor[:, None] - 1 - np.arange(length - PREFIX)
    right = _sorted_tree(group, words(ahead, ahead < ends[:, None]))
    left = _sorted_tree(np.zeros_like(group), words(behind, np.arange(length - PREFIX) < back[:, None]))
    leaves = np.where(marks & _SEVERAL != 0, 2, 1)
    bits = np.zeros(len(n), np.int64)
    for before in range(length - PREFIX + 1):
        mine = np.flatnonzero((back >= before) & (back - n < before))
        both = (_at_depth(right, length - before)[mine] << 32) | _at_depth(left, before)[mine]
        _, node = np.unique(both, return_inverse=True)
        deep = np.bincount(node, weights=leaves[mine])[node] > 1
        bits[mine] |= deep.astype(np.int64) << (back[mine] - before)
    return bits


def _found(table: pa.Table, length: int) -> pa.RecordBatch:
    bits = _deep_nodes(table, length)
    some = bits != 0
    first = _unpacked(_numbers(table, "place"))[0]
    return pa.RecordBatch.from_arrays(
        [pa.array(_numbers(table, "row")[some]), pa.array(first[some]), pa.array(bits[some])], ["row", "first", "bits"]
    )


def _tree_task(length: int):
    """The subtrees of a partition, whose rows come in order of their group."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        most = _HELD_ROWS
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) < most:
                continue
            table = pa.Table.from_batches(held)
            keys = _numbers(table, "key")
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield _found(table.slice(0, cut), length)
            held = table.slice(cut).to_batches()
            # A group that is longer is waited for.
            most = max(_HELD_ROWS, 2 * (len(keys) - cut))
        if held:
            yield _found(pa.Table.from_batches(held), length)

    return work


def _common_runs(slices: DataFrame) -> DataFrame:
    """Runs with a common prefix that occur twice: counted inside the tasks first, looked up by their words."""
    first = F.shiftright("place", _MARKS + 2 * _NUMBER).alias("first")
    leaves = F.when(_marked("place", _SEVERAL), 2).otherwise(1).alias("leaves")
    runs = slices.select("row", first, leaves, F.unhex(F.md5("words")).alias("run"))
    twice = runs.groupBy("run").agg(F.sum("leaves").alias("leaves")).where("leaves > 1").select("run")
    found = runs.join(stored(twice, "common-runs"), "run", "left_semi")
    return found.select("row", "first", F.lit(1).cast("bigint").alias("bits"))


def repeated_runs(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Word numbers at which a run of ``length`` words starts that occurs elsewhere too.

    ``docs`` has ``row``, a number of its own for each row, and ``text``. A row holds a ``row`` and its ``found`` (first, bits): run
    ``first + i`` for bit ``i``.
    """
    if not PREFIX <= length <= _MOST_LENGTH:
        raise ValueError(f"length must be from {PREFIX} to {_MOST_LENGTH}")
    anchors = _with_partner(docs, length, group)
    place = anchors.select("row", F.explode("places").alias("place"))
    first, n = F.shiftright("place", _MARKS + 2 * _NUMBER), F.shiftright("place", _MARKS).bitwiseAND(F.lit((1 << _NUMBER) - 1))
    known = place.where(_marked("place", _SEVERAL | _KNOWN)).select(
        "row", first.alias("first"), (F.call_function("shiftleft", F.lit(1).cast("bigint"), n.cast("int")) - 1).alias("bits")
    )
    texts = docs.select("row", "text").join(anchors, "row").select("row", "text", "places")
    kind = "key bigint, row bigint, place bigint, words binary"
    slices = in_batches(texts, _slice_task(length, common=False), kind)
    groups = slices.repartition("key").sortWithinPartitions("key")
    runs = in_batches(groups, _tree_task(length), _RUNS).unionByName(known)
    if not place.where(_marked("place", _COMMON)).isEmpty():
        runs = runs.unionByName(_common_runs(in_batches(texts, _slice_task(length, common=True), kind)))
    return runs.groupBy("row").agg(F.collect_list(F.struct("first", "bits")).alias("found"))


def _starts_of(found: pa.Array, chunk: Chunk, length: int) -> np.ndarray:
    """Which words of a chunk start a repeated run; ``found`` has the lists of its texts."""
    starts = np.zeros(len(chunk.hashes) + 1, dtype=bool)
    size = np.array(found.value_lengths().fill_null(0))
    flat = found.flatten()
    first, bits = (np.asarray(flat.field(i)).astype(np.int64) for i in (0, 1))
    base = np.repeat(chunk.edges[:-1], size) + first
    for bit in range(length - PREFIX + 1):
        starts[base[(bits >> bit) & 1 == 1] + bit] = True
    return starts[:-1]


def _with_found(docs: DataFrame, length: int, group: int) -> tuple[DataFrame, str]:
    row, found = fresh(docs.columns, "row"), fresh([*docs.columns, "row"], "found")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    runs = repeated_runs(numbered.select(F.col(row).alias("row"), "text"), length, group)
    runs = runs.select(F.col("row").alias(row), F.col("found").alias(found))
    return numbered.join(runs, row, "left").drop(row), found


def repeated_stretches(docs: DataFrame, into: str = "stretches", length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``docs`` with the list ``into`` of ``low`` and ``high`` (exclusive): the longest stretches of words, in order, all of whose runs
    of ``length`` words occur elsewhere too. Stretches that overlap, but share no run, are two."""
    joined, found = _with_found(docs, length, group)
    text_at, found_at = joined.columns.index("text"), joined.columns.index(found)
    span = T.StructType([T.StructField("low", T.LongType()), T.StructField("high", T.LongType())])

    def make(batch: pa.RecordBatch) -> pa.Array:
        lows, highs, counts = [], [], []
        for chunk in chunks(batch.column(text_at)):
            starts = _starts_of(batch.column(found_at).slice(chunk.rows.start, len(chunk.rows)), chunk, length)
            at = np.flatnonzero(starts)
            text = chunk.text_of_word()[at]
            new = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(text, prepend=-1) != 0))
            last = np.append(new[1:], len(at))[: len(new)] - 1
            base = chunk.edges[text[new]]
            lows.append(at[new] - base)
            highs.append(at[last] + length - base)
            counts.append(np.bincount(text[new], minlength=len(chunk.rows)))
        low, high, count = (np.concatenate(x).astype(np.int64) for x in (lows, highs, counts))
        spans = pa.StructArray.from_arrays([pa.array(low), pa.array(high)], names=["low", "high"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), spans)

    return add_in_batches(joined, into, T.ArrayType(span), make, [found])


def remove_repeats(
    docs: DataFrame, keep: list[str] | None = None, into: str = "rest", length: int = LENGTH, group: int = GROUP
) -> DataFrame:
    """``keep`` (default: all columns) of ``docs`` with a struct ``into``: ``n_words``, ``n_removed`` and the kept words as ``text``,
    joined by one space."""
    keep = list(docs.columns if keep is None else keep)
    joined, found = _with_found(docs.select(*dict.fromkeys([*keep, "text"])), length, group)
    text_at, found_at = joined.columns.index("text"), joined.columns.index(found)

    def make(batch: pa.RecordBatch) -> pa.Array:
        words, removed, texts = [], [], []
        for chunk in chunks(batch.column(text_at)):
            at = np.flatnonzero(_starts_of(batch.column(found_at).slice(chunk.rows.start, len(chunk.rows)), chunk, length))
            gone = np.zeros(len(chunk.hashes) + 1, np.int64)
            gone[at] += 1
            np.subtract.at(gone, at + length, 1)
            kept = np.cumsum(gone[:-1]) == 0
            words.append(chunk.counts)
            left = np.concatenate([[0], np.cumsum(kept)])[chunk.edges]
            removed.append(chunk.counts - np.diff(left))
            texts.append(_rest(chunk, kept))
        fields = [pa.array(np.concatenate(c), pa.int64()) for c in (words, removed)]
        return pa.StructArray.from_arrays([*fields, pa.concat_arrays(texts)], names=_PARTS.fieldNames())

    return add_in_batches(joined, into, _PARTS, make, [c for c in joined.columns if c not in keep]).select(*keep, into)


def _rest(chunk: Chunk, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    starts, ends = chunk.starts[kept], chunk.ends[kept]
    owner = chunk.text_of_word()[kept]
    size = ends - starts + 1
    tops = np.cumsum(size)
    flat = np.repeat(starts - (tops - size), size) + np.arange(tops[-1] if len(tops) else 0)
    data = np.append(chunk.data, np.uint8(32))[flat]
    data[tops - 1] = 32
    # One space too many after each text's last word.
    total = np.bincount(owner, weights=size, minlength=len(chunk.rows)).astype(np.int64)
    last = np.cumsum(total)[total > 0] - 1
    data = np.delete(data, last)
    offsets = np.concatenate([[0], np.cumsum(np.maximum(total - 1, 0))])
    array = pa.Array.from_buffers(
        pa.large_string(), len(chunk.rows), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
    )
    return array.cast(pa.string())


ORACLE_SQL = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
run AS (
  SELECT r, k, array_to_string(words[k:k + {LENGTH - 1}], ' ') AS run
  FROM (SELECT r, words, unnest(range(1, len(words) - {LENGTH - 2})) AS k FROM doc WHERE len(words) >= {LENGTH})),
twice AS (SELECT run FROM run GROUP BY run HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(k, k + {LENGTH})) AS place FROM run SEMI JOIN twice USING (run)),
word AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM doc),
kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS rest FROM word ANTI JOIN gone USING (r, place) GROUP BY r)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)
"""
