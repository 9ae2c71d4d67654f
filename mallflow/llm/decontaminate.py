"""Benchmark decontamination with a distributed positional inverted index.

The index is a stored table with one row per block of documents: for every term that some benchmark item uses, the places where it
stands, as (document of the block, word number) in order. Every word of every document is looked up and every document is in some
block, also one without a term. A phrase is found by intersecting its terms' lists after moving each by the term's place in the
phrase, from the term that is rarest in the whole corpus to the commonest, so a list is only read while something is left to find.
A block's lists stay in its row, so the documents' words are never shuffled.

A proximity match of a phrase is a place of its rarest term with every other term at most ``slop`` words before or behind it.

The benchmark is sent to the tasks in slices of about ``slice_words`` words; more slices mean more passes over the documents, with
the same results.

Defined results: a null text has no words; items without words are ignored; items with equal texts all count; a null item_id counts
as an item but is left out of the list of ids; repeated documents are judged each on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallflow.llm.frames import in_batches, stored
from mallflow.llm.words import FOLDED, chunks

WINDOW = 13
SLOP = 20
SLICE_WORDS = 1 << 18
BLOCK_BYTES = 1 << 20
# A document is contaminated when at least one word in so many is hit.
HIT_SHARE = 20

_FOUND = "block bigint, doc int, hit array<int>, items array<string>, n_items bigint, near array<string>"


# --- the benchmark -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Phrases:
    """The distinct windows of a slice of items, padded with -1, each with its words' places from the rarest term on."""

    windows: np.ndarray
    lengths: np.ndarray
    order: np.ndarray
    holders: list[list[int]]
    ids: list[str | None]


def _item_words(benchmark: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1), FOLDED):
                some = np.flatnonzero(chunk.counts)
                words = [chunk.hashes[chunk.edges[i] : chunk.edges[i + 1]].tobytes() for i in some]
                ids = batch.column(0).take(pa.array(some + chunk.rows.start))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(words, pa.binary()), pa.array(chunk.counts[some])], ["item_id", "words", "n"]
                )

    named = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return in_batches(named, work, "item_id string, words binary, n bigint")


def _slices(benchmark: DataFrame, slice_words: int) -> Iterator[tuple[list[str | None], list[np.ndarray]]]:
    """Ids and word hashes of the items, about ``slice_words`` words at a time."""
    items = stored(_item_words(benchmark), "items")
    total = items.agg(F.sum("n").alias("n")).first()["n"] or 0
    parts = -(-total // slice_words)
    for part in range(parts):
        mine = F.pmod(F.xxhash64("words", "item_id"), F.lit(parts)) == part
        rows = items.where(mine).select("item_id", "words").toArrow()
        if rows.num_rows:
            yield rows["item_id"].to_pylist(), [np.frombuffer(w, np.uint64) for w in rows["words"].to_pylist()]


def _phrases(ids: list[str | None], words: list[np.ndarray], terms: np.ndarray, frequency: np.ndarray, size: int) -> Phrases:
    holders: dict[tuple[int, ...], set[int]] = {}
    for item, hashes in enumerate(words):
        numbers = np.searchsorted(terms, hashes).tolist()
        for first in range(max(1, len(numbers) - size + 1)):
            holders.setdefault(tuple(numbers[first : first + size]), set()).add(item)
    windows = np.full((len(holders), size), -1, np.int32)
    for row, window in enumerate(holders):
        windows[row, : len(window)] = window
    often = np.where(windows >= 0, frequency[windows], np.iinfo(np.int64).max)
    lengths = (windows >= 0).sum(axis=1)
    return Phrases(windows, lengths, np.argsort(often, axis=1, kind="stable"), [sorted(h) for h in holders.values()], ids)


# --- the index -----------------------------------------------------------------------------------


def build_index(docs: DataFrame, terms: np.ndarray, id_column: str) -> DataFrame:
    """The stored index of ``docs`` for the given sorted term hashes: one row per block of documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for chunk in chunks(batch.column(1), FOLDED, BLOCK_BYTES):
                at = np.searchsorted(terms, chunk.hashes)
                at[at == len(terms)] = 0
                met = np.flatnonzero(terms[at] == chunk.hashes) if len(terms) else np.zeros(0, np.int64)
                term = at[met]
                by_term = np.argsort(term, kind="stable")
                met, term = met[by_term], term[by_term]
                first = np.flatnonzero(np.diff(term, prepend=-1))
                owner = np.searchsorted(chunk.edges, met, side="right") - 1
                lists = [
                    term[first].astype(np.int32),
                    np.diff(first, append=len(term)).astype(np.int32),
                    owner.astype(np.int32),
                    (met - chunk.edges[owner]).astype(np.int32),
                ]
                ids = batch.column(0).slice(chunk.rows.start, len(chunk.rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block]),
                        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                        pa.array([chunk.counts.tolist()], pa.list_(pa.int64())),
                        *(pa.array([a.tobytes()], pa.binary()) for a in lists),
                    ],
                    names,
                )
                block += 1

    narrow = docs.select(F.col(id_column).alias("id"), "text")
    kinds = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("ids", T.ArrayType(narrow.schema["id"].dataType)),
            T.StructField("words", T.ArrayType(T.LongType())),
            *(T.StructField(n, T.BinaryType()) for n in ("terms", "sizes", "owners", "places")),
        ]
    )
    names = kinds.fieldNames()
    return stored(in_batches(narrow, work, kinds), "index")


def _frequencies(index: DataFrame, n_terms: int) -> np.ndarray:
    """Occurrences of each term in the corpus; one row for each term of the slice comes to the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for held, sizes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[np.frombuffer(held, np.int32)] += np.frombuffer(sizes, np.int32)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "n"])

    counted = in_batches(index.select("terms", "sizes"), work, "term bigint, n bigint")
    rows = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n_terms, np.int64)
    out[rows["term"].to_numpy()] = rows["n"].to_numpy()
    return out


class Block:
    """The lists of one block. A place is one number that grows over the block's documents and leaves room between them."""

    def __init__(self, n_terms: int, room: int, words: list[int], held: bytes, sizes: bytes, owners: bytes, places: bytes):
        self.gap = max(words, default=0) + room
        terms, numbers = np.frombuffer(held, np.int32), np.frombuffer(sizes, np.int32)
        ends = np.cumsum(numbers, dtype=np.int64)
        self.first, self.last = np.full(n_terms, -1, np.int64), np.zeros(n_terms, np.int64)
        self.first[terms], self.last[terms] = ends - numbers, ends
        self.places = np.frombuffer(owners, np.int32).astype(np.int64) * self.gap + np.frombuffer(places, np.int32)

    def list_of(self, term: int) -> np.ndarray:
        return self.places[self.first[term] : self.last[term]]

    def usable(self, windows: np.ndarray) -> np.ndarray:
        """The windows that have all their terms in the block."""
        return np.flatnonzero(((self.first[windows] >= 0) | (windows < 0)).all(axis=1))

    def phrase(self, window: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Places where the window's words stand one after another."""
        starts = self.list_of(window[order[0]]) - order[0]
        for place in order[1:]:
            if not len(starts):
                break
            places = self.list_of(window[place])
            wanted = starts + place
            at = np.minimum(np.searchsorted(places, wanted), len(places) - 1)
            starts = starts[places[at] == wanted]
        return starts

    def near(self, window: np.ndarray, order: np.ndarray, slop: int) -> np.ndarray:
        """Places of the window's rarest word with every other word at most ``slop`` words away."""
        at_most = self.list_of(window[order[0]])
        for place in order[1:]:
            if not len(at_most):
                break
            places = self.list_of(window[place])
            at = np.searchsorted(places, at_most - slop)
            inside = at < len(places)
            at_most = at_most[inside][places[at[inside]] <= at_most[inside] + slop]
        return at_most


def _match_task(shared, n_terms: int, slop: int | None):
    def block_matches(phrases: Phrases, lists: Block) -> dict[int, tuple[set[int], set[int], set[int]]]:
        """Per document of the block: words hit, items with a phrase match, items with a proximity match."""
        found: dict[int, tuple[set[int], set[int], set[int]]] = {}
        for number in lists.usable(phrases.windows):
            size = int(phrases.lengths[number])
            window, order = phrases.windows[number], phrases.order[number, :size]
            for start in lists.phrase(window, order).tolist():
                doc, place = divmod(start, lists.gap)
                hit, items, _ = found.setdefault(doc, (set(), set(), set()))
                hit.update(range(place, place + size))
                items.update(phrases.holders[number])
            if slop is not None:
                for doc in np.unique(lists.near(window, order, slop) // lists.gap).tolist():
                    found.setdefault(doc, (set(), set(), set()))[2].update(phrases.holders[number])
        return found

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases: Phrases = shared.value
        room = 2 * (phrases.windows.shape[1] + (slop or 0))
        for batch in batches:
            for block, words, *lists in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = block_matches(phrases, Block(n_terms, room, words, *lists))
                docs = sorted(found)

                def ids(which: int, docs=docs, found=found) -> pa.Array:
                    return pa.array([[phrases.ids[i] for i in sorted(found[d][which])] for d in docs], pa.list_(pa.string()))

                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block] * len(docs), pa.int64()),
                        pa.array(docs, pa.int32()),
                        pa.array([sorted(found[d][0]) for d in docs], pa.list_(pa.int32())),
                        ids(1),
                        pa.array([len(found[d][1]) for d in docs], pa.int64()),
                        ids(2),
                    ],
                    ["block", "doc", "hit", "items", "n_items", "near"],
                )

    return work


# --- results -------------------------------------------------------------------------------------


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    slop: int | None = SLOP,
    slice_words: int = SLICE_WORDS,
    id_column: str = "doc_id",
) -> DataFrame:
    """One row per document: ``id_column``, ``n_words``, the numbers of the ``hit`` words, the ids of the ``items`` with a window
    that occurs and their number ``n_items``, and the ids of the items with a proximity match in ``near`` (none without ``slop``).
    """
    spark = docs.sparkSession
    index, parts = None, []
    for ids, words in _slices(benchmark, slice_words):
        terms = np.unique(np.concatenate(words))
        index = build_index(docs, terms, id_column)
        phrases = _phrases(ids, words, terms, _frequencies(index, len(terms)), size)
        shared = spark.sparkContext.broadcast(phrases)
        narrow = index.select("block", "words", "terms", "sizes", "owners", "places")
        parts.append(in_batches(narrow, _match_task(shared, len(terms), slop), _FOUND))
    if index is None:
        index, parts = build_index(docs, np.zeros(0, np.uint64), id_column), [spark.createDataFrame([], _FOUND)]

    def together(name: str) -> Column:
        return F.flatten(F.collect_list(name)).alias(name)

    # One row per slice and document at most.
    found = reduce(DataFrame.unionByName, parts).groupBy("block", "doc")
    found = found.agg(together("hit"), together("items"), F.sum("n_items").alias("n_items"), together("near"))
    every = index.select("block", F.posexplode(F.arrays_zip("ids", "words")).alias("doc", "row"))
    none = F.array().cast("array<string>")
    return every.join(found, ["block", "doc"], "left").select(
        F.col("row.ids").alias(id_column),
        F.col("row.words").alias("n_words"),
        F.coalesce(F.array_distinct("hit"), F.array().cast("array<int>")).alias("hit"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce(F.array_distinct("near"), none).alias("near"),
    )


def contaminated() -> Column:
    """Whether a row of :func:`matches` has enough words hit."""
    n_hit = F.size("hit")
    return (n_hit > 0) & (HIT_SHARE * n_hit >= F.col("n_words"))


def verdicts(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts, digest of the matched items and the verdict for each row of :func:`matches`."""
    items = F.array_join(F.array_sort("items"), ",")
    return found.select(
        id_column,
        "n_words",
        F.size("hit").cast("bigint").alias("n_hit"),
        "n_items",
        F.sha2(items.cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
        F.size("near").cast("bigint").alias("n_near"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, all columns. The verdict follows from the text, so equal texts share it."""
    digest = F.md5(F.col("text").cast("binary"))
    found = matches(docs.select(digest.alias("digest"), "text"), benchmark, slop=None, id_column="digest")
    bad = stored(found.where(contaminated()).select("digest").distinct(), "contaminated")
    return docs.join(bad, digest == bad["digest"], "left_anti")


_SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
ORACLE_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS words FROM documents),
item AS (SELECT row_number() OVER () AS i, CAST(item_id AS VARCHAR) AS item_id, {_SQL_WORDS} AS words FROM benchmark),
part AS (
  SELECT row_number() OVER () AS v, i, words[k:k + {WINDOW - 1}] AS words
  FROM (SELECT i, words, unnest(range(1, greatest(len(words) - {WINDOW - 1}, 1) + 1)) AS k FROM item WHERE len(words) > 0)),
word AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM doc),
phrase AS (SELECT v, i, len(words) AS n, array_to_string(words, ' ') AS phrase FROM part),
run AS (
  SELECT r, n, k, array_to_string(words[k:k + n - 1], ' ') AS phrase
  FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS k
        FROM doc, (SELECT DISTINCT n FROM phrase) WHERE len(words) >= n)),
met AS (SELECT r, k, run.n AS n, i FROM run JOIN phrase USING (phrase) WHERE run.n = phrase.n),
hit AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS place FROM met) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, i FROM met) JOIN item USING (i) GROUP BY r),
term AS (SELECT v, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM part),
often AS (SELECT word, count(*) AS n FROM word GROUP BY word),
rarest AS (
  SELECT v, word FROM (
    SELECT v, t.word, row_number() OVER (PARTITION BY v ORDER BY coalesce(n, 0), t.place) AS nth FROM term t LEFT JOIN often o ON t.word = o.word)
  WHERE nth = 1),
start AS (SELECT v, r, place FROM rarest JOIN word USING (word)),
close AS (
  SELECT s.v, s.r FROM start s JOIN term t ON s.v = t.v
  JOIN word w ON w.r = s.r AND w.word = t.word AND w.place BETWEEN s.place - {SLOP} AND s.place + {SLOP}
  GROUP BY s.v, s.r, s.place HAVING count(DISTINCT t.place) = (SELECT len(words) FROM part WHERE part.v = s.v)),
near AS (
  SELECT r, count(DISTINCT item_id) AS n_near FROM close JOIN part USING (v) JOIN item ON item.i = part.i GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {HIT_SHARE} * coalesce(n_hit, 0) >= len(words) AS contaminated, coalesce(n_near, 0) AS n_near
FROM doc LEFT JOIN hit USING (r) LEFT JOIN found USING (r) LEFT JOIN near USING (r)
"""
