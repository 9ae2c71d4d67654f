"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without white space at both ends and with A-Z lower-cased. :class:`LineRuns` keeps, in a folder, how many
documents each key was found in: *runs* are tables sorted by the 128-bit hash of the key, one row per key, and every run has a level.
A batch of documents is counted, merge-anti-joined with the keys that the runs have settled (found in ``at_least`` documents by now),
so that common lines are not carried along any further, and the rest becomes a run of level 0. When a level holds ``fanout`` runs they
are merged into one of the next level: counts of equal keys add up, and keys that reach ``at_least`` go into a settled run. With
``at_least=1`` every key is settled at once, and the anti-join leaves the lines that no earlier batch had (:meth:`LineRuns.unseen`).

The manifest has one small table per change; the newest names the runs that are live. A run is written whole before the manifest
names it, and a batch that is in the manifest is not added again, so a job that was lost on the way is simply run again.

Documents are then read once more, and lines with a settled key go. Positions of such lines are collected by text, not by row, so
that copies of one text are worked on once; a text's positions are the only thing gathered in one place. Everything is DataFrame
functions; a key on a third of all lines is one row after the map side of the count, and one row of the settled run.

Defined results: a null text counts as empty; an empty text is one empty line; each row is a document, also a repeated one, and a line
repeated in a document counts once; keys shorter than ``min_chars`` code points are never dropped; an empty table gives no rows; a
text whose lines are all dropped is empty. All columns of the input are kept, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallflow.llm.frames import fresh, stored, text_key
from mallflow.session import scratch_dir
from mallflow.sources.tables import scan

AT_LEAST = 10
MIN_CHARS = 1
FANOUT = 3
BATCHES = 6

_WHITE = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("h1", "h2", "n")])
_MANIFEST = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("step", T.LongType()),
    ]
)
_KEY = ["h1", "h2"]


def keys_of(text: Column) -> Column:
    """The keys of a text's lines, in order."""
    folded = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.transform(F.split(folded, "\n"), lambda line: F.btrim(line, F.lit(_WHITE)))


def _hashed(frame: DataFrame, *others: str, min_chars: int) -> DataFrame:
    """Column ``key`` replaced by its hash, short keys left out."""
    long_enough = frame.where(F.length("key") >= min_chars)
    return long_enough.select(*others, F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def key_counts(docs: DataFrame, *others: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """In how many documents each key is found, by ``others``, which are columns of ``docs``: ``h1``, ``h2``, ``n``."""
    lines = docs.select(*others, F.explode(F.array_distinct(keys_of(F.col("text")))).alias("key"))
    return _hashed(lines, *others, min_chars=min_chars).groupBy(*others, *_KEY).agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class _Entry:
    """A line of the manifest: a ``run``, a ``settled`` run, or a ``batch`` that has been added."""

    kind: str
    level: int
    name: str


class LineRuns:
    """Document counts of line keys in the folder ``root``, which every executor can reach."""

    def __init__(self, spark: SparkSession, root: str, at_least: int = AT_LEAST, fanout: int = FANOUT):
        if at_least < 1 or fanout < 2:
            raise ValueError("at_least must be 1 or more, fanout 2 or more")
        self.spark, self.root, self.at_least, self.fanout = spark, root.rstrip("/"), at_least, fanout
        self._entries, self._step = self._newest()

    def _newest(self) -> tuple[list[_Entry], int]:
        table = scan(self.spark, f"{self.root}/manifest", _MANIFEST)
        step = table.agg(F.max("step")).first()[0]
        if step is None:
            return [], 0
        # A few rows for each level and batch.
        rows = table.where(F.col("step") == step).collect()
        return [_Entry(r["kind"], r["level"], r["name"]) for r in rows], step

    def _commit(self, entries: list[_Entry]) -> None:
        rows = [(e.kind, e.level, e.name) for e in entries]
        table = self.spark.createDataFrame(rows, T.StructType(_MANIFEST.fields[:3])).coalesce(1)
        table.write.mode("overwrite").parquet(f"{self.root}/manifest/step={self._step + 1}")
        self._entries, self._step = entries, self._step + 1

    def live(self, kind: str = "run") -> list[tuple[int, str]]:
        """Level and name of the live runs."""
        return sorted((e.level, e.name) for e in self._entries if e.kind == kind)

    def _read(self, *names: str) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], _RUN)
        return self.spark.read.schema(_RUN).parquet(*[f"{self.root}/{name}" for name in names])

    def _write(self, counts: DataFrame, name: str) -> None:
        """One run in order of its keys: the files are ranges, and sorted."""
        ranged = counts.select(*_KEY, "n").repartitionByRange(*_KEY).sortWithinPartitions(*_KEY)
        ranged.write.mode("overwrite").parquet(f"{self.root}/{name}")

    def _settled(self) -> DataFrame:
        return self._read(*[name for _, name in self.live("settled")])

    def unseen(self, counts: DataFrame) -> DataFrame:
        """The rows of ``counts`` whose keys are not settled yet, by a merge-anti-join with the settled runs."""
        if not self.live("settled"):
            return counts
        return counts.join(self._settled().select(*_KEY).hint("merge"), _KEY, "left_anti")

    def add(self, batch: str, counts: DataFrame) -> None:
        """Add the counts (``h1``, ``h2``, ``n``, one row per key) of a batch's documents. A batch added before is passed over."""
        mark = _Entry("batch", 0, batch)
        if mark in self._entries:
            return
        name = f"run-{self._step + 1}"
        entries = [*self._entries, mark]
        if self.at_least == 1:
            self._write(self.unseen(counts), name)
            entries.append(_Entry("settled", 0, name))
        else:
            self._write(self.unseen(counts), name)
            entries.append(_Entry("run", 0, name))
        self._commit(entries)
        self._compact()

    def _compact(self) -> None:
        """Merge every level that is full into the next."""
        for kind in ("run", "settled"):
            while full := self._full(kind):
                self._merge(kind, *full)

    def _full(self, kind: str) -> tuple[int, list[str]] | None:
        levels: dict[int, list[str]] = {}
        for level, name in self.live(kind):
            levels.setdefault(level, []).append(name)
        return next(((level, names) for level, names in sorted(levels.items()) if len(names) >= self.fanout), None)

    def _merged(self, names: list[str]) -> DataFrame:
        return self._read(*names).groupBy(*_KEY).agg(F.sum("n").alias("n"))

    def _merge(self, kind: str, level: int, names: list[str]) -> None:
        rest = [e for e in self._entries if e.name not in names or e.kind == "batch"]
        name = f"{kind}-{self._step + 1}"
        if kind == "settled":
            self._write(self._merged(names), name)
            self._commit([*rest, _Entry("settled", level + 1, name)])
            return
        # Counts that were settled since these runs were written are of no more use.
        merged = stored(self.unseen(self._merged(names)), "merged")
        self._write(merged.where(F.col("n") < self.at_least), name)
        self._write(merged.where(F.col("n") >= self.at_least), f"{name}-settled")
        self._commit([*rest, _Entry("run", level + 1, name), _Entry("settled", 0, f"{name}-settled")])

    def common(self) -> DataFrame:
        """Keys found in ``at_least`` documents of all batches: ``h1``, ``h2``."""
        open_runs = self._merged([name for _, name in self.live()]).where(F.col("n") >= self.at_least)
        return self._settled().select(*_KEY).unionByName(open_runs.select(*_KEY)).distinct()


def counted(docs: DataFrame, batches: int = BATCHES, at_least: int = AT_LEAST, min_chars: int = MIN_CHARS, fanout: int = FANOUT) -> LineRuns:
    """The runs of a whole table, which is dealt into ``batches`` by a hash of the text. The text is read once."""
    spark = docs.sparkSession
    dealt = docs.select("text", F.pmod(F.xxhash64("text"), F.lit(batches)).cast("int").alias("batch"))
    root = scratch_dir(spark, "lines")
    key_counts(dealt, "batch", min_chars=min_chars).write.partitionBy("batch").parquet(f"{root}/counts")
    counts = scan(spark, f"{root}/counts", T.StructType([*_RUN.fields, T.StructField("batch", T.IntegerType())]))
    runs = LineRuns(spark, f"{root}/runs", at_least, fanout)
    for batch in range(batches):
        runs.add(str(batch), counts.where(F.col("batch") == batch).drop("batch"))
    return runs


def drop_lines(docs: DataFrame, common: DataFrame, min_chars: int = MIN_CHARS, into: str = "lines") -> DataFrame:
    """``docs`` with the struct ``into``: ``n_lines``, ``n_dropped`` and ``text``, the text without lines whose key is ``common``."""
    # Two steps, or the digest would be made again for every line.
    texts = docs.select(text_key().alias("text_id"), "text").where(F.col("text_id").isNotNull())
    places = texts.select("text_id", F.posexplode(keys_of(F.col("text"))).alias("place", "key"))
    hit = _hashed(places, "text_id", "place", min_chars=min_chars).join(stored(common, "common", narrow=True), _KEY, "left_semi")
    gone = hit.groupBy("text_id").agg(F.sort_array(F.collect_set("place")).alias("places"))
    gone = stored(gone, "dropped", narrow=True)

    mark, id_, places_ = (fresh([*docs.columns, into], name) for name in ("line_list", "text_id", "places"))
    gone = gone.select(F.col("text_id").alias("gone_id"), F.col("places").alias(places_))
    found = docs.withColumn(id_, text_key()).join(gone, F.col(id_) == F.col("gone_id"), "left")
    listed = found.drop("gone_id").withColumn(mark, F.split(F.coalesce("text", F.lit("")), "\n"))
    # One mark for each line and one behind the last, in time that grows with the lines. Arrays stay arguments: an array named inside
    # a function of one element would be made again for every element.
    ends, starts = F.concat(F.col(places_), F.array(F.size(mark))), F.concat(F.array(F.lit(-1)), F.col(places_))
    between = F.zip_with(ends, starts, lambda end, start: end - start - 1)
    marks = F.flatten(F.transform(between, lambda n: F.concat(F.array_repeat(F.lit(True), n), F.array(F.lit(False)))))
    left = F.array_join(F.zip_with(mark, marks, lambda line, stays: F.when(stays, line)), "\n")
    kept = F.when(F.col(places_).isNull(), F.coalesce("text", F.lit(""))).otherwise(left)
    made = F.struct(
        F.size(mark).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(places_), F.lit(0)).cast("bigint").alias("n_dropped"),
        kept.alias("text"),
    )
    return listed.withColumn(into, made).select(*docs.columns, into)


def drop_common_lines(docs: DataFrame, at_least: int = AT_LEAST, min_chars: int = MIN_CHARS, batches: int = BATCHES, into: str = "lines") -> DataFrame:
    """``docs`` without the lines found in ``at_least`` documents, as :func:`drop_lines`."""
    runs = counted(docs, batches, at_least, min_chars)
    return drop_lines(docs, runs.common(), min_chars, into)


ORACLE_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key FROM lines),
common AS (
  SELECT key FROM keyed WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {AT_LEAST})
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c ON k.key = c.key
GROUP BY doc_id
"""
