"""Quality rules: plain counts of a text, and its perplexity under a character n-gram model of its own language.

The model is modified Kneser-Ney over runs of ``ORDER`` characters. Spark counts the runs of all documents by language (runs are
summed inside each task before the shuffle), works out discounts, back-off weights and interpolated probabilities order by order
as SQL, and the top order is packed into arrays sorted by a 64-bit hash of language and run. Documents with more than
``TAUGHT_SYMBOLS`` symbols a word teach the model nothing, so that junk does not make itself likely: their runs are counted as
unseen, and get their probability by back-off. Every run of a scored document thus has its probability in the top order. A document
is rejected when its log perplexity lies outside its language's band, which is the median plus and minus a multiple of the median
absolute deviation.

The arrays are broadcast while they take at most ``model_bytes``; a larger model is joined to the documents' runs by hash. Logarithms
are kept as whole numbers of 2^-20 and added up without rounding, so both ways give the same perplexity to the last bit.

Defined results: a null text counts as empty; a text shorter than one run has no perplexity and is judged by the counts alone; a
null language is a language of its own; repeated rows are scored each on its own; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallflow.llm.frames import add_in_batches, fresh, in_batches, stored
from mallflow.llm.words import PLAIN, Chunk, chunks, grams, mix, spans_hash

ORDER = 5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Symbols a word from which a document teaches the model nothing.
TAUGHT_SYMBOLS = 0.1
# Width of the band on either side, in median absolute deviations, and the least deviation that is taken (in nats).
BELOW, ABOVE, LEAST_DEVIATION = 12.0, 7.0, 0.01
# Perplexities are put into steps of this many nats to find the medians: their number is bounded, so the medians are exact.
_STEP = 0.002
MODEL_BYTES = 128 << 20
_ENTRY_BYTES = 12
_UNIT = 1 << 20
_FEW_LANGUAGES = 100_000
_HELD = 1 << 19

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)

COUNTS = T.StructType([T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])
_SCORE = T.StructType([*COUNTS.fields, T.StructField("log_ppl", T.DoubleType())])


# --- counts of a text ----------------------------------------------------------------------------


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(flags, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _cover(n: int, firsts: np.ndarray, size: int) -> np.ndarray:
    """Which of ``n`` places lie in a run of ``size`` from one of the given first places."""
    steps = np.zeros(n + 1, dtype=np.int64)
    steps[firsts] += 1
    np.subtract.at(steps, np.minimum(firsts + size, n), 1)
    return np.cumsum(steps[:-1]) > 0


def _dup_lines(chunk: Chunk) -> np.ndarray:
    feeds = np.flatnonzero(chunk.data == 10)
    starts = np.unique(np.concatenate([chunk.bounds[:-1], feeds + 1]))
    starts = starts[starts < len(chunk.data)]
    ends = np.append(starts[1:], len(chunk.data))[: len(starts)]
    text = np.searchsorted(chunk.bounds, starts, side="right") - 1
    ends = ends - np.isin(ends - 1, feeds)
    wordy = np.searchsorted(chunk.starts, ends) > np.searchsorted(chunk.starts, starts)
    starts, ends, text = starts[wordy], ends[wordy], text[wordy]
    keys = mix(spans_hash(chunk.data, PLAIN[1], starts, ends) + text.astype(np.uint64) * _PRIMES[0])
    first = np.unique(keys, return_index=True)[1]
    n = len(chunk.rows)
    return np.bincount(text, minlength=n) - np.bincount(text[first], minlength=n)


def _repeat_words(chunk: Chunk) -> np.ndarray:
    runs = grams(chunk.hashes, 3)
    at = np.flatnonzero(chunk.room()[: len(runs)] >= 3)
    keys = mix(runs[at] + chunk.text_of_word()[at].astype(np.uint64) * _PRIMES[0])
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return _per_text(_cover(len(chunk.hashes), at[twice], 3), chunk.edges)


def text_counts(chunk: Chunk) -> list[np.ndarray]:
    """The five counts of each text, in the order of :data:`COUNTS`."""
    leads = (chunk.data & 0xC0) != 0x80
    return [
        chunk.counts,
        _per_text(leads & PLAIN[0][chunk.data], chunk.bounds),
        _per_text(_SYMBOLS[chunk.data], chunk.bounds),
        _dup_lines(chunk),
        _repeat_words(chunk),
    ]


# --- runs of characters --------------------------------------------------------------------------


def _language_hash(languages: list[str | None]) -> np.ndarray:
    hashes = {}
    for language in set(languages):
        raw = b"" if language is None else b"=" + language.encode()
        data = np.frombuffer(raw, np.uint8)
        hashes[language] = spans_hash(data, PLAIN[1], np.zeros(1, np.int64), np.array([len(data)]))[0]
    return np.array([hashes[language] for language in languages], np.uint64)


def _hash_runs(language: np.ndarray, character: Callable[[int], np.ndarray]) -> np.ndarray:
    """Hashes of runs: ``character(i)`` gives the i-th code point of every run."""
    total = language.copy()
    for i in range(ORDER):
        total += (character(i).astype(np.uint64) + np.uint64(1)) * _PRIMES[i]
    return mix(total)


def _points(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the chunk, and how many each text has."""
    points = np.frombuffer(chunk.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    points = np.where(points == 0, np.uint32(0xFFFD), points)
    return points, _per_text((chunk.data & 0xC0) != 0x80, chunk.bounds)


def _starts(lengths: np.ndarray) -> np.ndarray:
    """Which code points, but for the chunk's last few, are the first of a run."""
    ends = np.cumsum(lengths)
    open_ = np.ones(max(0, int(ends[-1]) - ORDER + 1), dtype=bool)
    for back in range(1, ORDER):
        at = ends - back
        open_[at[(at >= 0) & (at < len(open_))]] = False
    return open_


def _runs(chunk: Chunk, languages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of the chunk, text by text, and how many each text has."""
    points, lengths = _points(chunk)
    starts = _starts(lengths)
    n = len(starts)
    language = np.repeat(languages, lengths)[:n]
    return _hash_runs(language, lambda i: points[i : i + n])[starts], np.maximum(lengths - ORDER + 1, 0)


_LETTER_BITS = 12


class _RunCounter:
    """Runs of one language with their numbers. The characters met are numbered, so that a run is one number of 60 bits."""

    def __init__(self) -> None:
        self.letters = np.zeros(0x110000, np.uint16)
        self.known = [0]
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def learn(self, points: np.ndarray) -> bool:
        """Number the characters; False if there are too many different ones."""
        fresh_ = np.unique(points[self.letters[points] == 0])
        if len(self.known) + len(fresh_) > 1 << _LETTER_BITS:
            return False
        self.letters[fresh_] = np.arange(len(self.known), len(self.known) + len(fresh_), dtype=np.uint16)
        self.known += fresh_.tolist()
        return True

    def add(self, points: np.ndarray, starts: np.ndarray) -> None:
        n = len(starts)
        letters = self.letters[points].astype(np.uint64)
        keys = letters[:n].copy()
        for i in range(1, ORDER):
            keys <<= np.uint64(_LETTER_BITS)
            keys |= letters[i : i + n]
        self._keep(np.sort(keys[starts]), None)

    def _keep(self, keys: np.ndarray, numbers: np.ndarray | None) -> None:
        first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0)
        total = np.diff(first, append=len(keys)) if numbers is None else np.add.reduceat(numbers, first)
        self.parts.append((keys[first], total))
        self.held += len(first)

    def merge(self) -> None:
        if len(self.parts) > 1:
            keys, numbers = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            order = np.argsort(keys)
            self.parts, self.held = [], 0
            self._keep(keys[order], numbers[order])

    def rows(self) -> tuple[list[str], np.ndarray]:
        self.merge()
        if not self.parts:
            return [], np.zeros(0, np.int64)
        keys, numbers = self.parts[0]
        known, low = np.array(self.known, np.uint32), np.uint64((1 << _LETTER_BITS) - 1)
        shape = np.stack([known[((keys >> np.uint64(_LETTER_BITS * (ORDER - 1 - i))) & low).astype(np.int64)] for i in range(ORDER)], 1)
        return np.ascontiguousarray(shape).view(f"<U{ORDER}").ravel().tolist(), numbers


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct runs of a task with their numbers, 0 in documents that teach nothing; a task that meets very many hands them on part
    by part."""
    counters: dict[tuple[str | None, bool], _RunCounter] = {}

    def handed_on(kind: tuple[str | None, bool]) -> pa.RecordBatch:
        runs, numbers = counters.pop(kind).rows()
        language, taught = kind
        return pa.RecordBatch.from_arrays(
            [pa.array([language] * len(runs), pa.string()), pa.array(runs, pa.string()), pa.array(numbers * taught)], ["lang", "run", "n"]
        )

    for batch in batches:
        languages = batch.column(1).to_pylist()
        for chunk in chunks(batch.column(0)):
            points, lengths = _points(chunk)
            own = list(zip(languages[chunk.rows.start : chunk.rows.stop], _taught(chunk).tolist(), strict=True))
            for kind in dict.fromkeys(own):
                mine = np.array([x == kind for x in own])
                if mine.all():
                    text, starts = points, _starts(lengths)
                else:
                    text, starts = points[np.repeat(mine, lengths)], _starts(lengths[mine])
                yield from _counted(counters, kind, text, starts, handed_on)
        if sum(c.held for c in counters.values()) > _HELD:
            for kind, counter in list(counters.items()):
                counter.merge()
                if counter.held > _HELD // 4 or len(counters) > 64:
                    yield handed_on(kind)
    for kind in list(counters):
        yield handed_on(kind)


def _taught(chunk: Chunk) -> np.ndarray:
    """Which texts the model learns from."""
    return _per_text(_SYMBOLS[chunk.data], chunk.bounds) <= TAUGHT_SYMBOLS * chunk.counts


def _counted(counters: dict, kind: tuple[str | None, bool], text: np.ndarray, starts: np.ndarray, handed_on) -> Iterator[pa.RecordBatch]:
    """Count a piece of text; what is held goes on first if its characters leave no room for the new ones."""
    if not starts.any():
        return
    counter = counters.setdefault(kind, _RunCounter())
    if not counter.learn(text):
        yield handed_on(kind)
        counter = counters.setdefault(kind, _RunCounter())
        if not counter.learn(text):
            # More characters than can be numbered at once: one half after the other, cut between two first places.
            del counters[kind]
            half = len(starts) // 2
            yield from _counted(counters, kind, text[: half + ORDER - 1], starts[:half], handed_on)
            yield from _counted(counters, kind, text[half:], starts[half:], handed_on)
            return
    counter.add(text, starts)


def run_counts(docs: DataFrame) -> DataFrame:
    """How often each run of characters occurs in the texts of each language that teach the model; 0 if in others only."""
    found = in_batches(docs.select("text", "lang"), _count_task, "lang string, run string, n bigint")
    return found.groupBy("lang", "run").agg(F.sum("n").alias("n"))


# --- the model -----------------------------------------------------------------------------------


def _discounts(of: DataFrame) -> DataFrame:
    """The three discounts of each language from its counts of counts."""
    met = of.groupBy("lang").agg(*[F.count_if(F.col("n") == k).cast("double").alias(f"n{k}") for k in range(1, 5)])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def discount(k: int) -> Column:
        raw = F.lit(float(k)) - (k + 1) * y * F.col(f"n{k + 1}") / F.nullif(f"n{k}", F.lit(0.0))
        safe = F.when((F.col("n1") > 0) & raw.isNotNull(), raw).otherwise(F.lit(k / 2))
        return F.least(F.greatest(safe, F.lit(0.05)), F.lit(k - 0.05)).alias(f"d{k}")

    return met.select("lang", *[discount(k) for k in (1, 2, 3)])


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """Interpolated modified Kneser-Ney probabilities ``p`` of every run, given all but its last character.

    A run with the number 0 was not seen; one whose context was not seen either has the probability of its shorter run.
    """
    levels = [counts]
    for size in range(order - 1, 0, -1):
        # Below the top order a run counts by the number of different characters seen before it.
        above = levels[-1]
        levels.append(above.groupBy("lang", F.substring("run", 2, size).alias("run")).agg(F.count_if(F.col("n") > 0).alias("n")))
    lower: DataFrame | None = None
    for size, level in enumerate(reversed(levels), start=1):
        rows = _with_discounts(level)
        context = Window.partitionBy("lang", F.substring("run", 1, size - 1))
        taken = F.when(F.col("n") == 0, 0.0).when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        total = F.nullif(F.sum("n").over(context), F.lit(0))
        rows = rows.withColumn("taken", taken).select(
            "lang",
            "run",
            F.coalesce((F.col("n") - F.col("taken")) / total, F.lit(0.0)).alias("own"),
            F.coalesce(F.sum("taken").over(context) / total, F.lit(1.0)).alias("left"),
        )
        if lower is None:
            alphabet = F.count(F.lit(1)).over(Window.partitionBy("lang"))
            below = rows.select("lang", "run", (F.col("own") + F.col("left") / alphabet).alias("p"))
        else:
            tail = lower.select(F.col("lang").alias("lang_"), F.col("run").alias("tail"), F.col("p").alias("p_"))
            on = F.col("lang").eqNullSafe(F.col("lang_")) & (F.substring("run", 2, size - 1) == F.col("tail"))
            below = rows.join(tail, on).select("lang", "run", (F.col("own") + F.col("left") * F.col("p_")).alias("p"))
        lower = below
    return lower


def _with_discounts(level: DataFrame) -> DataFrame:
    discounts = _discounts(level).withColumnRenamed("lang", "lang_")
    return level.join(discounts, F.col("lang").eqNullSafe(F.col("lang_"))).drop("lang_")


def _pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            language = _language_hash(batch.column(0).to_pylist())
            shape = np.array(batch.column(1).to_pylist(), f"<U{ORDER}").view(np.uint32).reshape(-1, ORDER)
            keys = _hash_runs(language, lambda i, shape=shape: shape[:, i])
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column(2)], ["key", "logp"])


def ngram_model(docs: DataFrame) -> DataFrame:
    """One row per run met in ``docs``: its hash ``key`` and the natural logarithm ``logp`` of its probability, in 2^-20. Stored."""
    counts = stored(run_counts(docs), "run-counts")
    logs = kneser_ney(counts).select("lang", "run", F.round(F.log("p") * _UNIT).cast("int").alias("logp"))
    return stored(in_batches(logs, _pack_task, "key bigint, logp int"), "ngram-model")


class HashArrays:
    """Keys in order with their values, and the place of the first key of every leading-bits bucket."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys = keys[order]
        self.values = values[order].astype(np.int32)
        self.bits = max(1, int(len(keys)).bit_length() + 1)
        edges = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.first = np.searchsorted(self.keys, edges).astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Values of the wanted keys; nan for a key that is not there."""
        out = np.full(len(wanted), np.nan)
        if not len(self.keys) or not len(wanted):
            return out
        last = len(self.keys) - 1
        at = np.minimum(self.first[(wanted >> np.uint64(64 - self.bits)).astype(np.int64)], last)
        open_ = np.arange(len(wanted))
        met = self.keys[at]
        while len(open_):
            hit = met == wanted[open_]
            out[open_[hit]] = self.values[at[hit]]
            on = (met < wanted[open_]) & (at < last)
            open_, at = open_[on], at[on] + 1
            met = self.keys[at]
        return out


# --- scores and verdicts -------------------------------------------------------------------------


def _shared(model: DataFrame, model_bytes: int) -> Broadcast[HashArrays] | None:
    """The model's arrays, sent to the executors once however often they score; None for a model too large to hold."""
    if model.count() * _ENTRY_BYTES > model_bytes:
        return None
    table = model.toArrow()
    arrays = HashArrays(table["key"].to_numpy().view(np.uint64), table["logp"].to_numpy())
    return model.sparkSession.sparkContext.broadcast(arrays)


def _scores(docs: DataFrame, model: DataFrame, shared: Broadcast[HashArrays] | None, into: str, keep: list[str]) -> DataFrame:
    """``keep`` of ``docs`` with a struct ``into`` of counts and log perplexity."""
    if shared is None:
        return _scores_by_join(docs, model, into, keep)
    places = {c: docs.columns.index(c) for c in ("text", "lang")}

    def make(batch: pa.RecordBatch) -> pa.Array:
        counts, ppl = [], []
        hashes = _language_hash(batch.column(places["lang"]).to_pylist())
        for chunk in chunks(batch.column(places["text"])):
            counts.append(text_counts(chunk))
            runs, n = _runs(chunk, hashes[chunk.rows.start : chunk.rows.stop])
            sums = np.concatenate([[0.0], np.cumsum(shared.value.find(runs), dtype=np.float64)])
            ends = np.cumsum(n)
            ppl.append(np.where(n > 0, (sums[ends - n] - sums[ends]) / np.maximum(n, 1) / _UNIT, np.nan))
        columns = [np.concatenate(column) for column in zip(*counts, strict=True)]
        score = np.concatenate(ppl)
        fields = [pa.array(c, pa.int64()) for c in columns] + [pa.array(score, pa.float64(), mask=np.isnan(score))]
        return pa.StructArray.from_arrays(fields, names=_SCORE.fieldNames())

    return add_in_batches(docs, into, _SCORE, make, [c for c in docs.columns if c not in keep])


def _scores_by_join(docs: DataFrame, model: DataFrame, into: str, keep: list[str]) -> DataFrame:
    """As :func:`_scores`, for a model too large to hold: each document's distinct runs are joined to it."""
    row, name = fresh(docs.columns, "row"), fresh(docs.columns, "counts")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")

    def count(batch: pa.RecordBatch) -> pa.Array:
        made = [text_counts(chunk) for chunk in chunks(batch.column(batch.schema.get_field_index("text")))]
        fields = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*made, strict=True)]
        return pa.StructArray.from_arrays(fields, names=COUNTS.fieldNames())

    def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hashes = batch.column(2).to_numpy(), _language_hash(batch.column(1).to_pylist())
            for chunk in chunks(batch.column(0)):
                runs, each = _runs(chunk, hashes[chunk.rows.start : chunk.rows.stop])
                text = np.repeat(np.arange(len(each)), each)
                order = np.lexsort((runs, text))
                runs, text = runs[order], text[order]
                new = np.flatnonzero(np.concatenate([[True], (runs[1:] != runs[:-1]) | (text[1:] != text[:-1])])[: len(runs)])
                number = np.diff(np.concatenate([new, [len(runs)]]))
                owner = rows[chunk.rows.start + text[new]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner), pa.array(runs[new].view(np.int64)), pa.array(number)], ["row", "key", "n"]
                )

    counted = add_in_batches(numbered, name, COUNTS, count, [c for c in docs.columns if c not in keep])
    met = in_batches(numbered.select("text", "lang", row), runs_of, "row bigint, key bigint, n bigint").join(model, "key")
    sums = met.groupBy("row").agg((-F.sum(F.col("n") * F.col("logp")) / F.sum("n") / _UNIT).alias("log_ppl"))
    joined = counted.join(sums.withColumnRenamed("row", row).withColumnRenamed("log_ppl", into), row, "left")
    score = F.struct(*[F.col(f"{name}.{c}") for c in COUNTS.fieldNames()], F.col(into).alias("log_ppl"))
    return joined.select(*keep, score.alias(into))


def _base_failed(score: str) -> Column:
    words, repeated = F.col(f"{score}.n_words"), F.col(f"{score}.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)


def bands(scores: DataFrame, score: str) -> DataFrame:
    """Lowest and highest accepted log perplexity of each language, from the documents that pass the counts. Stored."""
    step = F.round(F.col(f"{score}.log_ppl") / _STEP).cast("long")
    seen = scores.where(~_base_failed(score) & F.col(f"{score}.log_ppl").isNotNull())
    steps = stored(seen.groupBy("lang", step.alias("step")).agg(F.count(F.lit(1)).alias("n")), "ppl-steps")
    middle = steps.groupBy(F.col("lang").alias("lang_")).agg(F.expr("percentile(step, 0.5, n)").alias("middle"))
    off = steps.join(middle, F.col("lang").eqNullSafe(F.col("lang_"))).withColumn("off", F.abs(F.col("step") - F.col("middle")))
    spread = off.groupBy("lang").agg(
        F.first("middle").alias("middle"), F.expr("percentile(off, 0.5, n)").alias("off")
    )
    width = F.greatest(F.col("off") * _STEP, F.lit(LEAST_DEVIATION))
    middle_ppl = F.col("middle") * _STEP
    return stored(
        spread.select("lang", (middle_ppl - BELOW * width).alias("low"), (middle_ppl + ABOVE * width).alias("high")),
        "ppl-bands",
    )


def quality(docs: DataFrame, keep: list[str] | None = None, into: str = "quality", model_bytes: int = MODEL_BYTES) -> DataFrame:
    """``keep`` (default: all columns) of ``docs`` with a struct ``into``: the counts, log perplexity, ``base_failed`` and ``kept``.

    Scores are stored between finding the bands and using them, unless the text is among the columns to keep: then the documents are
    scored twice rather than stored once more.
    """
    keep = list(docs.columns if keep is None else keep)
    score = fresh(docs.columns, "score")
    model = ngram_model(docs)
    wanted = list(dict.fromkeys([*keep, "lang"]))
    shared = _shared(model, model_bytes)
    rows = _scores(docs, model, shared, score, wanted)
    if "text" in keep:
        band = bands(_scores(docs.select("text", "lang"), model, shared, score, ["lang"]), score)
    else:
        rows = stored(rows, "scores")
        band = bands(rows, score)
    # One row for each language; broadcast only if they are few.
    language, low, high = (fresh(docs.columns, name) for name in ("band_lang", "band_low", "band_high"))
    band = band.select(F.col("lang").alias(language), F.col("low").alias(low), F.col("high").alias(high))
    few = band.count() <= _FEW_LANGUAGES
    joined = rows.join(F.broadcast(band) if few else band, F.col("lang").eqNullSafe(F.col(language)), "left")
    failed = _base_failed(score)
    ppl = F.col(f"{score}.log_ppl")
    outside = F.coalesce((ppl < F.col(low)) | (ppl > F.col(high)), F.lit(False))
    verdict = F.struct(f"{score}.*", failed.alias("base_failed"), (~failed & ~outside).alias("kept"))
    return joined.select(*keep, verdict.alias(into))
