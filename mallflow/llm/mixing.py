"""Mixing to target weights with soft membership.

A softmax classifier, fitted on labelled documents, gives each document a probability for every domain. The documents' words then
count towards the domains by these probabilities, and the documents get rates (expected numbers of copies, none negative) such that
the expected words of each domain meet the targets: the least squares of the relative errors, by projected gradient with momentum
from a rate of 1. A rate depends on nothing but the document's own probabilities and the errors of the rounds so far, a few numbers
each, so no state is kept for documents: a task works the rounds through for its documents, and a round is one sum over the corpus.

The classifier sees at most ``SAMPLE`` labelled documents, those with the least hash of their id; everything else covers all rows. Its
features are the text's words, hashed to ``BUCKETS`` marks, and some shares (symbols, repeated words and lines, length).

Domains: ``toxic`` where the label says so, else ``low`` for quality 0 and ``good`` for quality 1. ``total`` words are aimed at; by
default as many as let the domain :data:`KEPT` keep its own.

Defined results: a null text has no words, so its rate is free of any effect and stays 1; labels without a document, documents
without a label, and labels with nulls are left out of the sample; a repeated label counts once for each row; without any labelled
document every domain is equally likely.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallflow.llm.frames import add_in_batches, fresh, in_batches, stored
from mallflow.llm.quality import text_counts
from mallflow.llm.words import FOLDED, Chunk, chunks

DOMAINS = ("good", "low", "toxic")
TARGETS = {"good": 0.92, "low": 0.06, "toxic": 0.02}
KEPT = "good"
SAMPLE = 8_000
_BITS = 18
BUCKETS = 1 << _BITS
_SHARES = 6
_EPOCHS, _PENALTY = 120, 1e-4
# Least G statistic of a mark: how far its share of the domains must be from chance.
_TELLING = 20.0
ROUNDS, CLOSE = 120, 0.02
# Errors are taken relative to the target, or to this share of the total where the target is less (0 has no relative error).
_LEAST_TARGET = 0.005
# Rounds without a gain of this share of the squared error: the least squares are reached, short of the targets.
_STALLED, _GAIN = 10, 1e-3

MEMBERSHIP = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("p", T.ArrayType(T.DoubleType()))])


# --- features and classifier ---------------------------------------------------------------------


def _features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks of each text's distinct words, how many each text has, and its shares."""
    buckets = chunk.hashes >> np.uint64(64 - _BITS)
    keys = np.sort((chunk.text_of_word().astype(np.uint64) << np.uint64(_BITS)) | buckets)
    keys = keys[np.diff(keys, prepend=~keys[:1]) != 0]
    number = np.bincount((keys >> np.uint64(_BITS)).astype(np.int64), minlength=len(chunk.rows))
    words, chars, symbols, lines, repeated = (c.astype(np.float64) for c in text_counts(chunk))
    n = np.maximum(words, 1)
    shares = np.stack(
        [symbols / np.maximum(chars, 1) * 10, repeated / n * 3, lines / n * 50, np.log1p(words) / 10, words < 50, np.ones_like(n)], 1
    )
    return (keys & np.uint64(BUCKETS - 1)).astype(np.int64), number, shares


@dataclass(frozen=True)
class Classifier:
    marks: np.ndarray
    shares: np.ndarray

    def probabilities(self, marks: np.ndarray, number: np.ndarray, shares: np.ndarray) -> np.ndarray:
        ends = np.cumsum(number)
        scores = shares @ self.shares
        sums = np.concatenate([np.zeros((1, len(DOMAINS))), np.cumsum(self.marks[marks], axis=0)])
        return _softmax(scores + sums[ends] - sums[ends - number])


def _softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def _domain() -> Column:
    return F.when(F.col("toxic") == 1, F.lit(2)).when(F.col("quality") == 0, F.lit(1)).when(F.col("quality") == 1, F.lit(0))


def _sample(docs: DataFrame, labels: DataFrame, size: int) -> pa.Table:
    """Features of at most ``size`` labelled documents, with their domain."""
    known = labels.select(F.col("doc_id").alias("labelled"), _domain().alias("domain")).where("labelled is not null and domain is not null")
    chosen = known.orderBy(F.xxhash64("labelled"), "labelled", "domain").limit(size)
    # At most ``size`` short rows.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1), FOLDED):
                marks, number, shares = _features(chunk)
                cuts = np.concatenate([[0], np.cumsum(number)])
                lists = [marks[a:b].astype(np.int32).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                domains = batch.column(0).slice(chunk.rows.start, len(chunk.rows))
                yield pa.RecordBatch.from_arrays([domains, pa.array(lists, pa.binary()), pa.array(shares.tolist())], names)

    names = ["domain", "marks", "shares"]
    return in_batches(rows.select("domain", "text"), work, "domain int, marks binary, shares array<double>").toArrow()


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Classifier:
    """Softmax regression on the sample, by full gradients with momentum."""
    table = _sample(docs, labels, size)
    k = len(DOMAINS)
    weights, of_shares = np.zeros((BUCKETS, k)), np.zeros((_SHARES, k))
    n = table.num_rows
    if not n:
        return Classifier(weights.astype(np.float32), of_shares)
    lists = [np.frombuffer(m, np.int32) for m in table["marks"].to_pylist()]
    # Rows in a fixed order, whatever order the tasks ended in, so that the sums come out the same.
    order = sorted(range(n), key=lambda i: (table["domain"][i].as_py(), lists[i].tobytes()))
    lists = [lists[i] for i in order]
    domain = table["domain"].to_numpy()[order]
    shares = np.array(table["shares"].to_pylist())[order]
    marks, number = np.concatenate(lists).astype(np.int64), np.array([len(x) for x in lists])
    row = np.repeat(np.arange(n), number)
    truth = np.eye(k)[domain]
    used = _telling(marks, domain[row], np.bincount(domain, minlength=k))[marks]
    marks, row = marks[used], row[used]
    # Steps sized to how often a mark occurs, so that rare but telling words are learnt as fast as common ones.
    rate = 1.0 / (np.sqrt(np.bincount(marks, minlength=BUCKETS) / n) + 1e-2)[:, None] / 6
    speed, speed_shares = np.zeros_like(weights), np.zeros_like(of_shares)
    for _ in range(_EPOCHS):
        scores = shares @ of_shares
        for d in range(k):
            scores[:, d] += np.bincount(row, weights=weights[marks, d], minlength=n)
        off = (_softmax(scores) - truth) / n
        slope = np.stack([np.bincount(marks, weights=off[row, d], minlength=BUCKETS) for d in range(k)], 1) + _PENALTY * weights
        speed = 0.9 * speed - rate * slope
        speed_shares = 0.9 * speed_shares - 0.3 * (shares.T @ off)
        weights += speed
        of_shares += speed_shares
    return Classifier(weights.astype(np.float32), of_shares)


def _telling(marks: np.ndarray, domain: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which marks occur in the domains in other shares than chance would have it, by the G test."""
    met = np.stack([np.bincount(marks[domain == d], minlength=BUCKETS) for d in range(len(sizes))], 1).astype(float)
    n, some = sizes.sum(), met.sum(axis=1, keepdims=True)

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-9)), 0.0)

    return 2 * (part(met, some * sizes / n) + part(sizes - met, (n - some) * sizes / n)).sum(axis=1) > _TELLING


# --- rates ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Descent:
    """The rounds so far: errors of the domains, momentum, step length, the most a rate may be, and what the rates came to.

    ``off`` is the largest relative error of a domain; the targets are ``met`` if it is below :data:`CLOSE`.
    """

    errors: tuple[np.ndarray, ...]
    carried: tuple[float, ...]
    step: float
    most: float
    off: float = 0.0

    @property
    def met(self) -> bool:
        return self.off < CLOSE

    def rates(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rates after all rounds, and the point the next round looks at: a round carries on by some of its move."""
        before = ahead = np.minimum(np.ones(len(p)), self.most)
        for error, carry in zip(self.errors, self.carried, strict=True):
            now = np.clip(ahead - self.step * (p @ error), 0.0, self.most)
            ahead = np.clip(now + carry * (now - before), 0.0, self.most)
            before = now
        return before, ahead


def _sums(members: DataFrame, descent: Descent) -> np.ndarray:
    """Expected words of each domain at the rates, and at the point ahead of them."""
    shared = members.sparkSession.sparkContext.broadcast(descent)
    k = len(DOMAINS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, k))
        for batch in batches:
            if batch.num_rows:
                n = batch.column(0).to_numpy().astype(np.float64)
                p = np.asarray(batch.column(1).flatten()).reshape(-1, k)
                for i, rate in enumerate(shared.value.rates(p)):
                    total[i] += (rate * n) @ p
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * k)), pa.array(total.ravel())], ["place", "words"])

    rows = in_batches(members, work, "place bigint, words double").groupBy("place").agg(F.sum("words").alias("words"))
    out = np.zeros(2 * k)
    for row in rows.collect():
        out[row["place"]] = row["words"]
    return out.reshape(2, k)


def _curvature(members: DataFrame) -> np.ndarray:
    """Words by pairs of domains: how strongly a change of rates along one moves the other."""
    k = len(DOMAINS)
    pair = [F.sum(F.col("n_words") * F.col("p")[i] * F.col("p")[j]) for i in range(k) for j in range(k)]
    return np.array([x or 0.0 for x in members.agg(*pair).first()]).reshape(k, k)


def descend(members: DataFrame, targets: dict[str, float], total: float | None, most: float | None) -> Descent:
    """Rounds until every domain is within :data:`CLOSE` of its target, relative to it, until more rounds gain nothing, or until
    :data:`ROUNDS` are done. In the last two cases, as when a target asks for more words than there are, the rates are the least
    squares found, a warning says how far off they are, and the descent is not ``met``.

    ``members`` has ``n_words`` and ``p``.
    """
    most = float("inf") if most is None else most
    share = np.array([targets[d] for d in DOMAINS], float)
    share /= share.sum()
    scale = np.maximum(share, _LEAST_TARGET)
    here = _sums(members, Descent((), (), 0.0, most))[0]
    if total is None:
        total = here[DOMAINS.index(KEPT)] / share[DOMAINS.index(KEPT)]
    if not total:
        return Descent((), (), 0.0, most)
    bend = _curvature(members) / total / np.outer(scale, scale)
    descent = Descent((), (), 1.0 / max(np.linalg.eigvalsh(bend)[-1], 1e-9), most)
    rates, ahead, run, history = here, here, 0, [np.inf]
    for _ in range(ROUNDS):
        if np.abs((rates / total - share) / scale).max() < CLOSE:
            break
        if len(history) > _STALLED and history[-1] > (1 - _GAIN) * min(history[:-_STALLED]):
            break
        error = (ahead / total - share) / scale**2
        descent = Descent((*descent.errors, error), (*descent.carried, run / (run + 3)), descent.step, most)
        rates, ahead = _sums(members, descent)
        history.append(np.square((rates / total - share) / scale).sum())
        # Momentum that leads uphill is dropped.
        run = run + 1 if history[-1] < history[-2] else 0
    descent = replace(descent, off=float(np.abs((rates / total - share) / scale).max()))
    if not descent.met:
        warnings.warn(f"after {len(descent.errors)} rounds a domain is {descent.off:.3f} of its target away from it", stacklevel=2)
    return descent


def memberships(docs: DataFrame, classifier: Classifier, into: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with a struct ``into``: words of the text and the probabilities of its domains."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    at = docs.columns.index("text")

    def make(batch: pa.RecordBatch) -> pa.Array:
        words, found = [], []
        for chunk in chunks(batch.column(at), FOLDED):
            words.append(chunk.counts)
            found.append(shared.value.probabilities(*_features(chunk)))
        p = np.concatenate(found)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * len(DOMAINS), pa.int32()), pa.array(p.ravel()))
        return pa.StructArray.from_arrays([pa.array(np.concatenate(words)), flat], names=MEMBERSHIP.fieldNames())

    return add_in_batches(docs, into, MEMBERSHIP, make, drop)


def with_rates(members: DataFrame, descent: Descent, member: str, into: str) -> DataFrame:
    """``members`` with the documents' rates in a column ``into``; ``member`` is the struct of :func:`memberships`."""
    shared = members.sparkSession.sparkContext.broadcast(descent)
    at = members.columns.index(member)

    def make(batch: pa.RecordBatch) -> pa.Array:
        p = np.asarray(batch.column(at).field(1).flatten()).reshape(-1, len(DOMAINS))
        words = np.asarray(batch.column(at).field(0))
        return pa.array(np.where(words > 0, shared.value.rates(p)[0], min(1.0, shared.value.most)))

    return add_in_batches(members, into, T.DoubleType(), make)


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, total: float | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, its probabilities ``p_<domain>`` and its ``rate``."""
    classifier = fit(docs, labels)
    members = stored(memberships(docs.select("doc_id", "text"), classifier, "member", ("text",)), "members")
    descent = descend(members.select("member.*"), targets or TARGETS, total, None)
    rated = with_rates(members, descent, "member", "rate")
    each = [F.col("member.p")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)]
    return rated.select("doc_id", "member.n_words", *each, "rate")


def sampled(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The documents that a mix without repeats takes, all columns: each with a probability of its rate, which is at most 1. The
    draw is by a hash of id and text, so it is the same at every run."""
    classifier = fit(docs, labels)
    narrow = stored(memberships(docs.select("text"), classifier, "member", ("text",)).select("member.*"), "members")
    descent = descend(narrow, targets or TARGETS, None, 1.0)
    member, rate = fresh(docs.columns, "member"), fresh(docs.columns, "rate")
    rated = with_rates(memberships(docs, classifier, member), descent, member, rate)
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rated.where(draw < F.col(rate)).drop(member, rate)
