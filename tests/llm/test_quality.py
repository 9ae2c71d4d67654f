"""Quality rules against plain counting and a plain Kneser-Ney model."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import cases
from mallflow.llm import quality
from mallflow.llm.queries import registry

SF_DIR = "/root/testdata/sf0.001"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def plain_model(texts: list[str], order: int, untaught: list[str] = ()) -> dict[str, float]:
    """Interpolated modified Kneser-Ney over characters, by the book; ``untaught`` texts bring runs, but no counts."""
    levels = [Counter(t[i : i + order] for t in texts for i in range(len(t) - order + 1))]
    levels[0].update({t[i : i + order]: 0 for t in untaught for i in range(len(t) - order + 1)})
    for _ in range(order - 1):
        levels.append(Counter(run[1:] for run, n in levels[-1].items() if n))
        levels[-1].update({run[1:]: 0 for run in levels[-2]})
    lower: dict[str, float] = {}
    for size, level in enumerate(reversed(levels), start=1):
        met = Counter(level.values())
        y = met[1] / (met[1] + 2 * met[2]) if met[1] else 0
        cut = {}
        for k in (1, 2, 3):
            raw = k - (k + 1) * y * met[k + 1] / met[k] if met[1] and met[k] else k / 2
            cut[k] = min(max(raw, 0.05), k - 0.05)
        cut[0] = 0
        total, left = defaultdict(float), defaultdict(float)
        for run, n in level.items():
            total[run[:-1]] += n
            left[run[:-1]] += cut[min(n, 3)]
        new = {}
        for run, n in level.items():
            below, all_ = lower[run[1:]] if size > 1 else 1 / len(level), total[run[:-1]]
            new[run] = (n - cut[min(n, 3)]) / all_ + left[run[:-1]] / all_ * below if all_ else below
        lower = new
    return lower


@pytest.fixture(scope="module")
def some_texts():
    return [cases.prose(i, 60) for i in range(12)] + ["größe 漢字漢字漢字 ok", "abc", ""]


def test_model_is_kneser_ney(spark, some_texts):
    docs = spark.createDataFrame([(t, "x") for t in some_texts] + [(t[::-1], None) for t in some_texts], "text string, lang string")
    rows = quality.kneser_ney(quality.run_counts(docs)).collect()
    for language, texts in (("x", some_texts), (None, [t[::-1] for t in some_texts])):
        got = {r["run"]: r["p"] for r in rows if r["lang"] == language}
        want = plain_model(texts, quality.ORDER)
        assert got.keys() == want.keys()
        assert all(math.isclose(got[r], want[r], rel_tol=1e-9) for r in want)


SYMBOLS = set("#*$%&|<>")


def _plain_median(values):
    values = sorted(values)
    low, high = (len(values) - 1) // 2, len(values) // 2
    return (values[low] + values[high]) / 2


@pytest.mark.parametrize("size", [quality.MODEL_BYTES, 0])
def test_perplexities_and_verdicts(spark, size):
    """Scores, bands and verdicts of whole documents against the plain model, for arrays and for the join."""
    texts = [cases.prose(i, 60 + i) for i in range(60)] + [" | ".join(cases.prose(90 + i, 70).split()) for i in range(5)]
    texts += [" ".join(w + "%%%" for w in cases.prose(70, 80).split()), "漢字 " * 30 + cases.prose(71, 60), "größe # " + cases.prose(72, 55), "ab", ""]
    rows = [(i, t, "x" if i % 3 else None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r["quality"] for r in quality.quality(docs, ["doc_id"], model_bytes=size).collect()}
    for language in ("x", None):
        mine = [(i, t) for i, t, lang in rows if lang == language]
        odd = {i for i, t in mine if sum(c in SYMBOLS for c in t) > quality.TAUGHT_SYMBOLS * len(cases.words(t))}
        assert odd
        model = plain_model([t for i, t in mine if i not in odd], quality.ORDER, [t for i, t in mine if i in odd])
        ppl = {}
        for i, t in mine:
            runs = [t[k : k + quality.ORDER] for k in range(len(t) - quality.ORDER + 1)]
            if runs:
                ppl[i] = -sum(math.log(model[r]) for r in runs) / len(runs)
                assert math.isclose(got[i]["log_ppl"], ppl[i], abs_tol=1e-6)
            else:
                assert got[i]["log_ppl"] is None
        steps = [round(got[i]["log_ppl"] / quality._STEP) for i in ppl if not got[i]["base_failed"]]
        middle = _plain_median(steps)
        width = max(_plain_median([abs(x - middle) for x in steps]) * quality._STEP, quality.LEAST_DEVIATION)
        low, high = middle * quality._STEP - quality.BELOW * width, middle * quality._STEP + quality.ABOVE * width
        for i, _ in mine:
            assert got[i]["kept"] == (not got[i]["base_failed"] and (i not in ppl or low <= got[i]["log_ppl"] <= high))
        assert not any(got[i]["kept"] for i in odd)


def test_probabilities_of_a_context_add_up(spark, some_texts):
    docs = spark.createDataFrame([(t, "x") for t in some_texts], "text string, lang string")
    # With every run of the lower orders seen, what follows a context has probability 1 at most.
    sums = quality.kneser_ney(quality.run_counts(docs)).groupBy(F.substring("run", 1, quality.ORDER - 1)).agg(F.sum("p").alias("p"))
    assert 0 < sums.agg(F.max("p")).first()[0] <= 1 + 1e-9


def test_counter_with_many_characters(spark, monkeypatch):
    monkeypatch.setattr(quality, "_LETTER_BITS", 3)
    texts = [cases.prose(1, 40), "".join(chr(0x4E00 + i) for i in range(60)), cases.prose(2, 40)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["x", "x", "y"])], ["text", "lang"])
    got = Counter()
    for rows in quality._count_task(iter([batch])):
        for row in rows.to_pylist():
            got[row["lang"], row["run"]] += row["n"]
    want = Counter((lang, t[i : i + 5]) for t, lang in zip(texts, "xxy", strict=True) for i in range(len(t) - 4))
    assert got == want


def test_hash_arrays_find_every_key():
    keys = np.random.default_rng(1).integers(0, 1 << 64, 5000, dtype=np.uint64)
    keys[:3] = [0, 1, (1 << 64) - 1]
    arrays = quality.HashArrays(keys, np.arange(5000))
    assert (arrays.find(keys) == np.arange(5000)).all()
    assert np.isnan(arrays.find(keys + np.uint64(1) ^ np.uint64(0x55))).mean() > 0.99
    assert np.isnan(quality.HashArrays(keys[:0], keys[:0]).find(keys)).all()


def test_query_counts(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = registry()["op4_quality"](spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    for row in rows:
        want = cases.base_counts(docs[row["doc_id"]])
        assert tuple(row[c] for c in COUNTS) == want
        assert row["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (row["base_failed"] and row["kept"])


def test_clean_documents_are_kept(spark):
    rows = registry()["op4_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    kept = rows.join(labels, "doc_id").where("not base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert kept > 0.98


def test_labelled_junk_is_rejected(spark):
    """Of the labelled junk that passes the counts the bands catch nearly all, and hardly any good document."""
    rows = registry()["op4_quality"](spark, "/root/testdata/sf0.01").where("not base_failed")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = {r["quality"]: r for r in rows.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect()}
    assert kept[0]["n"] > 20 and kept[0]["kept"] < 0.05
    assert kept[1]["n"] > 200 and kept[1]["kept"] > 0.98


def test_bands_reject_both_ends(spark):
    plain = [(i, cases.prose(i, 150), "x") for i in range(300)]
    odd = [(900, " ".join("zq%d" % (i * 7919 % 10007) for i in range(150)), "x"), (901, " ".join(cases.prose(i, 1) + "#*" for i in range(150)), "x")]
    rows = quality.quality(spark.createDataFrame(plain + odd, "doc_id bigint, text string, lang string"), ["doc_id"]).collect()
    kept = {r["doc_id"]: r["quality"]["kept"] for r in rows}
    assert not kept[900] and not kept[901]
    assert sum(kept[i] for i in range(300)) >= 298


def test_awkward_documents(spark):
    docs = cases.documents(spark)
    rows = quality.quality(docs, into="verdict").collect()
    assert len(rows) == docs.count() and rows[0].__fields__ == [*docs.columns, "verdict"]
    for row in rows:
        assert tuple(row["verdict"][c] for c in COUNTS) == cases.base_counts(row["text"])
    assert quality.quality(cases.no_documents(spark), into="verdict").collect() == []


def test_join_gives_the_same_scores(spark):
    docs = cases.documents(spark)
    order = ["doc_id", "n_words", "word_chars", "kept", "low"]
    show = [F.col("v.n_words"), F.col("v.word_chars"), F.col("v.kept"), F.col("v.log_ppl").alias("low")]
    small, large = (
        sorted(map(str, quality.quality(docs, ["doc_id"], "v", size).select("doc_id", *show).select(order).collect()))
        for size in (quality.MODEL_BYTES, 0)
    )
    assert small == large


def test_the_model_is_sent_once(spark, some_texts, monkeypatch):
    """Also when documents are scored twice, for their bands and for their verdicts."""
    sent, send = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(type(value)) or send(self, value))
    docs = spark.createDataFrame([(i, text, "en") for i, text in enumerate(some_texts)], "doc_id bigint, text string, lang string")
    assert quality.quality(docs).count() == len(some_texts)
    assert sent.count(quality.HashArrays) == 1
