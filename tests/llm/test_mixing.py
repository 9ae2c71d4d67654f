"""Soft membership on labels held out, and rates against their targets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from mallflow.llm import mixing
from mallflow.llm.queries import registry

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(session):
    return tuple(session.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    classifier = mixing.fit(docs, labels.where(fold > 0))
    held = docs.join(labels.where(fold == 0), "doc_id").select("text", mixing._domain().alias("domain"))
    found = mixing.memberships(held, classifier, "m", ("text",)).collect()
    truth = np.array([r["domain"] for r in found])
    guess = np.array([np.argmax(r["m"]["p"]) for r in found])
    assert (truth == guess).mean() > 0.94
    assert (guess[truth == 2] == 2).mean() > 0.7
    assert all(abs(sum(r["m"]["p"]) - 1) < 1e-6 for r in found)


def test_query_meets_the_targets(spark):
    rows = registry()["op2_soft_mix"](spark, SF_DIR)
    assert rows.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert rows.where("rate < 0 or rate is null").isEmpty()
    words = np.array(rows.agg(*[F.sum(F.col("rate") * F.col("n_words") * F.col(f"p_{d}")) for d in mixing.DOMAINS]).first())
    share = np.array([mixing.TARGETS[d] for d in mixing.DOMAINS])
    kept = rows.agg(F.sum(F.col("n_words") * F.col(f"p_{mixing.KEPT}"))).first()[0]
    total = kept / mixing.TARGETS[mixing.KEPT]
    assert np.abs((words / total - share) / share).max() < 0.03


def written_out(n, p, share, total, most):
    """The descent with every document's rate kept, and the least squares it goes to, by plain small steps."""
    share = share / share.sum()
    scale = np.maximum(share, mixing._LEAST_TARGET)
    slope = np.diag(1 / scale**2)
    step = 1 / np.linalg.eigvalsh((p * n[:, None]).T @ p / total / np.outer(scale, scale))[-1]
    rates = np.minimum(np.ones(len(n)), most)
    for _ in range(20_000):
        rates = np.clip(rates - step * p @ (slope @ ((rates * n) @ p / total - share)), 0, most)
    return (rates * n) @ p / total


@pytest.mark.parametrize("most", [None, 1.0])
def test_rates_are_least_squares(spark, most):
    """What the rates come to, against plain descent document by document: the targets, or as near as capped rates can get."""
    pick = np.random.default_rng(4)
    p = pick.dirichlet([0.5, 0.3, 0.2], 200)
    n = pick.integers(1, 400, 200)
    members = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p, strict=True)], "n_words bigint, p array<double>").repartition(4)
    targets, total = {"good": 0.2, "low": 0.5, "toxic": 0.3}, float(n.sum())
    if most is None:
        descent = mixing.descend(members, targets, total, None)
    else:
        with pytest.warns(UserWarning, match="of its target away"):
            descent = mixing.descend(members, targets, total, most)
    rates = descent.rates(p)[0]
    assert (rates >= 0).all() and rates.max() <= (most or np.inf)
    reached, share = (rates * n) @ p / total, np.array([0.2, 0.5, 0.3])
    assert descent.met == (most is None)
    assert abs(np.abs((reached - share) / share).max() - descent.off) < 1e-9
    assert np.abs(reached - written_out(n.astype(float), p, share, total, most or np.inf)).max() < 2e-2


def test_unreachable_target_stays_nonnegative(spark):
    members = spark.createDataFrame([(10, [0.9, 0.1, 0.0]), (20, [0.8, 0.2, 0.0])], "n_words bigint, p array<double>")
    rates = mixing.descend(members, {"good": 0.0, "low": 0.0, "toxic": 1.0}, 30.0, None).rates(np.array([[0.9, 0.1, 0.0], [0.8, 0.2, 0.0]]))[0]
    assert (rates >= 0).all() and rates.max() < 0.2


def test_sample_keeps_good_documents(spark, tables):
    docs, labels = tables
    kept = mixing.sampled(docs, labels).join(labels, "doc_id").groupBy(mixing._domain().alias("domain")).count()
    before = docs.join(labels, "doc_id").groupBy(mixing._domain().alias("domain")).count()
    share = {r["domain"]: r["n"] for r in kept.select("domain", F.col("count").alias("n")).collect()}
    whole = {r["domain"]: r["n"] for r in before.select("domain", F.col("count").alias("n")).collect()}
    assert share[0] > 0.97 * whole[0]
    # As many toxic documents to the good ones as the targets say, which is far fewer than there were.
    ratio = mixing.TARGETS["toxic"] / mixing.TARGETS["good"]
    assert 0.5 * ratio < share.get(2, 0) / share[0] < 1.5 * ratio < 0.5 * whole[2] / whole[0]


def test_awkward_documents(spark):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (3, 0, 0), (9, None, 1), (12, 0, None), (13, None, None), (None, 1, 0), (77, 1, 1)],
        "doc_id bigint, quality int, toxic int",
    )
    docs = cases.documents(spark)
    rows = mixing.mix(docs, labels).collect()
    assert len(rows) == len(cases.rows()) and all(r["rate"] >= 0 for r in rows)
    assert all(r["rate"] == 1 for r in rows if r["n_words"] == 0)
    taken = mixing.sampled(docs, labels)
    assert taken.columns == docs.columns and 0 < taken.count() <= len(cases.rows())
    none = cases.no_documents(spark)
    assert mixing.mix(none, labels).collect() == [] and mixing.sampled(none, labels).collect() == []
    assert len(mixing.mix(docs, labels.where("false")).collect()) == len(cases.rows())
