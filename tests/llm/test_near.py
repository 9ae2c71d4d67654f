"""Near-duplicates against plain edit distances and a plain search over all pairs."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

import cases
from mallflow.llm import near
from mallflow.llm.components import components
from mallflow.llm.queries import registry

SF_DIR = "/root/testdata/sf0.001"


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance():
    pick = random.Random(3)
    for _ in range(3000):
        letters = pick.choice([2, 4, 30])
        a = [pick.randrange(letters) for _ in range(pick.randint(0, 40))]
        b = list(a)
        for _ in range(pick.randint(0, 8)):
            at = pick.randint(0, len(b))
            if pick.random() < 0.4 or not b:
                b.insert(at, pick.randrange(letters))
            elif pick.random() < 0.5:
                b.pop(min(at, len(b) - 1))
            else:
                b[min(at, len(b) - 1)] = pick.randrange(letters)
        if pick.random() < 0.2:
            b = [pick.randrange(letters) for _ in range(pick.randint(0, 40))]
        limit, want = pick.randint(0, 20), plain_distance(a, b)
        assert near.banded_distance(a, b, limit) == (want if want <= limit else None)


def _classes(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_classes(texts: dict) -> dict:
    """Class of each id, by comparing all pairs that share a run of words."""
    seq = {i: cases.folded_words(t) for i, t in texts.items()}
    runs = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in seq.items()}
    links = []
    for a, b in combinations(texts, 2):
        if texts[a] is None or texts[b] is None:
            continue
        if texts[a] == texts[b]:
            links.append((a, b))
        elif seq[a] and seq[b] and len(runs[a] & runs[b]) * 3 > max(len(runs[a]), len(runs[b])):
            if near.banded_distance(seq[a], seq[b], max(len(seq[a]), len(seq[b])) // near.SHARE) is not None:
                links.append((a, b))
    return _classes(links, texts)


@pytest.mark.parametrize("n", [2, 30, 200])
def test_components(spark, n):
    pick = random.Random(n)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + pick.randrange(n), 100 + pick.randrange(n)) for _ in range(n)]
    edges += [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = _classes(edges, {x for e in edges for x in e if e[0] != e[1]})
    assert got == want


def test_query_finds_the_classes(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = registry()["op1_order_minhash"](spark, SF_DIR).collect()
    got = {r["doc_id"]: r["class_id"] for r in rows}
    assert len(rows) == len(texts)
    assert got == plain_classes(texts)


def test_chain_in_one_bucket(spark):
    """Copies of copies: the ends are unlike each other, and the hub is like only some, yet all are one class."""
    base = cases.prose(9, 300).split()
    chain = [base]
    for step in range(12):
        new = list(chain[-1])
        for k in range(12):
            new[(step * 25 + k * 2) % 300] = f"new{step}x{k}"
        chain.append(new)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(chain)], "doc_id bigint, text string")
    assert {r["class_id"] for r in near.near_classes(docs).collect()} == {0}


def test_order_matters(spark):
    parts = [cases.prose(20 + i, 40) for i in range(6)]
    turned = [" ".join(parts), " ".join(reversed(parts))]
    docs = spark.createDataFrame(list(enumerate(turned)), "doc_id bigint, text string")
    assert {r["class_id"] for r in near.near_classes(docs).collect()} == {0, 1}


def test_awkward_documents(spark):
    docs = cases.documents(spark)
    got = [(r["doc_id"], r["class_id"]) for r in near.near_classes(docs).collect()]
    assert len(got) == docs.count()
    want = {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8, 9: 9, 10: 10, 11: 10, 12: 12, 13: 13}
    assert all(c == want[d] for d, c in got if d is not None)
    kept = near.drop_near_copies(docs.coalesce(1))
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    # Null texts stay; of the rest, one row of each class.
    assert ids == sorted([1, 4, 4, 5, 7, 8, 9, 10, 12, 13, None, None], key=str)
    assert near.near_classes(cases.no_documents(spark)).collect() == []
    assert near.drop_near_copies(cases.no_documents(spark)).collect() == []


def _one_bucket(docs):
    once = docs.where("digest is not null").dropDuplicates(["digest"])
    rows = once.select("digest", F.size(F.split("text", " ")).alias("size"), F.lit(1).cast("bigint").alias("bucket"))
    return rows.withColumn("n", F.lit(once.count()))


def all_pairs(texts):
    seq = {i: cases.folded_words(t) for i, t in texts.items()}
    alike = [
        (a, b)
        for a, b in combinations(texts, 2)
        if near.banded_distance(seq[a], seq[b], max(len(seq[a]), len(seq[b])) // near.SHARE) is not None
    ]
    return _classes(alike, texts)


@pytest.mark.parametrize(("block", "nearest"), [(1000, 1), (4, 4)])
def test_one_bucket_against_all_pairs(spark, monkeypatch, block, nearest):
    """Whatever the block size and the number of pairs tried first, a bucket gives the classes of all its pairs."""
    monkeypatch.setattr(near, "BLOCK", block)
    monkeypatch.setattr(near, "NEAREST", nearest)
    monkeypatch.setattr(near, "buckets_of", _one_bucket)
    pick = random.Random(17)
    base = cases.prose(41, 60).split()
    texts = []
    for _ in range(90):
        words = list(base) if pick.random() < 0.7 or not texts else texts[pick.randrange(len(texts))].split()
        turn = pick.choice([0, 0, 0, 15, 30])
        words = words[turn:] + words[:turn]
        for k in pick.sample(range(len(words)), pick.choice([2, 8, 10, 14])):
            words[k] = f"n{pick.randrange(10**6)}"
        texts.append(" ".join(words + [f"t{k}" for k in range(pick.choice([0, 0, 5, 25]))]))
    want = all_pairs(dict(enumerate(texts)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert len(set(want.values())) > 3
    assert {r["doc_id"]: r["class_id"] for r in near.near_classes(docs).collect()} == want


def _large_bucket(spark, sizes, roots):
    rows = [(1, f"t{i:05d}".encode(), size, f"r{root}".encode(), len(sizes)) for i, (size, root) in enumerate(zip(sizes, roots, strict=True))]
    return spark.createDataFrame(rows, "bucket bigint, digest binary, size int, root binary, n bigint")


def _met(rows):
    """How often each pair of texts meets in a block."""
    met = {}
    for block in {row["block"] for row in rows}:
        for x, y in combinations(sorted((row["digest"], row["side"]) for row in rows if row["block"] == block), 2):
            if x[1] != y[1] or x[1] == 0:
                met[x[0], y[0]] = met.get((x[0], y[0]), 0) + 1
    return met


@pytest.mark.parametrize("block", [20, 6])
def test_blocks_of_a_large_bucket(spark, monkeypatch, block):
    """Every pair that may be linked meets in one block, and no pair twice; also those of parts and of classes with parts of their own."""
    monkeypatch.setattr(near, "BLOCK", block)
    pick = random.Random(8)
    sizes = [pick.randint(40, 160) for _ in range(60)]
    roots = [i if i % 3 else 0 for i in range(60)]
    met = _met(near._blocks(_large_bucket(spark, sizes, roots)).collect())
    assert set(met.values()) == {1}
    for i, j in combinations(range(60), 2):
        if roots[i] != roots[j] and abs(sizes[i] - sizes[j]) <= max(sizes[i], sizes[j]) // near.SHARE:
            assert (f"t{i:05d}".encode(), f"t{j:05d}".encode()) in met


def test_a_large_bucket_of_many_lengths_is_stored_twice_at_most(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 100)
    sizes = [60 + 2 * i for i in range(300)]
    assert near._blocks(_large_bucket(spark, sizes, range(300))).count() <= 2 * len(sizes)


def test_pairs_are_tried_and_emitted_once(spark, monkeypatch):
    """Near-copies that share many buckets make two first pairs a text at most, and unlike texts that share many are paired once."""
    pick = random.Random(5)
    base, half = cases.prose(50, 200).split(), cases.prose(51, 100).split()
    copies = [list(base) for _ in range(40)]
    for words in copies:
        for k in pick.sample(range(200), 2):
            words[k] = f"n{pick.randrange(10**6)}"
    # As many of each word, in another order: likely pairs by their words, and yet no links.
    turned = [half + pick.sample(half, len(half)) for _ in range(30)]
    texts = [" ".join(words) for words in copies + turned]
    want = all_pairs(dict(enumerate(texts)))
    sizes, store = {}, near.stored

    def stored(frame, label, narrow=False):
        kept = store(frame, label, narrow)
        if label in ("pairs", "open", "untried"):
            rows = [(r["a"], r["b"]) for r in kept.collect()]
            sizes.setdefault(label, []).extend(pair for pair in rows if pair[0] is not None)
        return kept

    monkeypatch.setattr(near, "stored", stored)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r["doc_id"]: r["class_id"] for r in near.near_classes(docs).collect()} == want
    assert len(set(want.values())) == 31
    assert len(sizes["pairs"]) <= 3 * len(texts)
    assert len(sizes["open"]) == len(set(sizes["open"])) > 0
    tried = sizes["pairs"] + sizes["untried"]
    assert len(tried) == len(set(tried))
