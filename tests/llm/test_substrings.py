"""Repeated passages against plain counting of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import cases
from mallflow.llm import frames, substrings
from mallflow.llm.queries import registry

SF_DIR = "/root/testdata/sf0.001"


def plain(texts: list[str | None], length: int = 35) -> list[tuple[int, int, str]]:
    split = [cases.words(t) for t in texts]
    seen = Counter(tuple(w[k : k + length]) for w in split for k in range(len(w) - length + 1))
    out = []
    for found in split:
        gone = [False] * len(found)
        for k in range(len(found) - length + 1):
            if seen[tuple(found[k : k + length])] > 1:
                gone[k : k + length] = [True] * length
        out.append((len(found), sum(gone), " ".join(w for w, g in zip(found, gone, strict=True) if not g)))
    return out


def _rows(frame):
    return sorted(((r["doc_id"], *r["rest"]) for r in frame.collect()), key=str)


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    want = {d: (n, gone, hashlib.sha256(t.encode()).hexdigest()) for d, (n, gone, t) in zip(docs, plain(list(docs.values())), strict=True)}
    rows = registry()["op10_suffix_trees"](spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows} == want
    assert sum(r["n_removed"] for r in rows)


@pytest.fixture(scope="module")
def passages():
    """Texts that share passages just below, at and above the length, at their ends and inside, and runs of one word."""
    pick = random.Random(8)
    shared = [cases.prose(100 + i, 34 + i).split() for i in range(5)]
    texts = []
    for i in range(60):
        parts = [cases.prose(1000 + i, pick.randint(0, 50)).split()]
        for _ in range(pick.randint(0, 3)):
            parts += [pick.choice(shared), cases.prose(pick.randrange(10**6), pick.randint(0, 9)).split()]
        texts.append("  ".join(w for part in parts for w in part))
    texts += ["a " * 34, "b " * 35, "c " * 36, "d e " * 60, texts[0], texts[0], "tail\n" + " ".join(shared[4])]
    return texts


@pytest.mark.parametrize(("group", "batch"), [(substrings.GROUP, 1000), (2, 7), (substrings.GROUP, 1)])
def test_every_split_gives_the_same(spark, tmp_path, passages, monkeypatch, group, batch):
    monkeypatch.setattr(frames, "_BATCH_ROWS", batch)
    docs = spark.createDataFrame(list(enumerate(passages)), "doc_id bigint, text string")
    docs.repartition(5).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    want = sorted(((i, *row) for i, row in enumerate(plain(passages))), key=str)
    assert _rows(substrings.remove_repeats(docs, ["doc_id"], group=group)) == want


@pytest.mark.parametrize("held", [1, 7, 1 << 14])
def test_groups_in_many_batches(passages, monkeypatch, held):
    """Groups read in batches of any size against the whole table at once."""
    table = pa.Table.from_batches(list(_slices(passages)))
    table = table.take(pa.array(np.argsort(table["key"].to_numpy(), kind="stable")))
    whole = substrings._found(table, 35).to_pylist()
    monkeypatch.setattr(substrings, "_HELD_ROWS", held)
    got = [r for b in substrings._tree_task(35)(iter(table.to_batches(max_chunksize=3))) for r in b.to_pylist()]
    assert got == whole and whole


def _slices(texts):
    """All suffixes of the texts, taken one text at a time, so that equal ones are not merged before they meet."""
    for i, text in enumerate(texts):
        batch = pa.RecordBatch.from_arrays([pa.array([i]), pa.array([text])], ["row", "text"])
        for found in substrings._place_task(35)(iter([batch])):
            places = pa.array([found.column(2).to_pylist()], pa.list_(pa.int64()))
            rows = pa.RecordBatch.from_arrays([*batch.columns, places], ["row", "text", "places"])
            yield from substrings._slice_task(35, common=False)(iter([rows]))


def test_tree_of_sorted_words():
    """Depths of neighbours and nodes at a depth, against plain prefixes."""
    pick = np.random.default_rng(4)
    words, first = pick.integers(0, 2, (200, 9)), pick.integers(0, 3, 200)
    tree = substrings._sorted_tree(first, words)
    for depth in range(10):
        node = substrings._at_depth(tree, depth)
        want = {(f, *w[:depth]) for f, w in zip(first, words.tolist(), strict=True)}
        assert len(set(zip(node, first, map(tuple, words[:, :depth].tolist()), strict=True))) == len(set(node)) == len(want)


def test_keys_that_collide(passages):
    """The words decide, not the key: with all suffixes in one group the same runs are found."""
    table = pa.Table.from_batches(list(_slices(passages)))
    table = table.take(pa.array(np.argsort(table["key"].to_numpy(), kind="stable")))
    one = table.set_column(0, "key", pa.array(np.full(table.num_rows, 7)))
    assert (substrings._deep_nodes(one, 35) == substrings._deep_nodes(table, 35)).all()


def test_stretches(spark, passages):
    """Repeats longer than the length come out whole, those that only overlap apart."""
    long = cases.prose(77, 130).split()
    texts = [*passages, "x " + " ".join(long) + " y", " ".join(["z", "z", *long[:90]]), " ".join(["q", *long[40:], "r"]), None]
    split = [cases.words(t) for t in texts]
    seen = Counter(tuple(w[k : k + 35]) for w in split for k in range(len(w) - 34))
    want = []
    for words in split:
        spans = []
        for k in range(len(words) - 34):
            if seen[tuple(words[k : k + 35])] > 1:
                if spans and spans[-1][1] == k + 34:
                    spans[-1] = (spans[-1][0], k + 35)
                else:
                    spans.append((k, k + 35))
        want.append(spans)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    frame = substrings.repeated_stretches(docs)
    assert frame.columns == ["doc_id", "text", "stretches"]
    got = {r["doc_id"]: [tuple(s) for s in r["stretches"]] for r in frame.collect()}
    assert got == dict(enumerate(want))
    assert got[len(passages)] == [(1, 131)]
    assert got[len(passages) + 1] == [(2, 92)] and got[len(passages) + 2] == [(1, 91)]


def test_long_words_and_lengths(spark):
    words = ["w" * 5000 + str(i) for i in range(40)]
    texts = [" ".join(words), " ".join([*words[:36], "other"]), " ".join([*words[:20], "w" * 4999 + "20", *words[21:]])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for length in (8, 35, 70):
        assert _rows(substrings.remove_repeats(docs, ["doc_id"], length=length)) == [(i, *r) for i, r in enumerate(plain(texts, length))]
    for length in (7, 71):
        with pytest.raises(ValueError, match="length must be"):
            substrings.remove_repeats(docs, length=length)


def test_awkward_documents(spark):
    docs = cases.documents(spark)
    frame = substrings.remove_repeats(docs)
    assert frame.columns == [*docs.columns, "rest"]
    texts = [r[1] for r in cases.rows()]
    want = sorted(((r[0], *w) for r, w in zip(cases.rows(), plain(texts), strict=True)), key=str)
    assert _rows(frame) == want
    assert substrings.remove_repeats(cases.no_documents(spark)).collect() == []


def test_least_of_windows():
    values = np.random.default_rng(2).integers(0, 1 << 60, 500).astype(np.uint64)
    for width in (1, 2, 28, 499, 500):
        assert (substrings._least(values, width) == [values[i : i + width].min() for i in range(500 - width + 1)]).all()
    assert len(substrings._least(values[:5], 6)) == 0
