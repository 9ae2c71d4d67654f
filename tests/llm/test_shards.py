"""Best-fit packing against a plain one, and the shards of documents."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

import cases
from mallflow.llm import shards
from mallflow.llm.queries import registry

SF_DIR = "/root/testdata/sf0.001"


def plain_best_fit(sizes, capacity):
    bins = []
    for size in sorted(sizes, reverse=True):
        fitting = [left for left in bins if left >= size]
        if fitting:
            bins.remove(min(fitting))
            bins.append(min(fitting) - size)
        else:
            bins.append(capacity - size)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(12))
def test_runs_pack_like_single_groups(seed):
    pick = random.Random(seed)
    sizes = [pick.choice([1, 2, 3, 5, 8, 13, 21, pick.randint(1, 60)]) for _ in range(pick.randint(1, 200))]
    capacity = max(sizes) + pick.randint(0, 60)
    plan, opened = shards.pack(sorted(Counter(sizes).items(), reverse=True), capacity)
    load, placed = defaultdict(int), Counter()
    for size, low, high, shard in plan:
        load[shard] += size * (high - low)
        placed[size] += high - low
    assert placed == Counter(sizes)
    assert sorted(capacity - x for x in load.values()) == plain_best_fit(sizes, capacity)
    assert opened == len(load)


def test_bins_against_a_sorted_list():
    pick, tree, plain = random.Random(2), shards._Bins(), []
    for shard in range(4000):
        if pick.random() < 0.6 or not plain:
            plain.append((pick.randint(0, 500), shard))
            tree.add(*plain[-1])
        else:
            size = pick.randint(0, 520)
            want = min((x for x in plain if x[0] >= size), default=None)
            assert tree.take(size) == want
            if want:
                plain.remove(want)


def test_many_bins():
    """Packing into 100,000 open bins stays shallow and gives what fits."""
    runs = [(size, 50) for size in range(6000, 4000, -1)]
    plan, opened = shards.pack(runs, 10_000)
    load = defaultdict(int)
    for size, low, high, shard in plan:
        load[shard] += size * (high - low)
    assert len(load) == opened and max(load.values()) <= 10_000
    assert sum(load.values()) == sum(size * n for size, n in runs)


@pytest.mark.parametrize("seed", range(8))
def test_least_capacity_is_even(seed):
    pick = random.Random(seed)
    sizes = [int(pick.expovariate(1 / 300)) + 1 for _ in range(600)] + [40_000] * (seed % 3)
    plan = shards.least_capacity(sorted(Counter(sizes).items(), reverse=True), 16)
    load, placed = defaultdict(int), defaultdict(list)
    for size, low, high, shard in plan:
        load[shard] += size * (high - low)
        placed[size] += range(low, high)
    assert {s: sorted(r) for s, r in placed.items()} == {s: list(range(n)) for s, n in Counter(sizes).items()}
    loads = sorted(load.values())
    assert len(loads) == 16
    small = loads[: 16 - seed % 3]
    assert small[-1] - small[0] <= 0.01 * small[-1] + 2


def _check(rows, texts):
    assert len(rows) == len(texts)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(16))
    assert {r["law"] for r in rows} <= {"bytes"}


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = registry()["op3_best_fit"](spark, SF_DIR).collect()
    _check(rows, texts)
    load, of_text = Counter(), defaultdict(set)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        load[r["shard"]] += r["size"]
        of_text[raw].add(r["shard"])
    assert all(len(s) == 1 for s in of_text.values())
    assert len(load) == 16


def test_fixed_capacity(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 37)) for i in range(500)], "doc_id bigint, text string")
    rows = shards.into_shards(docs, shards=None, capacity=1000).collect()
    load = Counter()
    for r in rows:
        load[r["shard"]] += r["size"]
    assert max(load.values()) <= 1000 and sorted(load) == list(range(len(load)))
    groups = Counter()
    for i in range(500):
        groups[i % 37] += i % 37 + 1
    assert sorted(1000 - x for x in load.values()) == plain_best_fit(groups.values(), 1000)


def test_awkward_documents(spark):
    docs = cases.documents(spark)
    rows = shards.into_shards(docs).collect()
    _check(rows, cases.rows())
    with_shard = shards.with_shard(docs)
    assert with_shard.columns == [*docs.columns, "shard_"]
    placed = defaultdict(set)
    for r in with_shard.collect():
        placed[r["text"] or ""].add(r["shard_"])
    assert len(with_shard.collect()) == len(cases.rows()) and all(len(s) == 1 for s in placed.values())
    assert shards.into_shards(cases.no_documents(spark)).collect() == []
    assert shards.with_shard(cases.no_documents(spark)).collect() == []


def test_a_group_with_most_rows(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'the same text', concat('text ', id)) as text")
    rows = shards.into_shards(docs).collect()
    _check(rows, range(3000))
    (hot,) = {r["shard"] for r in rows if r["doc_id"] % 3 == 0}
    load = Counter()
    for r in rows:
        load[r["shard"]] += r["size"]
    rest = [load[s] for s in range(16) if s != hot]
    assert max(rest) - min(rest) <= 30 and not any(r["shard"] == hot and r["doc_id"] % 3 for r in rows)
