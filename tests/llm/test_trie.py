"""The trie and its subtree sums against plain recursion."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from mallflow.llm import ordered, trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, parent string, nodes int, size string"
CLASH = (7, "p", 1, "s")


def sorted_turns(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            found[conv].append(((turn is not None, turn or 0), hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    return {conv: [turn[2:] for turn in sorted(turns)] for conv, turns in found.items()}


def plain(turns):
    """Rows of the query by plain means, from each conversation's list of turns."""
    members = defaultdict(list)
    for conv, said in turns.items():
        for depth in range(len(said) + 1):
            members[tuple(said[:depth])].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        below = [sums[child] for child in children[node]]
        sums[node] = (sum(b[0] for b in below) if below else 1, own + sum(b[1] for b in below))
    rows = set()
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(turns[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        rows.add((min(convs), len(node), parent, len(convs), len(children[node]), *sums[node], hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def again(turns, stride=100, heads=6):
    made = {}
    for conv, said in turns.items():
        head = zlib.crc32(str(conv).encode()) % heads
        made[conv] = turns.get(conv - conv % stride, [])[:head] + said[head:]
    return made


def rows(seed=3, convs=60):
    pick = random.Random(seed)
    made = []
    for conv in [*range(convs), *range(250, 270), 100_000, 100_003]:
        for turn in range(pick.randint(1, 9)):
            made.append((conv, turn if pick.random() > 0.1 else None, pick.choice(["user", "assistant", None]), pick.choice(["a", "bb", "", None, "漢字"])))
    made += [(None, 1, "user", "none"), (5, 3, "user", "twice"), (5, 3, "user", "twice"), (5, 3, "user", "tie")]
    made += [(7, turn, "user", "same") for turn in range(300)] + [(8, turn, "user", "same") for turn in range(150)]
    return made


def frame(spark, made):
    return spark.createDataFrame([(*row, *CLASH) for row in made], SCHEMA)


def test_query_columns(spark):
    made = rows()
    got = [tuple(r) for r in trie.digest(frame(spark, made)).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(again(sorted_turns(made)))


@pytest.mark.parametrize("component", [6, 100])
def test_split_on_the_cluster(spark, component, monkeypatch):
    made = rows(4, 25)
    monkeypatch.setattr(trie, "SPAN", 16)
    monkeypatch.setattr(trie, "_BLOCK", 4)
    nodes, ends = trie.prefix_trie(trie.sequences(frame(spark, made)), component)
    got = trie.with_ends(nodes, ends).select("conv", "depth", "parent", "n_convs", "n_children", "leaves", "saved", "ends_sha256")
    assert {tuple(r) for r in got.collect()} == plain(sorted_turns(made))


def test_no_conversations(spark):
    assert trie.digest(frame(spark, [])).collect() == []
    assert trie.digest(frame(spark, [(None, 1, "user", "x")])).collect() == []


@pytest.mark.parametrize("kind", ["chain", "star", "random", "bushy", "forest"])
def test_centroid_sums(kind):
    pick, n = random.Random(5), 700
    choose = {
        "chain": lambda i: i - 1,
        "star": lambda i: 0,
        "random": lambda i: pick.randrange(i),
        "bushy": lambda i: (i - 1) // 2,
        "forest": lambda i: pick.randrange(i) if i % 7 else -1,
    }[kind]
    parent = [-1, *[choose(i) for i in range(1, n)]]
    own = np.array([[pick.randrange(100) for _ in range(n)], [1 << 55] * n], dtype=np.int64)
    want = own.copy()
    for i in reversed(range(n)):
        if parent[i] >= 0:
            want[:, parent[i]] += want[:, i]
    # Nodes in any order.
    new = list(range(n))
    pick.shuffle(new)
    moved, weights = np.full(n, -1), np.zeros_like(own)
    for i in range(n):
        moved[new[i]] = new[parent[i]] if parent[i] >= 0 else -1
        weights[:, new[i]] = own[:, i]
    got = trie.centroid_sums(moved, weights)
    assert all((got[:, new[i]] == want[:, i]).all() for i in range(n))
    assert trie.centroid_sums(moved[:0], weights[:, :0]).shape == (2, 0)


def test_places_of_a_group_over_many_tasks(spark):
    made = [(None if i % 5 == 0 else i % 3 if i % 2 else 9, i % 11 if i % 4 else None, i) for i in range(2000)]
    data = spark.createDataFrame(made, "g long, o long, local long").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ordered.with_places(data, "g", ["o"], "place", "test").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((r["g"] is None, r["g"] or 0, r["o"] is not None, r["o"] or 0, r["local"]) for r in got) == sorted(
        (g is None, g or 0, o is not None, o or 0, i) for g, o, i in made
    )
    for group in {r["g"] for r in got}:
        mine = sorted(((r["place"], (r["o"] is not None, r["o"] or 0)) for r in got if r["g"] == group))
        assert [p for p, _ in mine] == list(range(1, len(mine) + 1)) and [o for _, o in mine] == sorted(o for _, o in mine)
