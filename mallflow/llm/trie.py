"""Prefix trie of conversations, with sums over its subtrees by centroid decomposition.

Every distinct sequence of first turns is a node; its name is its depth and the smallest conversation that starts with it. Sequences
are told apart by 128 bits: the exclusive or of a hash of every turn with its depth, a running aggregate that is taken in spans of
:data:`SPAN` turns and carried from span to span, so a conversation of any length is spread over tasks.

The rollup splits the parent-edge forest. In a component of n nodes, the nodes whose subtree in it has more than n/2 of them are a path
from its top down; the last is the centroid. The total of the component's nodes at and below the centroid is added to every node of
that path, from the centroid to the top. Then the centroid is taken out, the subtrees of its children become components of their own, the
rest keeps the top, and the sizes along the path fall by the centroid's. A node meets each node below it exactly once: when a
centroid parts them. Every component has at most half the nodes of the one before, so no chain of turns, however long, needs more
than log2(n) rounds.

Sizes only choose the centroids. They are counted from the members at the start: a conversation names the nodes from some depth
down, and adds the number of those below to each node that it goes through. Components of more than ``component`` nodes are split on
the cluster, a written table each round; smaller ones are finished whole in tasks, by the same rule.

Defined results: a null role or text is empty; rows without a conversation are left out; equal turn numbers (null ones first) go by the
MD5 of role and text; repeated rows are turns of their own; an empty table has no node. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallflow.llm.frames import in_batches, stored
from mallflow.llm.ordered import joined_digest, with_places

# Turns of one running aggregate, and nodes of a component that one task splits by itself.
SPAN = 1024
COMPONENT = 1 << 16
# Fixed values of the rebuilt conversations: conversations that share their first turns, and the remainders that say how many.
STRIDE, HEADS = 100, 6
# Conversation ids of one piece of a node's list.
_BLOCK = 4096

_ROOT_DEPTH = 0
_TOP = ["top_conv", "top_depth"]
_SUMS = ["leaves", "saved"]


def _turns(conversations: DataFrame) -> DataFrame:
    """Each turn as the digest of its role and text, the size of the text, and its place in the conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", digest.alias("digest"), F.length(text).cast("bigint").alias("size")
    )
    return with_places(rows, "conv_id", ["turn", "digest"], "place", "turns")


def _roots(convs: DataFrame) -> DataFrame:
    none = F.lit(None).cast("binary")
    return convs.select("conv_id", F.lit(_ROOT_DEPTH).cast("bigint").alias("depth"), none.alias("digest"), F.lit(0).cast("bigint").alias("size"))


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``depth``, ``digest`` and ``size`` of every turn, and a row of depth 0 for every conversation."""
    turns = _turns(conversations)
    return turns.select("conv_id", F.col("place").alias("depth"), "digest", "size").unionByName(_roots(turns.select("conv_id").distinct()))


def rebuilt(conversations: DataFrame, stride: int = STRIDE, heads: int = HEADS) -> DataFrame:
    """As :func:`sequences`, with the first turns of each conversation taken from the first one of its ``stride``.

    Conversation c begins with the first h turns of conversation c - c % stride, h = crc32(c) % heads, and goes on with its own turns
    after its first h.
    """
    turns = _turns(conversations)
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    convs = stored(convs.select("*", head.alias("head"), (F.col("conv_id") - F.col("conv_id") % stride).alias("base")), "convs", narrow=True)
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("head", F.coalesce("there", F.lit(0))))
    own = turns.join(convs.select("conv_id", "head", "taken"), "conv_id").where(F.col("place") > F.col("head"))
    own = own.select("conv_id", (F.col("taken") + F.col("place") - F.col("head")).alias("depth"), "digest", "size")
    # Fewer than ``heads`` turns of a conversation are taken over, by at most ``stride`` others.
    lent = turns.where(F.col("place") < heads).withColumnRenamed("conv_id", "base").join(convs.select("conv_id", "base", "head"), "base")
    lent = lent.where(F.col("place") <= F.col("head")).select("conv_id", F.col("place").alias("depth"), "digest", "size")
    return own.unionByName(lent).unionByName(_roots(convs))


def _members(turns: DataFrame) -> DataFrame:
    """Each conversation's prefixes: 128 bits of the sequence up to a depth (``p1``, ``p2``) and of the one before (``q1``, ``q2``)."""
    zero = F.lit(0).cast("bigint")
    own = [F.when(F.col("depth") == _ROOT_DEPTH, zero).otherwise(h) for h in (F.xxhash64("depth", "digest"), F.xxhash64("digest", F.lit(1), "depth"))]
    rows = turns.select("conv_id", "depth", "size", own[0].alias("x1"), own[1].alias("x2"), F.floor(F.col("depth") / SPAN).alias("part"))
    inside = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("conv_id", "part").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    carried = parts.select("conv_id", "part", *[F.bit_xor(f"x{i}").over(before).alias(f"c{i}") for i in (1, 2)])
    running = rows.select("*", *[F.bit_xor(f"x{i}").over(inside).alias(f"r{i}") for i in (1, 2)])
    found = running.join(carried, ["conv_id", "part"])
    for i in (1, 2):
        found = found.withColumn(f"p{i}", F.col(f"r{i}").bitwiseXOR(F.coalesce(f"c{i}", zero)))
        found = found.withColumn(f"q{i}", F.col(f"p{i}").bitwiseXOR(F.col(f"x{i}")))
    return stored(found.select("conv_id", "depth", "size", "p1", "p2", "q1", "q2"), "prefixes")


def _nodes(members: DataFrame) -> DataFrame:
    """One row per node: its key, ``conv``, ``parent`` (the parent's conversation), ``n_convs``, ``n_children``, ``size``."""
    made = [F.min(c).alias(c) for c in ("size", "q1", "q2")]
    nodes = members.groupBy("depth", "p1", "p2").agg(F.min("conv_id").alias("conv"), F.count(F.lit(1)).alias("n_convs"), *made)
    nodes = stored(nodes, "nodes")
    up = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    below = nodes.where(F.col("depth") > _ROOT_DEPTH).groupBy(*up).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv").alias("parent"))
    found = nodes.join(below, ["depth", "p1", "p2"], "left").join(above, ["depth", "q1", "q2"], "left")
    return stored(found.fillna(0, ["n_children"]), "linked")


def _as(frame: DataFrame, **names: str) -> DataFrame:
    """The columns of ``frame`` under new names, old name first."""
    return frame.select(*[F.col(old).alias(new) for old, new in names.items()])


def prefix_trie(turns: DataFrame, component: int = COMPONENT) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie of :func:`sequences`, and where each conversation ends.

    Nodes: ``conv`` and ``depth`` (its name), ``parent``, ``n_convs``, ``n_children``, ``size`` of the last turn's text, ``leaves`` and
    ``saved``: the childless nodes and the sum of (n_convs - 1) * size in its subtree. Ends: ``conv_id`` with the ``conv`` and ``depth`` of
    its last node.
    """
    members = _members(turns)
    nodes = _nodes(members)
    named = nodes.select("depth", "p1", "p2", "conv", "parent")
    through = stored(members.join(named, ["depth", "p1", "p2"]).select("conv_id", "depth", "conv", "parent"), "through")
    reach = through.groupBy("conv_id").agg(
        F.min(F.when(F.col("conv") == F.col("conv_id"), F.col("depth"))).alias("from_depth"), F.max("depth").alias("last")
    )
    walked = through.join(stored(reach, "reach", narrow=True), "conv_id")
    under = F.col("last") - F.greatest("from_depth", "depth") + 1
    sizes = walked.where(F.col("from_depth").isNotNull()).groupBy("conv", "depth").agg(F.sum(under).alias("nodes"))
    ends = walked.where(F.col("depth") == F.col("last")).select("conv_id", "conv", "depth")

    start = nodes.join(sizes, ["conv", "depth"]).select(
        "conv",
        "depth",
        "parent",
        "n_convs",
        "n_children",
        "size",
        "nodes",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("own_leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("own_saved"),
        *[F.lit(0).cast("bigint").alias(name) for name in _SUMS],
    )
    # All nodes are one tree, whose root is the only one of its depth.
    root = nodes.where(F.col("depth") == _ROOT_DEPTH).select("conv").scalar()
    start = start.select("*", root.alias("top_conv"), F.lit(_ROOT_DEPTH).cast("bigint").alias("top_depth"))
    return rollup(stored(start, "forest"), through, component), ends


def rollup(forest: DataFrame, through: DataFrame, component: int = COMPONENT) -> DataFrame:
    """``leaves`` and ``saved`` as sums of ``own_leaves`` and ``own_saved`` over subtrees, by centroid decomposition.

    ``forest``: nodes with ``parent``, the top of their tree (``top_conv``, ``top_depth``) and the number of ``nodes`` in their subtree.
    ``through``: the node (``conv``) and its ``parent`` on the way of each ``conv_id`` at each ``depth``.
    """
    out = [c for c in forest.columns if c not in (*_TOP, "nodes", "own_leaves", "own_saved")]
    parts, state = [], forest
    while True:
        large = state.where(F.col("top_conv").isNotNull()).groupBy(*_TOP).agg(F.max("nodes").alias("total")).where(F.col("total") > component)
        large = stored(large, "large", narrow=True)
        if large.isEmpty():
            break
        heavy = state.join(large, _TOP).where(F.col("nodes") * 2 > F.col("total"))
        chosen = heavy.groupBy(*_TOP, "total").agg(F.min(F.struct("nodes", "conv", "depth")).alias("c"))
        chosen = stored(_as(chosen.select(*_TOP, "total", "c.*"), top_conv="top_conv", top_depth="top_depth", total="total", conv="c_conv", depth="c_depth", nodes="c_nodes"), "centroids", narrow=True)
        parts.append(state.join(chosen, _TOP, "left_anti"))
        state = _split(state.join(chosen, _TOP), through)
    rest = parts + [state]
    done = [part.where(F.col("top_conv").isNull()).select(*out) for part in rest]
    small = [part.where(F.col("top_conv").isNotNull()) for part in rest]
    found = _finished(small[0] if len(small) == 1 else _union(small), component).select(*out)
    return _union([found, *done])


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *others = frames
    for other in others:
        first = first.unionByName(other)
    return first


def _split(rows: DataFrame, through: DataFrame) -> DataFrame:
    """One round: ``rows`` of components with their centroid (``c_conv``, ``c_depth``, ``c_nodes``) and their number of nodes (``total``)."""
    columns = [c for c in rows.columns if c not in ("total", "c_conv", "c_depth", "c_nodes")]
    # The node under the centroid on the way to a deeper node, and that node's parent, which is the centroid or is not.
    way = _as(through, conv_id="w_conv", depth="w_depth", conv="w_child", parent="w_parent")
    found = rows.join(way, (F.col("conv") == F.col("w_conv")) & (F.col("c_depth") + 1 == F.col("w_depth")) & (F.col("depth") > F.col("c_depth")), "left")
    centre = (F.col("conv") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth"))
    found = found.withColumn("centre", centre).withColumn("under", F.coalesce(F.col("w_parent") == F.col("c_conv"), F.lit(False)))
    found = stored(found, "marked")
    totals = found.where(F.col("centre") | F.col("under")).groupBy(*_TOP).agg(*[F.sum(f"own_{name}").alias(f"t_{name}") for name in _SUMS])
    found = found.join(stored(totals, "totals", narrow=True), _TOP)
    path = F.col("nodes") * 2 > F.col("total")
    new = {name: F.when(path, F.col(name) + F.col(f"t_{name}")).otherwise(F.col(name)) for name in _SUMS}
    new["nodes"] = F.when(path & ~F.col("centre"), F.col("nodes") - F.col("c_nodes")).otherwise(F.col("nodes"))
    new["top_conv"] = F.when(F.col("under"), F.col("w_child")).when(~F.col("centre"), F.col("top_conv"))
    new["top_depth"] = F.when(F.col("under"), F.col("c_depth") + 1).when(~F.col("centre"), F.col("top_depth"))
    return stored(found.select(*[new.get(c, F.col(c)).alias(c) for c in columns]), "split")


def _finished(rows: DataFrame, component: int) -> DataFrame:
    """Components that fit into a task, split to the end there; some are worked on at a time."""
    names = ["conv", "depth", "parent", "own_leaves", "own_saved", *_SUMS]
    sorted_rows = rows.repartition(*_TOP).sortWithinPartitions(*_TOP, "depth", "conv")
    top, other = [rows.columns.index(c) for c in _TOP], [rows.columns.index(c) for c in names]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < component:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            tops = [table.column(i).to_numpy() for i in top]
            # Up to the last top, whose component may go on in the next batch.
            last = np.flatnonzero((tops[0] != tops[0][-1]) | (tops[1] != tops[1][-1]))
            whole = int(last[-1]) + 1 if len(last) else 0
            if whole:
                yield from solved(table.slice(0, whole)).to_batches()
            held = table.slice(whole).to_batches()
        if held:
            yield from solved(pa.Table.from_batches(held)).to_batches()

    def solved(table: pa.Table) -> pa.Table:
        conv, depth, parent, *weights = [table.column(i).to_pylist() if i in other[:3] else table.column(i).to_numpy() for i in other]
        own, sums = np.stack(weights[:2]), np.stack(weights[2:])
        sums = sums + centroid_sums(_parents(conv, depth, parent), own)
        for name, values in zip(_SUMS, sums):
            at = table.schema.get_field_index(name)
            table = table.set_column(at, table.schema.field(at), pa.array(values, pa.int64()))
        return table

    return in_batches(sorted_rows, work, rows.schema)


def _parents(conv: list[int], depth: list[int], parent: list[int | None]) -> np.ndarray:
    """The row of each node's parent; -1 where it is not among the rows."""
    row = {name: i for i, name in enumerate(zip(conv, depth))}
    return np.array([row.get((p, d - 1), -1) for p, d in zip(parent, depth)], dtype=np.int64)


def centroid_sums(parent: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Subtree sums of the rows of ``own`` over a forest of whole components, by centroid decomposition of all of them at once.

    A parent need not come before its children. All trees are split in the same round, on arrays over the nodes.
    """
    n = len(parent)
    sums = np.zeros_like(own)
    if not n:
        return sums
    first, below = np.full(n, -1), [[] for _ in range(n)]
    for node, up in enumerate(parent.tolist()):
        if up >= 0:
            below[up].append(node)
    walk = [node for node in range(n) if parent[node] < 0]
    top = np.arange(n)
    order: list[int] = []
    while walk:
        node = walk.pop()
        first[node] = len(order)
        order.append(node)
        walk.extend(below[node])
    whole = np.ones(n, dtype=np.int64)
    for node in reversed(order):
        if (up := parent[node]) >= 0:
            whole[up] += whole[node]
    for node in order:
        if (up := parent[node]) >= 0:
            top[node] = top[up]
    size, active = whole.copy(), np.ones(n, dtype=bool)
    while active.any():
        at = np.flatnonzero(active)
        heavy = at[2 * size[at] > size[top[at]]]
        centre = np.full(n, -1)
        # On a path from the top down sizes fall, so the last one written is the smallest.
        by_size = heavy[np.argsort(-size[heavy], kind="stable")]
        centre[top[by_size]] = by_size
        mine = centre[top[at]]
        under = (first[at] >= first[mine]) & (first[at] < first[mine] + whole[mine])
        totals = np.zeros_like(own)
        for k in range(len(own)):
            np.add.at(totals[k], top[at][under], own[k][at[under]])
        sums[:, heavy] += totals[:, top[heavy]]
        cut = size[centre[top[heavy]]]
        size[heavy] -= np.where(heavy == centre[top[heavy]], 0, cut)
        # In order of the walk, a node follows the child of the centroid that it belongs to.
        inner = at[under & (at != mine)]
        inner = inner[np.lexsort((first[inner], top[inner]))]
        child = np.where(parent[inner] == centre[top[inner]], np.arange(len(inner)), -1)
        active[centre[centre >= 0]] = False
        top[inner] = inner[np.maximum.accumulate(child)] if len(inner) else inner
    return sums


def with_ends(nodes: DataFrame, ends: DataFrame, name: str = "ends_sha256") -> DataFrame:
    """``nodes`` with the SHA-256 of the ids of the conversations that end there, ascending, with commas."""
    block = F.floor(F.col("conv_id") / _BLOCK)
    listed = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
    pieces = ends.groupBy("conv", "depth", block.alias("block")).agg(listed.alias("piece"))
    digests = joined_digest(pieces, ["conv", "depth"], ["block"], "piece", name, ",")
    found = nodes.join(digests, ["conv", "depth"], "left")
    return found.withColumn(name, F.coalesce(name, F.sha2(F.lit("").cast("binary"), 256)))


def digest(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations with the columns of the query."""
    nodes, ends = prefix_trie(rebuilt(conversations))
    return with_ends(nodes, ends).select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )


def crc32_sql(strings: str) -> str:
    """Common table expressions for DuckDB: ``crc32(s, crc)`` of the column ``s`` of the query ``strings``, ASCII only."""
    return f"""
bits(n, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT n, k + 1, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) FROM bits WHERE k < 8),
bytes AS (SELECT n, c FROM bits WHERE k = 8),
crc_steps(s, i, v) AS (
  SELECT s, 1, 4294967295 FROM ({strings})
  UNION ALL SELECT s, i + 1, xor(v >> 8, c) FROM crc_steps JOIN bytes ON n = xor(v, ascii(s[i])) & 255 WHERE i <= length(s)),
crc32 AS (SELECT s, xor(v, 4294967295) AS crc FROM crc_steps WHERE i = length(s) + 1)"""


ORACLE_SQL = f"""
WITH RECURSIVE {crc32_sql("SELECT DISTINCT CAST(conv_id AS VARCHAR) AS s FROM conversations WHERE conv_id IS NOT NULL")},
turns AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, length(coalesce(text, '')) AS size,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
heads AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % {STRIDE} AS base, crc % {HEADS} AS head
  FROM turns JOIN crc32 ON s = CAST(conv_id AS VARCHAR)),
pieces AS (
  SELECT h.conv_id, 0 AS piece, place, digest, size FROM heads h JOIN turns t ON t.conv_id = h.base AND place <= head
  UNION ALL SELECT h.conv_id, 1, place, digest, size FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND place > head),
steps AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY piece, place) AS depth, digest, size FROM pieces
  UNION ALL SELECT conv_id, 0, '', 0 FROM heads),
prefixes AS (
  SELECT conv_id, depth, size, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth) AS prefix,
         max(depth) OVER (PARTITION BY conv_id) AS last
  FROM steps),
members AS (
  SELECT *, min(conv_id) OVER (PARTITION BY depth, prefix) AS node, count(*) OVER (PARTITION BY depth, prefix) AS n_convs FROM prefixes),
linked AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM members),
nodes AS (
  SELECT node, depth, any_value(parent) AS parent, any_value(n_convs) AS n_convs, (any_value(n_convs) - 1) * any_value(size) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = last), '')) AS ends_sha256
  FROM linked GROUP BY node, depth),
children AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.parent = n.node AND c.depth = n.depth),
sums AS (
  SELECT m.node, m.depth, sum(CASE WHEN c.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(c.saved) AS saved_tokens
  FROM counted c JOIN members m ON m.conv_id = c.node AND m.depth <= c.depth GROUP BY m.node, m.depth)
SELECT c.node AS conv_id, c.depth, c.parent AS parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM counted c JOIN sums s ON s.node = c.node AND s.depth = c.depth
"""
