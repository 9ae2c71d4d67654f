"""Least edits that give a conversation a proper order of roles, by a Viterbi search in chunks.

Rows are kept (K), given the other role (R), deleted (D), or new ones are inserted (I), so that the roles read ``(s?(ua)+)?`` by their
initials. Which edits are least is a shortest path through four states: nothing yet, after the system turn, after a user, after an
assistant. The search runs from the last row to the first, and a conversation of any length is cut into chunks of :data:`CHUNK` rows:

* every chunk starts from a speculative vector of costs to go behind its last row (the last chunk from the true one);
* in a fix-up pass each chunk whose follower came out with other costs than assumed is run again from those. Only differences between
  states matter, and a few rows bring all vectors to the same differences, so a rerun stops where its vector differs from the one
  before by a constant only, and the passes end when no chunk's vector changes by more than that;
* each chunk then holds the costs to go of its rows up to a constant, and is traced from every state it may be entered in, at each step
  by the least letter that lies on a least path. The traces of the chunks are strung together by one small map of states for each.

Rows carry one letter into the search; texts go only through the sort into chunks and the digest. A digest has to be taken from front to
back: chunks are put together in parallel, and only conversations of several chunks send them through one task, one at a time.

Faults, the first that fits: blank (no character but white space), duplicate (role and text seen earlier in the conversation), truncated
(the last character that is not white space is none of ``.!?``). Blank and duplicate rows must be deleted.

Defined results: rows are in order of turn, null ones first, equal turns by role, then text; a null role or text is one space; a null
conversation is one of its own; a conversation without rows has zeros, an empty audit and the digest of the empty text. Roles are kept
by their first character, whatever follows it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallflow.llm.frames import in_batches, stored
from mallflow.llm.ordered import joined_digest, with_places
from mallflow.llm.trie import crc32_sql

CHUNK = 2048

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"

# States, and where the initials lead from each. A conversation may end in START and in DONE.
START, SYSTEM, ASKED, DONE = range(4)
_NEXT = ({"s": SYSTEM, "u": ASKED}, {"u": ASKED}, {"a": DONE}, {"u": ASKED})
# The one role that a new turn, or a turn of another role, can have in a state.
_FITS = ({"u": ASKED}, {"u": ASKED}, {"a": DONE}, {"u": ASKED})
_ENDS = (0, None, None, 0)
_FAR = 1 << 40

_WHITE = r"\x20\x09-\x0D"

# A row's letter: its initial if it may stay and is whole, in upper case if it is truncated; o for other initials; x must be deleted.
Vector = tuple[int, int, int, int]


def _normal(vector: list[int]) -> Vector:
    least = min(vector)
    return tuple(v - least for v in vector)


def _inserted(vector: list[int]) -> list[int]:
    """The costs to go when rows may be inserted first."""
    for _ in range(3):
        vector = [min(v, *(INSERT + vector[to] for to in _FITS[state].values())) for state, v in enumerate(vector)]
    return vector


@lru_cache(maxsize=None)
def _last() -> Vector:
    """Costs to go behind the last row."""
    return tuple(_inserted([_FAR if end is None else end for end in _ENDS]))


def _edits(letter: str, state: int) -> list[tuple[str, int, int]]:
    """What may be done to a row in a state: (edit, cost, next state), in order of the letters."""
    found = [("D", DELETE, state)]
    if letter != "x":
        more, initial = TRUNCATED if letter.isupper() else 0, letter.lower()
        if initial in _NEXT[state]:
            found.append(("K", KEEP + more, _NEXT[state][initial]))
        found.extend(("R", REROLE + more, to) for to in _FITS[state].values())
    return found


@lru_cache(maxsize=None)
def _before(letter: str, after: Vector) -> Vector:
    """Costs to go before a row, up to a constant, from those after it. There are few different ones."""
    return _normal(_inserted([min(cost + after[to] for _, cost, to in _edits(letter, state)) for state in range(4)]))


def vectors(letters: str, after: Vector) -> list[Vector]:
    """Costs to go at every place of a chunk, up to a constant each."""
    found = [after] * (len(letters) + 1)
    for place in range(len(letters) - 1, -1, -1):
        found[place] = _before(letters[place], found[place + 1])
    return found


def refront(letters: str, old: Vector, new: Vector, front: Vector) -> Vector:
    """``front``, the costs before a chunk that was run from ``old``, after a rerun from ``new``; ends where both runs agree."""
    for letter in reversed(letters):
        if old == new:
            return front
        old, new = _before(letter, old), _before(letter, new)
    return new


@lru_cache(maxsize=None)
def _least(letter: str, state: int, after: Vector) -> int:
    """Least cost from a state before a row, on the scale of ``after``."""
    return _inserted([min(cost + after[to] for _, cost, to in _edits(letter, s)) for s in range(4)])[state]


@lru_cache(maxsize=None)
def _step(letter: str, state: int, after: Vector) -> tuple[str, int, int]:
    """The edits at a row in a state that lie on a least path and read least: their letters, cost and the next state.

    R and I make a user, r and i an assistant.
    """
    options = [(edit, cost, to, cost + after[to]) for edit, cost, to in _edits(letter, state)]
    here = min(whole for *_, whole in options)
    edit, cost, to = next(option[:3] for option in options if option[3] == here)
    ((role, new),) = _FITS[state].items()
    inserting = INSERT + _least(letter, new, after)
    if inserting < here or (inserting == here and "I" < edit):
        edits, cost, to = _step(letter, new, after)
        return ("I" if role == "u" else "i") + edits, INSERT + cost, to
    return "r" if edit == "R" and role == "a" else edit, cost, to


def trace(letters: str, state: int, found: list[Vector], last: bool) -> tuple[str, int, int]:
    """The least path of a chunk from a state: edits, cost, and the state behind it. The last chunk is closed by insertions."""
    edits, total = [], 0
    for letter, after in zip(letters, found[1:]):
        step, cost, state = _step(letter, state, after)
        edits.append(step)
        total += cost
    while last and _ENDS[state] is None:
        ((role, state),) = _FITS[state].items()
        edits.append("I" if role == "u" else "i")
        total += INSERT
    return "".join(edits), total, state


def apply_edits(edits: str, rows: list[tuple[str, str]]) -> list[str]:
    """The repaired ``role:text`` of some rows."""
    out, at = [], 0
    for edit in edits:
        role, text = ("", "") if edit in "Ii" else rows[at]
        at += edit not in "Ii"
        if edit != "D":
            out.append(f"{role if edit == 'K' else USER if edit in 'RI' else ASSISTANT}:{text}")
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the damage that the query lays down: ``conv_id``, ``turn``, ``role``, ``text``."""
    space = F.lit(" ")
    spot = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    text = F.coalesce("text", space)
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), text.alias("text"), (F.crc32(spot.cast("binary")) % 20).alias("harm"))
    harmed = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.sequence(F.lit(1), F.when(F.col("harm") == 3, 2).otherwise(1))
    rows = rows.where(F.col("harm") != 0).select(
        "conv_id", "turn", F.when(F.col("harm") == 4, USER).otherwise(F.col("role")).alias("role"), harmed.alias("text"), F.explode(copies).alias("copy")
    )
    return rows.drop("copy")


def _faults(rows: DataFrame) -> DataFrame:
    """``rows`` in their places, with the first fault of each, its initial and its letter. Stored."""
    placed = with_places(rows, "conv_id", ["turn", "role", "text"], "place", "placed")
    same = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))
    placed = stored(placed.withColumn("same", same), "rows")
    firsts = placed.groupBy("conv_id", "same").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Only what is said twice is looked up.
    firsts = stored(firsts.select(F.col("conv_id").alias("conv_"), F.col("same").alias("same_"), "first"), "repeats", narrow=True)
    found = placed.join(firsts, F.col("conv_id").eqNullSafe(F.col("conv_")) & (F.col("same") == F.col("same_")), "left")
    blank = ~F.col("text").rlike(f"[^{_WHITE}]")
    again = F.col("place") > F.col("first")
    cut = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r")), -1, 1)
    fault = F.when(blank, "blank").when(F.coalesce(again, F.lit(False)), "duplicate").when(~cut.isin(".", "!", "?"), "truncated")
    initial = F.substring("role", 1, 1)
    found = found.withColumn("fault", fault).withColumn("initial", initial)
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    letter = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)
    chunk = F.floor((F.col("place") - 1) / CHUNK)
    return stored(found.select("conv_id", "turn", "role", "text", "place", "fault", "initial", letter.alias("letter"), chunk.alias("chunk")), "faults")


def _arrow(names: list[str], rows: list[tuple], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(column), kind) for column, kind in zip(columns, kinds)], names)


_VECTOR = pa.list_(pa.int64())
_SEARCHED = "conv_id bigint, chunk bigint, chunks bigint, letters string, after array<bigint>, front array<bigint>"


def _searched(chunks: DataFrame) -> DataFrame:
    """Every chunk with the costs behind it (``after``) and before it (``front``), true up to a constant. Rows: one per chunk."""
    speculative = [0, 0, 0, 0]

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                after = _normal(list(_last())) if row["chunk"] == row["chunks"] - 1 else tuple(speculative)
                rows.append((row["conv_id"], row["chunk"], row["chunks"], row["letters"], list(after), list(vectors(row["letters"], after)[0])))
            yield _arrow(_names, rows, [pa.int64(), pa.int64(), pa.int64(), pa.string(), _VECTOR, _VECTOR])

    def fix_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                after, follows = tuple(row["after"]), row["follows"]
                if follows is not None and tuple(follows) != after:
                    row["front"] = list(refront(row["letters"], after, tuple(follows), tuple(row["front"])))
                    after = tuple(follows)
                rows.append((row["conv_id"], row["chunk"], row["chunks"], row["letters"], list(after), row["front"]))
            yield _arrow(_names, rows, [pa.int64(), pa.int64(), pa.int64(), pa.string(), _VECTOR, _VECTOR])

    _names = ["conv_id", "chunk", "chunks", "letters", "after", "front"]
    done = stored(in_batches(chunks, first_pass, _SEARCHED), "speculative", narrow=True)
    single, several = done.where("chunks = 1"), done.where("chunks > 1")
    while True:
        fronts = several.select(F.col("conv_id").alias("conv_"), (F.col("chunk") - 1).alias("chunk_"), F.col("front").alias("follows"))
        met = several.join(fronts, F.col("conv_id").eqNullSafe(F.col("conv_")) & (F.col("chunk") == F.col("chunk_")), "left").drop("conv_", "chunk_")
        if met.where("follows is not null and follows != after").isEmpty():
            return single.unionByName(several)
        several = stored(in_batches(met, fix_up, _SEARCHED), "fixed", narrow=True)


def _traced(chunks: DataFrame) -> DataFrame:
    """The edits of every chunk: ``conv_id``, ``chunk``, ``chunks``, ``edits``, ``cost``."""
    schema = "conv_id bigint, chunk bigint, chunks bigint, edits array<string>, costs array<bigint>, leads array<bigint>"
    names = ["conv_id", "chunk", "chunks", "edits", "costs", "leads"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                found, last = vectors(row["letters"], tuple(row["after"])), row["chunk"] == row["chunks"] - 1
                ways = [trace(row["letters"], state, found, last) for state in (range(4) if row["chunk"] else (START,))]
                rows.append((row["conv_id"], row["chunk"], row["chunks"], *[list(way) for way in zip(*ways)]))
            yield _arrow(names, rows, [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), _VECTOR, _VECTOR])

    traces = stored(in_batches(chunks, run, schema), "traces", narrow=True)

    def string(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = START
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                state = state if row["chunk"] else START
                rows.append((row["conv_id"], row["chunk"], state))
                state = row["leads"][state if row["chunk"] else 0]
            yield _arrow(["conv_", "chunk_", "enters"], rows, [pa.int64(), pa.int64(), pa.int64()])

    # A map of four states for each chunk goes through the tasks in order; the edits themselves do not.
    maps = traces.where("chunks > 1").select("conv_id", "chunk", "leads").repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    entered = in_batches(maps, string, "conv_ bigint, chunk_ bigint, enters bigint")
    found = traces.join(stored(entered, "entered", narrow=True), F.col("conv_id").eqNullSafe(F.col("conv_")) & (F.col("chunk") == F.col("chunk_")), "left")
    at = F.coalesce("enters", F.lit(START)).cast("int")
    return found.select("conv_id", "chunk", "chunks", F.get("edits", at).alias("edits"), F.get("costs", at).alias("cost"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edits of every conversation of ``rows`` (``conv_id``, ``turn``, ``role``, ``text``, no null role or text).

    The first frame has a row per conversation with rows: ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``,
    ``audit``. The second its repaired turns in pieces: ``conv_id``, ``chunk``, ``chunks``, ``piece`` (null if no turn is left of it).
    """
    faults = _faults(rows)
    letters = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "letter"))), lambda r: r["letter"]), "")
    pairs = F.transform(F.sort_array(F.collect_list(F.struct("place", "initial"))), lambda r: r["initial"])
    counts = [F.count(F.when(F.col("fault") == name, 1)).alias(name) for name in ("blank", "duplicate", "truncated")]
    chunks = faults.groupBy("conv_id", "chunk").agg(letters.alias("letters"), pairs.alias("initials"), F.min("turn").alias("low"), F.max("turn").alias("high"), *counts)
    chunks = stored(chunks, "chunks")
    shape = chunks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("chunks"))
    shape = shape.withColumnRenamed("conv_id", "conv_")
    sized = chunks.join(shape, F.col("conv_id").eqNullSafe(F.col("conv_"))).select("conv_id", "chunk", "chunks", "letters")
    edits = stored(_traced(_searched(stored(sized, "sized"))), "edits")
    return _summary(faults, chunks, edits), _pieces(faults, edits)


def _illegal(first: Column, second: Column) -> Column:
    return ~F.concat(first, second).isin("su", "ua", "au")


def _summary(faults: DataFrame, chunks: DataFrame, edits: DataFrame) -> DataFrame:
    inside = F.aggregate(
        F.sequence(F.lit(1), F.size("initials")),
        F.lit(0).cast("bigint"),
        lambda n, i: n + F.when((i < F.size("initials")) & _illegal(F.get("initials", i - 1), F.get("initials", i)), 1).otherwise(0),
    )
    tails = chunks.select(F.col("conv_id").alias("conv_"), (F.col("chunk") + 1).alias("chunk_"), F.element_at("initials", -1).alias("tail"))
    joined = chunks.where("chunk > 0").join(tails, F.col("conv_id").eqNullSafe(F.col("conv_")) & (F.col("chunk") == F.col("chunk_")))
    seams = joined.where(_illegal(F.col("tail"), F.get("initials", F.lit(0)))).groupBy("conv_id").agg(F.count(F.lit(1)).alias("seams"))
    whole = chunks.withColumn("inside", inside).groupBy("conv_id").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "inside")]
    )
    turns = faults.where(F.col("turn").isNotNull()).select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("chunk", "edits"))), lambda r: r["edits"])
    audits = edits.groupBy("conv_id").agg(F.upper(F.array_join(ordered, "")).alias("audit"), F.sum("cost").alias("cost"))
    for other, name in ((seams, "s"), (turns, "t"), (audits, "a")):
        other = other.withColumnRenamed("conv_id", f"conv_{name}")
        whole = whole.join(other, F.col("conv_id").eqNullSafe(F.col(f"conv_{name}")), "left").drop(f"conv_{name}")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("bigint")
    illegal = F.col("inside") + F.coalesce("seams", F.lit(0))
    return whole.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", illegal.alias("illegal"), "cost", "audit")


def _pieces(faults: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired turns of every chunk, put together in the chunk's own task."""
    none, zero = F.lit(None).cast("string"), F.lit(0).cast("bigint")
    heads = edits.select("conv_id", "chunk", zero.alias("place"), "chunks", "edits", none.alias("role"), none.alias("text"))
    turns = faults.select("conv_id", "chunk", "place", zero.alias("chunks"), none.alias("edits"), "role", "text")
    rows = heads.unionByName(turns).repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "place")
    names, kinds = ["conv_id", "chunk", "chunks", "piece"], [pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def made(head: tuple, held: list[tuple[str, str]]) -> tuple:
        out = apply_edits(head[3], held)
        return (*head[:3], "\n".join(out) if out else None)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held = None, []
        for batch in batches:
            done = []
            for conv, chunk, place, chunks, edit, role, text in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if place == 0:
                    if head is not None:
                        done.append(made(head, held))
                    head, held = (conv, chunk, chunks, edit), []
                else:
                    held.append((role, text))
            if done:
                yield _arrow(names, done, kinds)
        if head is not None:
            yield _arrow(names, [made(head, held)], kinds)

    return in_batches(rows, work, "conv_id bigint, chunk bigint, chunks bigint, piece string")


def digest(conversations: DataFrame) -> DataFrame:
    """The repair of the damaged conversations with the columns of the query."""
    conversations = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    summary, pieces = repair(damaged(conversations))
    pieces = stored(pieces, "pieces")
    single = pieces.where("chunks = 1").select("conv_id", F.sha2(F.coalesce("piece", F.lit("")).cast("binary"), 256).alias("sha"))
    several = joined_digest(pieces.where("chunks > 1 and piece is not null"), ["conv_id"], ["chunk"], "piece", "sha", "\n")
    shas = single.unionByName(several).withColumnRenamed("conv_id", "conv_sha")
    made = summary.withColumnRenamed("conv_id", "conv_")
    found = conversations.select("conv_id").distinct()
    found = found.join(made, F.col("conv_id").eqNullSafe(F.col("conv_")), "left").join(shas, F.col("conv_id").eqNullSafe(F.col("conv_sha")), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return found.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", empty).alias("repaired_sha256"))


# Plain search from the first row to the last, which keeps the least (cost, edits) of every state.
ORACLE_SQL = f"""
WITH RECURSIVE {crc32_sql("SELECT DISTINCT coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations")},
harmed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, crc % 20 AS harm
  FROM conversations JOIN crc32 ON s = coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')),
kept AS (
  SELECT conv_id, turn, CASE harm WHEN 4 THEN 'user' ELSE role END AS role,
         CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE harm WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM harmed WHERE harm <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth,
         regexp_replace(text, '[ \x09-\x0D]+$', '') AS bare
  FROM kept),
judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY conv_id),
news(state, goes, cost, audit, made) AS (
  VALUES ('', '', 0, '', []), ('s', 's', 0, '', []), ('u', 'u', 0, '', []), ('a', 'a', 0, '', []),
         ('', 'u', 5, 'I', ['user:']), ('s', 'u', 5, 'I', ['user:']), ('u', 'a', 5, 'I', ['assistant:']), ('a', 'u', 5, 'I', ['user:']),
         ('', 'a', 10, 'II', ['user:', 'assistant:']), ('s', 'a', 10, 'II', ['user:', 'assistant:'])),
goes(state, edit, goes) AS (
  VALUES ('', 'K', 's'), ('', 'K', 'u'), ('s', 'K', 'u'), ('u', 'K', 'a'), ('a', 'K', 'u'),
         ('', 'R', 'u'), ('s', 'R', 'u'), ('u', 'R', 'a'), ('a', 'R', 'u'),
         ('', 'D', ''), ('s', 'D', 's'), ('u', 'D', 'u'), ('a', 'D', 'a')),
search AS (
  SELECT conv_id, 0 AS place, '' AS state, {{'cost': 0, 'audit': '', 'made': CAST([] AS VARCHAR[])}} AS best FROM counts
  UNION ALL
  SELECT s.conv_id, s.place + 1, g.goes,
         min({{'cost': s.best.cost + n.cost + CASE g.edit WHEN 'D' THEN 2 ELSE CASE g.edit WHEN 'R' THEN 1 ELSE 0 END + CASE j.fault WHEN 'truncated' THEN 5 ELSE 0 END END,
               'audit': s.best.audit || n.audit || g.edit,
               'made': s.best.made || n.made || CASE g.edit WHEN 'D' THEN [] WHEN 'K' THEN [j.role || ':' || j.text]
                        ELSE [CASE g.goes WHEN 'u' THEN 'user:' ELSE 'assistant:' END || j.text] END}})
  FROM search s JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.place = s.place + 1
  JOIN news n ON n.state = s.state
  JOIN goes g ON g.state = n.goes AND (g.edit = 'D' OR j.fault NOT IN ('blank', 'duplicate')) AND (g.edit <> 'K' OR g.goes = j.initial)
  GROUP BY s.conv_id, s.place, g.goes),
ended AS (
  SELECT s.conv_id, min({{'cost': s.best.cost + n.cost, 'audit': s.best.audit || n.audit, 'made': s.best.made || n.made}}) AS best
  FROM search s JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.n = s.place JOIN news n ON n.state = s.state
  WHERE n.goes IN ('', 'a') GROUP BY s.conv_id),
everyone AS (SELECT DISTINCT conv_id FROM conversations)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.made, chr(10)), '')) AS repaired_sha256
FROM everyone o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
