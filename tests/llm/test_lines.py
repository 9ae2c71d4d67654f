"""Line dedup against plain counting, and the life of the runs."""

from collections import Counter

import pytest

import cases
from mallflow.llm import lines

WHITE = " \t\n\x0b\f\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def plain(texts, at_least, min_chars=1):
    split = [(t or "").split("\n") for t in texts]
    found = Counter(k for rows in split for k in {key(line) for line in rows})
    common = {k for k, n in found.items() if n >= at_least and len(k) >= min_chars}
    return [(len(rows), sum(key(x) in common for x in rows), "\n".join(x for x in rows if key(x) not in common)) for rows in split]


TEXTS = [
    *[f"Shared Line \n own {i}\n\n\x0bshared line\r\nÄrger" for i in range(6)],
    *["copy one\ncopy two"] * 5,
    "shared line",
    "\n",
    "",
    None,
    None,
    " \t \n\n x",
    "ärger\nÄRGER",
    "last\n",
    "a\x00b\nlong " + "word " * 30_000,
    "\n".join(["shared line", "x"] * 20_000),
]


@pytest.mark.parametrize("at_least, min_chars", [(1, 1), (2, 1), (3, 2), (6, 1), (7, 1), (100, 1)])
def test_against_plain_counting(spark, at_least, min_chars):
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lines string, text_id string, places int")
    got = lines.drop_common_lines(docs, at_least, min_chars, into="made")
    assert got.columns == [*docs.columns, "made"]
    made = {r["doc_id"]: tuple(r["made"]) for r in got.collect()}
    assert [made[i] for i in range(len(TEXTS))] == plain(TEXTS, at_least, min_chars)


def test_awkward_documents(spark):
    docs = cases.documents(spark)
    got = lines.drop_common_lines(docs, 2)
    want = plain([r[1] for r in cases.rows()], 2)
    assert sorted(tuple(r["lines"]) for r in got.collect()) == sorted(want)
    assert lines.drop_common_lines(cases.no_documents(spark)).collect() == []


def counts_of(spark, *texts):
    return lines.key_counts(spark.createDataFrame([(t,) for t in texts], "text string"))


@pytest.mark.parametrize("fanout", [2, 3])
def test_runs_are_levelled_and_survive_a_new_start(spark, tmp_path, fanout):
    batches = [[f"hot\nonly {b}\nrow {b % 4}", f"hot\nrow {b % 3}\nmore {b}"] for b in range(9)]
    root = str(tmp_path / "runs")
    for b, texts in enumerate(batches):
        # A new object each time, as after a restart; each batch is handed in twice.
        for _ in range(2):
            lines.LineRuns(spark, root, 4, fanout).add(str(b), counts_of(spark, *texts))
    runs = lines.LineRuns(spark, root, 4, fanout)
    found = Counter(k for texts in batches for t in texts for k in set(t.split("\n")))
    want = spark.createDataFrame([(k,) for k, n in found.items() if n >= 4], "key string")
    assert runs.common().exceptAll(lines._hashed(want, min_chars=1)).isEmpty()
    assert runs.common().count() == want.count() > 3
    for kind in ("run", "settled"):
        levels = Counter(level for level, _ in runs.live(kind))
        assert max(levels) >= 1 and max(levels.values()) < fanout
    # What is settled goes into no later run.
    hot = lines._hashed(spark.createDataFrame([("hot",)], "key string"), min_chars=1)
    newest = max(runs.live(), key=lambda run: int(run[1].split("-")[1]))[1]
    assert runs._read(newest).join(hot, ["h1", "h2"]).isEmpty()
    assert runs.unseen(counts_of(spark, "hot\nnew")).count() == 1


def test_a_lost_run_is_written_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "runs")
    lines.LineRuns(spark, root, 2).add("a", counts_of(spark, "one\ntwo"))
    with monkeypatch.context() as patch:
        patch.setattr(lines.LineRuns, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            lines.LineRuns(spark, root, 2).add("b", counts_of(spark, "two"))
    runs = lines.LineRuns(spark, root, 2)
    assert runs.live() == [(0, "run-1")]
    runs.add("b", counts_of(spark, "two"))
    assert runs.common().count() == 1


def test_first_of_every_line(spark, tmp_path):
    runs = lines.LineRuns(spark, str(tmp_path / "runs"), 1)
    for b, (texts, new) in enumerate([(["x\ny"], 2), (["y\nz"], 1), (["x", "z\nx"], 0)]):
        counts = counts_of(spark, *texts)
        assert runs.unseen(counts).count() == new
        runs.add(str(b), counts)
    assert runs.common().count() == 3


def test_bad_settings(spark, tmp_path):
    for more in ({"at_least": 0}, {"fanout": 1}):
        with pytest.raises(ValueError):
            lines.LineRuns(spark, str(tmp_path), **more)
