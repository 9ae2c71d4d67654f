"""Revisits against plain resolution."""

import random

import pytest
from pyspark.sql import functions as F

from mallflow.llm import warc


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTP://WWW.Example.com:80/a/b/?b=2&a=1&utm_source=x#top", "example.com/a/b?a=1&b=2"),
        ("https://example.com", "example.com"),
        ("https://example.com/?ref=q", "example.com"),
        ("example.com/A?reference=1", "example.com/A?reference=1"),
        ("", ""),
        (None, None),
    ],
)
def test_canonical(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(warc.canonical(F.col("u"))).first()[0] == want


def _plain(records):
    out = []
    for r in (x for x in records if x[3] == "revisit"):
        earlier = [x for x in records if x[3] == "response" and x[1] == r[1] and r[1] and None not in (r[2], x[2]) and x[2] < r[2]]
        if not earlier:
            out.append((r[0], "orphan", None))
            continue
        base = max(earlier, key=lambda x: (x[2], x[0]))
        bare = [None if e is None else e.removeprefix("W/") for e in (base[4], r[4])]
        if None not in bare:
            good = bare[0] == bare[1]
        elif None not in (base[5], r[5]):
            good = base[5] == r[5]
        else:
            good = None not in (base[6], r[6]) and base[6] == r[6]
        out.append((r[0], "resolved", base[0]) if good else (r[0], "mismatch", None))
    return sorted(out)


@pytest.mark.parametrize("span", [1, 7, 1000])
def test_as_of(spark, span):
    pick = random.Random(span)
    records = []
    for i in range(800):
        url = pick.choice(["a.com/x", "a.com/x", "a.com/x", "b.com", "c.com/y", None])
        ts = pick.choice([None, *range(-50, 50)]) if pick.random() < 0.1 else pick.randint(-50, 50)
        tag = pick.choice([None, '"1"', 'W/"1"', '"2"'])
        records.append((i, url, ts, pick.choice(["response", "revisit", "request"]), tag, pick.choice([None, "m1", "m2"]), pick.choice([None, "d"]), []))
    rows = warc.resolve_revisits(spark.createDataFrame(records, warc.RECORD), span).collect()
    assert sorted((r["record_id"], r["status"], r["response_id"]) for r in rows) == _plain(records)


def test_headers(spark):
    records = [
        (1, "a.com", 1, "response", '"x"', None, "d", [("Content-Type", "text/html"), ("Date", "1"), ("Vary", "*"), ("date", "2"), (None, "q")]),
        (2, "a.com", 2, "revisit", 'W/"x"', None, None, [("DATE", "9"), ("content-type", "no"), ("Age", "5")]),
        (3, "a.com", 3, "revisit", '"x"', None, None, None),
    ]
    rows = warc.resolve_revisits(spark.createDataFrame(records, warc.RECORD)).orderBy("record_id").collect()
    assert [tuple(h) for h in rows[0]["headers"]] == [("age", "5"), ("content-type", "text/html"), ("date", "9"), ("vary", "*")]
    assert rows[1]["status"] == "resolved" and rows[1]["payload"] == "d"


def test_repeated_and_no_records(spark):
    one = (1, "a.com", 1, "response", None, None, "d", [])
    two = (2, "a.com", 2, "revisit", None, None, "d", [])
    rows = warc.resolve_revisits(spark.createDataFrame([one, one, two, two], warc.RECORD)).collect()
    assert [r["response_id"] for r in rows] == [1, 1]
    assert warc.resolve_revisits(spark.createDataFrame([], warc.RECORD)).collect() == []


def test_captures_of_awkward_pages(spark):
    pages = spark.createDataFrame([(0, None, None), (None, "http://a.com", ""), (7, "http://a.com", "x")], "page_id bigint, url string, html string")
    rows = warc.resolve_revisits(warc.captures(pages.withColumn("ts", F.lit("clash")))).collect()
    assert all(r["status"] == "orphan" for r in rows if r["record_id"] is None or r["record_id"] < 4)
    assert any(r["status"] == "resolved" for r in rows)
