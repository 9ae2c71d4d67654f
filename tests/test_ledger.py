"""The ledger of what batches took from their source."""

from mallflow.sources import ledger
from mallflow.sources.messages import file_messages
from rows import as_sets, message
from test_stream import mall, put, texts

NAMES = ("batch_id", "origin", "kind", "messages")


def rows(spark, *values):
    return spark.createDataFrame([(*v[:4], v[4]) for v in values], ledger.LEDGER)


def test_breaks_of_a_topic(spark):
    kept = rows(
        spark,
        ("t/0", 0, 9, 10, 0), ("t/0", 10, 19, 10, 1), ("t/0", 25, 29, 5, 2), ("t/0", 27, 34, 8, 4),
        ("t/1", 5, 9, 3, 0), ("t/1", 10, 12, 3, 3), ("t/1", 2, 3, 2, 4),
    )
    assert as_sets(ledger.breaks(kept), *NAMES) == [(0, "t/1", "hole", 2), (2, "t/0", "gap", 5), (4, "t/0", "repeat", 3), (4, "t/1", "repeat", 2)]


def test_breaks_and_missed_files(spark):
    kept = rows(spark, ("a", None, None, 7, 0), ("b", None, None, 4, 1), ("a", None, None, 7, 2))
    assert as_sets(ledger.breaks(kept), *NAMES) == [(2, "a", "repeat", 7)]
    files = spark.createDataFrame([("a", 7), ("b", 5), ("c", 2)], "origin string, messages long")
    assert as_sets(ledger.missed_files(kept, files), "origin", "messages") == [("b", 1), ("c", 2)]
    assert ledger.breaks(rows(spark)).isEmpty()


def test_places_of_a_batch(spark):
    batch = spark.createDataFrame([("t/0", 4), ("t/0", 6), ("t/1", 1), ("f", None), ("f", None)], "origin string, place long")
    got = as_sets(ledger.taken(batch), "origin", "first", "last", "messages")
    assert got == [("f", None, None, 2), ("t/0", 4, 6, 2), ("t/1", 1, 1, 1)]


def test_a_stream_notes_its_files(spark, tmp_path):
    inbox, job = tmp_path / "inbox", mall(spark, tmp_path)
    put(inbox, "a", texts(0, 20))
    put(inbox, "b", [message()])
    stream = file_messages(spark, str(inbox), 1, origins=True)
    assert stream.columns == ["value", "origin", "place"]
    job.start(stream, availableNow=True).awaitTermination()
    kept = job.warehouse.ledger.read()
    assert sorted((r["origin"][-1], r["messages"]) for r in kept.collect()) == [("a", 21), ("b", 1)]
    assert {r["batch_id"] for r in kept.collect()} == {0, 1}
    assert ledger.breaks(kept).isEmpty()
