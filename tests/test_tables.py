from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mallflow.plans.backfill import DATED_CLEAN_PING, backfill_links
from mallflow.plans.warehouse import LINKS
from mallflow.schema import CLEAN_PING, METRIC, PING, with_keys
from mallflow.session import scratch_dir, size_for, stored_bytes, together
from mallflow.sources import tables, text
from mallflow.sources.messages import file_messages, kafka_messages
from mallflow.sources.metrics import MetricStore
from mallflow.plans.documents import metric_documents
from rows import as_sets, clean, clean_pings, ping, pings

DATED_PING = with_keys(PING, ("p_dt", T.StringType()))


def counts(spark, root):
    return as_sets(tables.scan(spark, root, DATED_PING).groupBy("p_dt").count(), "p_dt", "count")


def test_append_is_repeatable_and_adds_up(spark, tmp_path):
    root = str(tmp_path / "ods")
    one, two = pings(spark, ping(), ping()), pings(spark, ping())
    tables.append_batch(one, root, "20180403", 0)
    tables.append_batch(two, root, "20180403", 1)
    tables.append_batch(two, root, "20180403", 1)
    tables.append_batch(two, root, "20180404", 2)
    assert counts(spark, root) == [("20180403", 3), ("20180404", 1)]
    back = tables.scan_day(spark, root, DATED_PING, "20180404")
    assert back.drop("p_dt").collect() == two.collect()
    assert dict(back.dtypes)["p_dt"] == "string"


def test_late_ping_stays_under_the_run_date(spark, tmp_path):
    root = str(tmp_path / "ods")
    tables.append_batch(pings(spark, ping("2018-04-02 23:59:59")), root, "20180403", 0)
    row = tables.scan_day(spark, root, DATED_PING, "20180403").first()
    assert (row["dt_day"], row["dt_hour"], row["dt_min"]) == (2, 23, 59)


def test_overwrite_touches_one_day(spark, tmp_path):
    root = str(tmp_path / "dw")
    tables.overwrite_day(pings(spark, ping(), ping()), root, "20180403")
    tables.overwrite_day(pings(spark, ping(), ping()), root, "20180404")
    tables.overwrite_day(pings(spark, ping()), root, "20180403")
    assert counts(spark, root) == [("20180403", 1), ("20180404", 2)]
    tables.overwrite_day(pings(spark), root, "20180403")
    assert counts(spark, root) == [("20180403", 1), ("20180404", 2)]
    tables.replace_day(pings(spark), root, "20180403")
    assert counts(spark, root) == [("20180404", 2)]


def test_missing_table_is_empty(spark, tmp_path):
    assert tables.scan(spark, str(tmp_path / "none"), DATED_PING).count() == 0


def test_day_scan_prunes_partitions_and_columns(spark, tmp_path):
    root = str(tmp_path / "ods")
    tables.overwrite_day(pings(spark, ping()), root, "20180403")
    frame = tables.scan_day(spark, root, DATED_PING, "20180403").where("dt_hour >= 9").select("mac")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p_dt" in plan
    assert "ReadSchema: struct<dt_hour:int,mac:string>" in plan
    assert "GreaterThanOrEqual(dt_hour,9)" in plan


def test_only_the_asked_partitions_are_listed(spark, tmp_path):
    root = str(tmp_path / "ods")
    for n, day in enumerate(("20180403", "20180404", "20180405")):
        tables.append_batch(pings(spark, ping(mac=day)), root, day, n)
    (tmp_path / "ods" / "p_dt=20180405" / "batch_id=2" / "broken.parquet").mkdir()
    days = tables.scan_days(spark, root, DATED_PING, ["20180403", "20180404", "20180409"])
    assert as_sets(days, "p_dt", "mac") == [("20180403", "20180403"), ("20180404", "20180404")]
    assert {f.rsplit("/", 3)[1] for f in days.inputFiles()} == {"p_dt=20180403", "p_dt=20180404"}
    assert tables.scan_days(spark, root, DATED_PING, ["20180408", "20180409"]).count() == 0
    assert tables.scan_day(spark, root, DATED_PING, "20180404", "batch_id=1").count() == 1
    assert tables.scan_day(spark, root, DATED_PING, "20180404", "batch_id=7").count() == 0


def docs(spark, n, name="m"):
    return metric_documents(spark.range(n), name, "2018-04-03 10:00:00", {"id": "id"})


def stored(store):
    return as_sets(store.read().select("bi_name", "p_dt", F.col("bi_value")["id"].alias("id")), "bi_name", "p_dt", "id")


def test_metric_replace_and_append(spark, tmp_path):
    store = MetricStore(spark, str(tmp_path / "metrics"))
    store.replace(docs(spark, 3), "m", "20180403", 0)
    store.replace(docs(spark, 1, "other"), "other", "20180403", 0)
    store.replace(docs(spark, 2), "m", "20180403", 1)
    assert stored(store) == [("m", "20180403", "0"), ("m", "20180403", "1"), ("other", "20180403", "0")]
    store.replace(docs(spark, 0), "m", "20180403", 2)
    assert stored(store) == [("other", "20180403", "0")]
    for batch in (3, 4, 4):
        store.append(docs(spark, 1, "series"), "series", "20180403", batch)
    assert stored(store)[1:] == [("series", "20180403", "0")] * 2
    assert store.read_day("20180403", "series", "none").count() == 2
    row = store.read_day("20180403", "series").first()
    assert {name: row[name] for name in METRIC.names if name != "bi_value"} == {
        "mall_id": "sh001",
        "p_dt": "20180403",
        "dt_year": "2018",
        "dt_month": "04",
        "dt_day": "03",
        "dt_hour": "10",
        "dt_min": "00",
        "bi_name": "series",
    }


def test_backfill_rebuilds_only_the_asked_days(spark, tmp_path):
    dw_root, links_root = str(tmp_path / "dw"), str(tmp_path / "links")
    for day in ("03", "04", "05"):
        rows = [clean(f"2018-04-{day} 1{i}:00:00", "a", n) for i, n in enumerate("ABA")]
        tables.overwrite_day(clean_pings(spark, *rows), dw_root, f"201804{day}")
    assert tables.scan(spark, dw_root, DATED_CLEAN_PING).count() == 9
    backfill_links(spark, dw_root, links_root, ["20180403", "20180404"])
    want = [(f"201804{d}", a, b) for d in ("03", "04") for a, b in (("A", "B"), ("B", "A"))]
    assert as_sets(tables.scan(spark, links_root, LINKS), "p_dt", "from_name", "to_name") == want
    tables.overwrite_day(clean_pings(spark, clean(name="A"), clean("2018-04-03 11:00:00", name="C")), dw_root, "20180403")
    backfill_links(spark, dw_root, links_root, ["20180403"])
    assert as_sets(tables.scan(spark, links_root, LINKS), "p_dt", "from_name", "to_name") == [
        ("20180403", "A", "C"),
        ("20180404", "A", "B"),
        ("20180404", "B", "A"),
    ]


@pytest.mark.parametrize("days", [["20180403"], None])
def test_backfill_empties_a_day_that_lost_its_moves(spark, tmp_path, days):
    dw_root, links_root = str(tmp_path / "dw"), str(tmp_path / "links")
    for day in ("03", "04"):
        rows = [clean(f"2018-04-{day} 1{i}:00:00", "a", n) for i, n in enumerate("AB")]
        tables.overwrite_day(clean_pings(spark, *rows), dw_root, f"201804{day}")
    backfill_links(spark, dw_root, links_root)
    assert tables.scan(spark, links_root, LINKS).count() == 2
    tables.overwrite_day(clean_pings(spark, clean(name="A")), dw_root, "20180403")
    backfill_links(spark, dw_root, links_root, days)
    assert as_sets(tables.scan(spark, links_root, LINKS), "p_dt", "from_name", "to_name") == [("20180404", "A", "B")]


def test_clean_pings_keep_their_schema(spark, tmp_path):
    root = str(tmp_path / "dw")
    tables.overwrite_day(clean_pings(spark, clean(name=None, type=None)), root, "20180403")
    back = tables.scan(spark, root, DATED_CLEAN_PING).drop("p_dt")
    assert back.schema == CLEAN_PING
    assert back.collect() == clean_pings(spark, clean(name=None, type=None)).collect()


def test_text_reading(spark, tmp_path):
    top = tmp_path / "logs+here 1%"
    (top / "deeper").mkdir(parents=True)
    (top / "k=v").mkdir()
    twin = tmp_path / "logs+here 1%" / str(top).lstrip("/")
    twin.mkdir(parents=True)
    (twin / "e.txt").write_bytes(b"six\n")
    (top / "a.txt").write_bytes(b"one\r\n\ntwo\n")
    (top / "b.txt").write_bytes(b"three")
    (top / "deeper" / "c.txt").write_bytes(b"four\n")
    (top / "k=v" / "d.txt").write_bytes(b"five\n")
    got = text.read_directory(spark, str(top))
    assert as_sets(got, "directory", "value") == [("logs+here 1%", v) for v in ("", "one\r", "three", "two")]
    assert text.read_directory(spark, f"file://{top}").count() == got.count()
    assert as_sets(text.read_lines(spark, str(top / "deeper" / "c.txt")), "value") == [("four",)]


def test_file_stream_has_one_value_column(spark, tmp_path):
    stream = file_messages(spark, str(tmp_path), max_files=1)
    assert stream.isStreaming and stream.columns == ["value"]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_messages(spark, "localhost:1", "pings")


def cluster(setting, checkpoint_dir=None, master="spark://driver:7077"):
    """Only the parts of a session that choose the scratch folder."""
    conf = SimpleNamespace(get=lambda key, default: setting if key == "spark.checkpoint.dir" and setting else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getCheckpointDir=lambda: checkpoint_dir, master=master))


def test_scratch_follows_the_shared_folder(spark):
    assert scratch_dir(cluster("hdfs://shared/ckpt/"), "x").startswith("hdfs://shared/ckpt/mallflow/x-")
    assert scratch_dir(cluster(None, "hdfs://set/later"), "x").startswith("hdfs://set/later/mallflow/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(cluster(None), "x")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_input_size_sets_the_shuffle_width(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    assert 0 < stored_bytes(spark, str(tmp_path / "t")) < 100_000
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    size_for(spark, 1000)
    assert spark.conf.get(key) == "8"
    size_for(spark, 10**12)
    assert spark.conf.get(key) == "7451"
    size_for(spark, 10**14)
    assert spark.conf.get(key) == "20000"
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1000000000"
    size_for(spark, 10**14, max_shuffle_partitions=10**6, max_scan_tasks=10**7)
    assert spark.conf.get(key) == "745059"
    size_for(spark, 1000)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") in ("134217728", "134217728b")
    assert stored_bytes(spark, str(tmp_path / "none")) == 0


def test_together_keeps_order_and_raises(spark):
    assert together(spark, lambda: 1, lambda: spark.range(5).count()) == [1, 5]
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda: 1 / 0, lambda: 2)
