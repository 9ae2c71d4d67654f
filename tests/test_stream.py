import pytest

from mallflow.operators.clean import clean_batch, wash_day
from mallflow.operators.flow import minute_flow
from mallflow.operators.links import consecutive_links
from mallflow.operators.parse import parse_pings, pings_of
from mallflow.plans import documents
from mallflow.plans.warehouse import Warehouse
from mallflow.sources.messages import file_messages
from mallflow.streaming import flow as flow_stream
from mallflow.streaming import job as job_module
from mallflow.streaming.job import MallJob
from mallflow.streaming.landing import messages_of
from pyspark.sql import functions as F
from rows import as_sets, dims, lines, message

SHOPS = [(x, y, f"F{f}", f"shop{x}{y}" if x else "走道", "t" if y else None) for x in range(3) for y in range(2) for f in (1, 2)]
BLACKLIST = ["m5"]
AS_OF = "2018-04-03 23:00:00"
DAY = "20180403"
DAY_PRODUCTS = ["today_total", "day_max_shop", "day_catalog", "floor_day_flow", "heat_map", "brand_link"]


def texts(start, stop):
    return [
        message(
            f"2018-04-03 {8 + i % 15:02d}:{i * 7 % 60:02d}:{i * 11 % 60:02d}",
            f"m{i % 23}",
            f"F{1 + i % 2}",
            i * 5 % 52,
            i * 3 % 27,
        )
        for i in range(start, stop)
    ] + ["broken"]


def put(directory, name, rows):
    directory.mkdir(exist_ok=True)
    hidden = directory / f"_{name}"
    hidden.write_text("\n".join(rows) + "\n")
    hidden.rename(directory / name)


def contents(docs):
    return sorted(
        (r["bi_name"], r["dt_hour"], r["dt_min"], tuple(sorted(r["bi_value"].items()))) for r in docs.collect()
    )


def expected(spark, rows, names=DAY_PRODUCTS, shops=SHOPS, blacklist=BLACKLIST):
    tables_ = dims(spark, shops, blacklist)
    day = wash_day(parse_pings(lines(spark, *rows)), tables_)
    state = documents.snapshot(day, day)
    return sorted(row for name in names for row in contents(documents.product_documents(name, state, AS_OF)))


def expected_links(spark, rows, shops=SHOPS, blacklist=BLACKLIST):
    day = wash_day(parse_pings(lines(spark, *rows)), dims(spark, shops, blacklist)).withColumn("p_dt", F.lit(DAY))
    return as_sets(consecutive_links(day), "mac", "date_time", "from_name", "to_name")


def stored_day(job):
    return contents(job.warehouse.metrics.read().where(F.col("bi_name").isin(DAY_PRODUCTS)))


def stored_links(job, day=DAY):
    return as_sets(job.warehouse.links(day), "mac", "date_time", "from_name", "to_name")


def mall(spark, tmp_path, shops=SHOPS, blacklist=BLACKLIST, **more):
    more.setdefault("clock", lambda _: AS_OF)
    return MallJob(Warehouse(spark, str(tmp_path / "mall")), lambda: dims(spark, shops, blacklist), **more)


def run(job, spark, inbox, files=1):
    job.start(file_messages(spark, str(inbox), files), availableNow=True).awaitTermination()


def test_stream_equals_batch_and_goes_on_after_restart(spark, tmp_path):
    inbox, job = tmp_path / "inbox", mall(spark, tmp_path)
    put(inbox, "a", texts(0, 60))
    put(inbox, "b", texts(60, 120))
    run(job, spark, inbox)
    assert stored_day(job) == expected(spark, texts(0, 120))
    assert stored_links(job) == expected_links(spark, texts(0, 120))
    put(inbox, "c", texts(120, 150))
    run(mall(spark, tmp_path), spark, inbox)
    assert stored_day(job) == expected(spark, texts(0, 150))
    assert stored_links(job) == expected_links(spark, texts(0, 150))

    # Batch metrics are those of the last batch; the flow series has grown with every batch.
    everything = parse_pings(lines(spark, *texts(120, 150)))
    rt = clean_batch(everything, dims(spark, SHOPS, BLACKLIST))
    day = wash_day(parse_pings(lines(spark, *texts(0, 150))), dims(spark, SHOPS, BLACKLIST))
    state = documents.snapshot(rt, day)
    kept = job.warehouse.metrics.read()
    for name in ("rt_max_shop", "rt_floor_flow", "rt_catalog"):
        want = contents(documents.product_documents(name, state, AS_OF))
        assert contents(kept.where(F.col("bi_name") == name)) == want
    series = {r["batch_id"]: r["count"] for r in kept.where("bi_name = 'today_flow'").groupBy("batch_id").count().collect()}
    assert sorted(series) == [0, 1, 2] and series[2] == minute_flow(rt).count()

    assert job.warehouse.dead_letters(DAY).count() == 3
    assert job.warehouse.pings(DAY).count() == 150
    status = job.status(DAY).collect()
    assert all(r["ok"] for r in status) and len(status) == 3 * (len(documents.PRODUCTS) + 1)
    assert {r["detail"] for r in status if r["step"] == "batch_counts" and r["batch_id"] == 2} == {
        f"raw=30 clean={rt.count()}"
    }


def test_batch_run_again_changes_nothing(spark, tmp_path):
    job = mall(spark, tmp_path)
    job.process(lines(spark, *texts(0, 40)), 0)
    second = lines(spark, *texts(40, 80))
    job.process(second, 1)
    once = contents(job.warehouse.metrics.read())
    # The clock has passed midnight by now: the batch keeps its first date.
    late = mall(spark, tmp_path, clock=lambda _: "2018-04-04 00:01:00")
    late.process(second, 1)
    assert contents(job.warehouse.metrics.read()) == once
    assert stored_day(job) == expected(spark, texts(0, 80))
    assert job.warehouse.pings("20180404").count() == 0


def test_stream_goes_on_after_a_failed_batch(spark, tmp_path, monkeypatch):
    inbox, job = tmp_path / "inbox", mall(spark, tmp_path)
    put(inbox, "a", texts(0, 40))
    run(job, spark, inbox)
    put(inbox, "b", texts(40, 80))

    def lost(self, *args, **more):
        raise RuntimeError("lost on the way")

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "refresh", lost)
        with pytest.raises(Exception, match="lost on the way"):
            run(job, spark, inbox)
    run(job, spark, inbox)
    assert stored_day(job) == expected(spark, texts(0, 80))
    assert stored_links(job) == expected_links(spark, texts(0, 80))
    assert job.warehouse.pings(DAY).count() == 80


def test_changed_shop_map_rebuilds_the_day(spark, tmp_path):
    renamed = [(x, y, f, n.upper(), "new") for x, y, f, n, _ in SHOPS]
    mall(spark, tmp_path).process(lines(spark, *texts(0, 60)), 0)
    job = mall(spark, tmp_path, shops=renamed, blacklist=["m7"])
    job.process(lines(spark), 1)
    job.process(lines(spark, *texts(60, 90)), 2)
    assert stored_day(job) == expected(spark, texts(0, 90), shops=renamed, blacklist=["m7"])
    assert stored_links(job) == expected_links(spark, texts(0, 90), shops=renamed, blacklist=["m7"])


def test_next_day_starts_anew(spark, tmp_path):
    mall(spark, tmp_path).process(lines(spark, *texts(0, 40)), 0)
    job = mall(spark, tmp_path, clock=lambda _: "2018-04-04 10:00:00", links=False)
    # Late pings of the day before, counted on the day they arrive.
    job.process(lines(spark, *texts(40, 60)), 1)
    assert job.warehouse.pings(DAY).count() == 40 and job.warehouse.pings("20180404").count() == 20
    days = {r["p_dt"] for r in job.warehouse.metrics.read().select("p_dt").distinct().collect()}
    assert days == {DAY, "20180404"}
    assert stored_links(job) == expected_links(spark, texts(0, 40))


def test_empty_batch_is_skipped(spark, tmp_path):
    job = mall(spark, tmp_path)
    job.process(lines(spark), 0)
    assert job.warehouse.pings(DAY).count() == 0 and job.status(DAY).count() == 0


def test_batch_of_broken_lines_only(spark, tmp_path):
    job = mall(spark, tmp_path)
    job.process(lines(spark, *texts(0, 30)), 0)
    job.process(lines(spark, "broken", ""), 1)
    assert job.warehouse.dead_letters(DAY).count() == 3 and job.warehouse.pings(DAY).count() == 30
    assert all(r["ok"] for r in job.status(DAY).collect())
    assert stored_day(job) == expected(spark, texts(0, 30))
    assert job.warehouse.metrics.read_day(DAY, "rt_max_shop", "rt_floor_flow", "rt_catalog").count() == 0


@pytest.mark.parametrize("clock", ["2040-01-01 00:00:00", "0001-01-01 00:00:00"])
def test_an_instant_that_cannot_be_stored_is_a_dead_letter(spark, tmp_path, clock):
    inbox, job = tmp_path / "inbox", mall(spark, tmp_path)
    odd = message(clock)
    put(inbox, "a", [message(), odd, message("2018-04-03 11:00:00", "m2")])
    run(job, spark, inbox)
    for _ in range(2):
        assert job.warehouse.pings(DAY).count() == 2
        assert [r["value"] for r in job.warehouse.dead_letters(DAY).collect()] == [odd]
        job.process(lines(spark, message(), odd, message("2018-04-03 11:00:00", "m2")), 0)


def test_lines_are_parsed_in_the_source_partitions(spark):
    many = spark.range(160).selectExpr(f"'{message()}' as value").repartition(16)
    with messages_of(many) as messages:
        assert messages.read.rdd.getNumPartitions() == 16
        assert pings_of(messages.read).select(F.spark_partition_id().alias("p")).distinct().count() > 1
        assert messages.in_files(pings_of(messages.read)).rdd.getNumPartitions() == 1


def test_batch_outside_business_hours(spark, tmp_path):
    job = mall(spark, tmp_path)
    job.process(lines(spark, message("2018-04-03 08:00:00")), 0)
    assert job.warehouse.pings(DAY).count() == 1 and job.warehouse.clean_pings(DAY).count() == 0
    assert all(r["ok"] for r in job.status(DAY).collect())
    flow = job.warehouse.metrics.read().where("bi_name = 'today_flow'").first()["bi_value"]
    assert flow == {"count": "1", "staty": None}


def test_failing_metric_is_recorded_and_stops_no_other(spark, tmp_path, monkeypatch):
    def broken(state):
        raise ValueError("no such metric")

    broken_product = documents.Product(broken, {})
    monkeypatch.setitem(job_module.PRODUCTS, "rt_max_shop", broken_product)
    job = mall(spark, tmp_path)
    job.process(lines(spark, *texts(0, 40)), 0)
    failed = [r for r in job.status(DAY).collect() if not r["ok"]]
    assert [(r["step"], "no such metric" in r["detail"]) for r in failed] == [("rt_max_shop", True)]
    assert stored_day(job) == expected(spark, texts(0, 40))


def test_a_failed_step_is_made_up_for_by_the_next_batch(spark, tmp_path, monkeypatch):
    tables_ = dims(spark, SHOPS, BLACKLIST)

    def broken(state):
        raise ValueError("for once")

    job = mall(spark, tmp_path)
    job.process(lines(spark, *texts(0, 40)), 0)
    with monkeypatch.context() as patch:
        patch.setitem(job_module.PRODUCTS, "today_flow", documents.Product(broken, {}, appends=True))
        patch.setitem(job_module.PRODUCTS, "today_total", documents.Product(broken, {}))
        job.process(lines(spark, *texts(40, 80)), 1)
        assert {r["step"] for r in job.status(DAY).where("not ok").collect()} == {"today_flow", "today_total"}
    # A batch without messages in between, another clock and other static tables.
    job.process(lines(spark), 2)
    later = mall(spark, tmp_path, blacklist=["m1"], clock=lambda _: "2018-04-03 23:10:00")
    later.process(lines(spark, *texts(80, 100)), 3)
    later.process(lines(spark, *texts(100, 110)), 4)

    rt = clean_batch(parse_pings(lines(spark, *texts(40, 80))), tables_)
    day = wash_day(parse_pings(lines(spark, *texts(0, 80))), tables_)
    want = contents(documents.product_documents("today_flow", documents.snapshot(rt, day), AS_OF))
    kept = job.warehouse.metrics.read().where("bi_name = 'today_flow'")
    assert contents(kept.where("batch_id = 1")) == want
    assert {r["batch_id"] for r in kept.select("batch_id").distinct().collect()} == {0, 1, 3, 4}
    rows = {r["step"]: (r["ok"], r["tries"]) for r in job.status(DAY).where("batch_id = 1").collect()}
    # What the next batch replaces anyway is not run again.
    assert rows.pop("today_flow") == (True, 2) and rows.pop("today_total") == (False, 1)
    assert set(rows.values()) == {(True, 1)}
    assert later._run(3).pending == [f"{DAY}/1"] and later._run(4).pending == []
    assert contents(job.warehouse.metrics.read().where("bi_name = 'today_total'"))


def test_a_step_that_always_fails_is_given_up(spark, tmp_path, monkeypatch):
    def broken(state):
        raise ValueError("always")

    monkeypatch.setitem(job_module.PRODUCTS, "today_flow", documents.Product(broken, {}, appends=True))
    job = mall(spark, tmp_path, products=["today_flow"], links=False)
    for batch in range(job_module.TRIES + 2):
        job.process(lines(spark, message()), batch)
    tries = {r["batch_id"]: r["tries"] for r in job.status(DAY).where("step = 'today_flow'").collect()}
    assert tries == {0: 3, 1: 3, 2: 3, 3: 2, 4: 1}
    assert job._run(batch).pending == [f"{DAY}/2", f"{DAY}/3"]


def test_own_clock_is_clock_text(spark, tmp_path):
    assert len(mall(spark, tmp_path, clock=None)._now(0)) == 19


def test_minute_flow_stream(spark, tmp_path):
    inbox = tmp_path / "inbox"
    put(inbox, "a", texts(0, 60))
    put(inbox, "b", texts(60, 90))
    tables_ = dims(spark, SHOPS, BLACKLIST)
    house = Warehouse(spark, str(tmp_path / "out"))
    query = flow_stream.stream_minute_flow(
        file_messages(spark, str(inbox), 1), lambda: tables_, house, DAY, availableNow=True
    )
    query.awaitTermination()
    got = flow_stream.stored_minute_flow(house).drop("p_dt")
    batches = [sorted(map(tuple, got.where(F.col("batch_id") == n).drop("batch_id").collect())) for n in (0, 1)]
    want = [minute_flow(clean_batch(parse_pings(lines(spark, *rows)), tables_)) for rows in (texts(0, 60), texts(60, 90))]
    # Files of the same age may come in either order.
    assert sorted(batches) == sorted(sorted(map(tuple, w.collect())) for w in want)


@pytest.mark.parametrize("trigger", [{}, {"processingTime": "1 second"}])
def test_running_query_can_be_stopped(spark, tmp_path, trigger):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    query = mall(spark, tmp_path).start(file_messages(spark, str(inbox)), **trigger)
    try:
        assert query.isActive
    finally:
        query.stop()
