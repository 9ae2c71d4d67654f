"""Closing a day: the same rows in fewer files, also when it is lost on the way."""

import pytest

from mallflow.__main__ import main
from mallflow.operators.visits import visit_summary
from mallflow.plans import closing
from mallflow.plans.closing import DayIsOpen, close_day
from rows import lines
from test_state import files
from test_stream import DAY, contents, mall, texts

NEXT = "2018-04-04 10:00:00"
TABLES = ("ods", "dw", "dead_letters", "records", "sightings")


def rows(job):
    house, last = job.warehouse, job._run(2)
    read = {name: closing.scan_day(house.spark, house.path(name), closing._TABLES[name][0], DAY).drop("batch_id") for name in TABLES}
    read |= {"visits": visit_summary(house.visits(DAY, last.after)), "minutes": house.minutes(DAY, last.after)}
    found = {name: sorted(str(sorted(r.asDict().items(), key=str)) for r in frame.drop("run").collect()) for name, frame in read.items()}
    return found | {"series": contents(house.metrics.read_day(DAY, "today_flow")), "links": sorted(map(str, house.links(DAY).collect()))}


def started(spark, tmp_path):
    job = mall(spark, tmp_path)
    for batch in range(3):
        job.process(lines(spark, *texts(30 * batch, 30 * batch + 40)), batch)
    return job


def test_same_rows_in_fewer_files(spark, tmp_path, monkeypatch):
    job = started(spark, tmp_path)
    with pytest.raises(DayIsOpen, match="newest"):
        close_day(job.warehouse, DAY)
    later = mall(spark, tmp_path, clock=lambda _: NEXT)
    later.process(lines(spark, *texts(0, 20)), 3)
    before, many = rows(job), {name: len(files(job, name)) for name in TABLES}

    # Lost after a table was written beside the day, and again before the runs are one.
    with monkeypatch.context() as patch:
        patch.setattr(closing, "replace_day", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            close_day(job.warehouse, DAY)
    assert rows(job) == before
    with monkeypatch.context() as patch:
        patch.setattr(closing, "note_run", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            close_day(job.warehouse, DAY)
    main(["close", "--root", job.warehouse.root, DAY], spark)
    assert rows(job) == before
    assert job._run(2).after == ["99-2"]
    assert all(len(files(job, name)) < many[name] for name in TABLES)
    names = {name: files(job, name) for name in TABLES}
    close_day(job.warehouse, DAY)
    assert rows(job) == before and names == {name: files(job, name) for name in TABLES}
    # The next day goes on.
    later.process(lines(spark, *texts(20, 40)), 4)
    assert all(r["ok"] for r in later.status("20180404").collect())


def test_a_day_without_batches(spark, tmp_path):
    close_day(mall(spark, tmp_path).warehouse, DAY)


@pytest.mark.parametrize("days", [[], ["2018-04-03"]])
def test_close_needs_days(spark, days):
    with pytest.raises(SystemExit):
        main(["close", "--root", "r", *days], spark)
