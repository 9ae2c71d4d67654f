"""The mergeable state of the day: what a batch reads, what it leaves alone, and how runs are merged."""

import os
import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from mallflow.operators import floors
from mallflow.plans.runs import Merge, compacted, own_run
from mallflow.plans.warehouse import Warehouse
from mallflow.streaming import job as job_module
from rows import as_sets, clean, clean_pings, lines, message
from test_stream import DAY, expected, expected_links, mall, stored_day, stored_links, texts


def files(job, name, *below):
    root = os.path.join(job.warehouse.path(name), f"p_dt={DAY}", *below)
    return {os.path.join(folder, f) for folder, _, found in os.walk(root) for f in found if f.endswith(".parquet")}


def test_runs_are_merged_level_by_level():
    live, made = [], []
    for batch in range(60):
        live, merges = compacted(live, 3)
        made += merges
        live.append(own_run(batch))
    assert made[0] == Merge(("0-0", "0-1", "0-2"), "1-2")
    assert Merge(("1-2", "1-5", "1-8"), "2-8") in made
    # Every batch is in the live runs once.
    held = {run: {int(run[2:])} for run in live if run.startswith("0")}
    inside = {}
    for merge in made:
        inside[merge.into] = set().union(*[inside.get(run, {int(run[2:])}) for run in merge.runs])
    held |= {run: inside[run] for run in live if not run.startswith("0")}
    assert sorted(b for batches in held.values() for b in batches) == list(range(60))
    assert len(live) <= 3 * 4


def test_a_batch_reads_no_earlier_ping(spark, tmp_path, monkeypatch):
    job = mall(spark, tmp_path)
    job.process(lines(spark, *texts(0, 60)), 0)
    own = Warehouse.pings

    def only_its_own(self, p_dt, *batch_ids):
        assert batch_ids == (1,)
        return own(self, p_dt, *batch_ids)

    monkeypatch.setattr(Warehouse, "pings", only_its_own)
    monkeypatch.setattr(Warehouse, "clean_pings", lambda *_: pytest.fail("reads clean pings of the day"))
    job.process(lines(spark, *texts(60, 70)), 1)
    assert stored_day(job) == expected(spark, texts(0, 70))
    assert stored_links(job) == expected_links(spark, texts(0, 70))


def test_an_untouched_hour_keeps_its_files(spark, tmp_path):
    job = mall(spark, tmp_path)
    first = [message(f"2018-04-03 {h}:{m}0:00", f"m{d}", "F1", 14 * (m % 3), 14 * (d % 2)) for h in (10, 11, 12) for m in range(6) for d in range(4)]
    # A late ping of a new device and one in the middle of a known path, both at eleven.
    late = [message("2018-04-03 11:25:00", "m1", "F1", 0, 0), message("2018-04-03 11:26:00", "m9", "F1", 14, 0)]
    job.process(lines(spark, *first), 0)
    tables = ("links", "edges", "pairs")
    before = {(name, hour): files(job, name, f"part=20180403{hour}") for name in tables for hour in (10, 11, 12)}
    assert all(before.values())
    records = files(job, "records")
    job.process(lines(spark, *late), 1)
    for (name, hour), names in before.items():
        assert (files(job, name, f"part=20180403{hour}") == names) == (hour != 11)
    # What is there of the records stays, and only the touched hour has more.
    assert records < files(job, "records")
    assert {f.split("dt_hour=")[1][:2] for f in files(job, "records") - records} == {"11"}
    assert stored_links(job) == expected_links(spark, first + late)
    assert stored_day(job) == expected(spark, first + late)


def test_a_move_between_hours_can_go(spark, tmp_path):
    """Late pings put the move that led from hour to hour inside one of them."""
    job = mall(spark, tmp_path)
    first = [message("2018-04-03 10:50:00", "a", "F1", 14, 0), message("2018-04-03 11:10:00", "a", "F1", 27, 0)]
    late = [message("2018-04-03 11:05:00", "a", "F1", 14, 0)]
    job.process(lines(spark, *first), 0)
    assert files(job, "links", "part=between") and stored_links(job) == expected_links(spark, first)
    job.process(lines(spark, *late), 1)
    assert stored_links(job) == expected_links(spark, first + late)
    assert as_sets(job.warehouse.pairs(DAY), "from_name", "to_name", "times") == [("shop10", "shop20", 1)]


def test_many_batches_with_repeats_and_merges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(job_module, "compacted", partial(compacted, fan_in=2))
    pick, everything = random.Random(5), texts(0, 120)
    pick.shuffle(everything)
    job, sent = mall(spark, tmp_path), []
    for batch in range(6):
        # Late pings, and pings that came before.
        now = everything[20 * batch : 20 * batch + 20] + sent[: 5 * batch]
        if batch == 3:
            job.process(lines(spark), batch)
            continue
        sent += now
        job.process(lines(spark, *now), batch)
        if batch in (2, 5):
            mall(spark, tmp_path).process(lines(spark, *now), batch)
    assert stored_day(job) == expected(spark, sent)
    assert stored_links(job) == expected_links(spark, sent)
    assert job._run(5).live == ["2-4"]


def test_links_switched_on_make_the_day_anew(spark, tmp_path):
    mall(spark, tmp_path, links=False).process(lines(spark, *texts(0, 40)), 0)
    job = mall(spark, tmp_path)
    job.process(lines(spark, *texts(40, 60)), 1)
    assert stored_links(job) == expected_links(spark, texts(0, 60))
    assert stored_day(job) == expected(spark, texts(0, 60))


def test_records_of_batches_unite(spark):
    rows = [clean(f"2018-04-03 10:0{i % 5}:00", f"m{i % 7}", type=None if i % 3 == 0 else "t", floor=None if i % 11 == 0 else "F1") for i in range(60)]
    day = clean_pings(spark, *rows, *rows[:9])
    want = as_sets(floors.floor_minute_flow(day).where("locName is not null"), "locName", "dt_hour", "dt_min", "cnt")
    parts = [floors.minute_records(clean_pings(spark, *part)) for part in (rows[:30], rows[20:] + rows[:9])]
    new = parts[1].exceptAll(parts[0])
    counts = floors.minute_counts(parts[0]).unionByName(floors.minute_counts(new))
    got = floors.merged_minutes(counts)
    assert as_sets(got.where("locName is not null"), "locName", "dt_hour", "dt_min", "cnt") == want
    assert got.where(F.col("locName").isNull()).agg(F.sum("cnt")).first()[0] == 0
