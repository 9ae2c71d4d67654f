"""Trailing windows from panes against the pings of the whole day."""

import random

import pytest

from mallflow.operators import clean as cleaning
from mallflow.operators import floors, shops
from mallflow.operators.panes import pane_summary, trailing_panes
from mallflow.operators.parse import parse_pings
from mallflow.plans.documents import TRAILING, trailing_documents
from rows import clean, clean_pings, dims, lines, message
from test_stream import BLACKLIST, DAY, SHOPS, contents, mall

AS_OF = "2018-04-03 12:30:30"
AS_OF_SECONDS = 1522758630


def sent(seed, n):
    pick = random.Random(seed)
    return [
        message(f"2018-04-03 {pick.randint(10, 12):02d}:{pick.randint(0, 59):02d}:{pick.randint(0, 59):02d}", f"m{pick.randint(0, 9)}", f"F{pick.randint(1, 2)}", 14 * pick.randint(0, 2), 14 * pick.randint(0, 1))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seconds", [60, 61, 600, 3600])
def test_windows_are_exact_to_the_second(spark, seconds):
    pick = random.Random(seconds)
    rows = [clean(f"2018-04-03 1{pick.randint(0, 1)}:{pick.randint(0, 59):02d}:{pick.randint(0, 59):02d}", f"m{pick.randint(0, 30)}", pick.choice(["A", "B", "C"])) for _ in range(400)]
    day = clean_pings(spark, *rows)
    panes = pane_summary(clean_pings(spark, *rows[:150])).unionByName(pane_summary(clean_pings(spark, *rows[100:])))
    for as_of in pick.sample(range(1522749600, 1522756800), 4):
        for metric in (shops.shop_flow, floors.floor_uv, shops.day_top_category):
            want = sorted(map(str, metric(cleaning.trailing(day, as_of, seconds)).collect()))
            assert sorted(map(str, metric(trailing_panes(panes, as_of, seconds)).collect())) == want


def test_a_window_has_a_minute_at_least(spark):
    with pytest.raises(ValueError, match="60"):
        trailing_panes(pane_summary(clean_pings(spark)), 0, 59)


def test_the_job_keeps_them_through_late_pings_and_changes(spark, tmp_path):
    first, late, last = sent(1, 300), sent(2, 60), sent(3, 30)
    names = tuple(TRAILING)
    more = {"clock": lambda _: AS_OF, "trailing": names, "products": (), "links": False}
    job = mall(spark, tmp_path, **more)
    job.process(lines(spark, *first), 0)
    job.process(lines(spark, *late), 1)
    changed = [(x, y, f, "renamed" if (x, f) == (1, "F1") else n, t) for x, y, f, n, t in SHOPS]
    mall(spark, tmp_path, shops=changed, blacklist=["m3"], **more).process(lines(spark, *last), 2)

    def expected(texts, shop_map, blacklist):
        day = cleaning.wash_day(parse_pings(lines(spark, *texts)), dims(spark, shop_map, blacklist))
        seen = {name: cleaning.trailing(day, AS_OF_SECONDS, TRAILING[name].seconds) for name in names}
        return sorted(row for name in names for row in contents(trailing_documents(name, seen[name], AS_OF)))

    assert contents(job.warehouse.metrics.read_day(DAY, *names)) == expected(first + late + last, changed, ["m3"])
    assert expected(first + late + last, changed, ["m3"]) != expected(first + late + last, SHOPS, BLACKLIST)
    assert all(r["ok"] for r in job.status(DAY).collect())


def test_switched_on_later(spark, tmp_path):
    more = {"clock": lambda _: AS_OF, "products": (), "links": False}
    mall(spark, tmp_path, **more).process(lines(spark, *sent(1, 100)), 0)
    job = mall(spark, tmp_path, trailing=("trailing_floor",), **more)
    job.process(lines(spark, *sent(2, 20)), 1)
    day = cleaning.wash_day(parse_pings(lines(spark, *sent(1, 100), *sent(2, 20))), dims(spark, SHOPS, BLACKLIST))
    want = contents(trailing_documents("trailing_floor", cleaning.trailing(day, AS_OF_SECONDS, 600), AS_OF))
    assert contents(job.warehouse.metrics.read_day(DAY, "trailing_floor")) == want
