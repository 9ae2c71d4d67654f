import random

from pyspark.sql import functions as F

from mallflow.operators.links import (
    anchor_links,
    consecutive_links,
    edge_links,
    edges,
    hour_links,
    hour_steps,
    link_matrix,
    pair_counts,
)
from mallflow.operators.parse import parse_pings
from rows import as_sets, clean, clean_pings, lines, message

COLUMNS = ("p_dt", "mac", "date_time", "from_name", "to_name", "times")


def paths(rows):
    """Brute force: sightings of each (p_dt, mac) in order of (date_time, name)."""
    out = {}
    for p_dt, mac, when, name in rows:
        if name is not None and mac is not None:
            out.setdefault((p_dt, mac), []).append((when, name))
    return {key: sorted(path) for key, path in out.items()}


def folded(name):
    return name.upper().lower()


def brute_consecutive(rows):
    return sorted(
        (p_dt, mac, b[0], a[1], b[1], 1)
        for (p_dt, mac), path in paths(rows).items()
        for a, b in zip(path, path[1:])
        if folded(a[1]) != folded(b[1])
    )


def brute_anchor(rows):
    return sorted(
        (p_dt, mac, when, path[0][1], name, 1)
        for (p_dt, mac), path in paths(rows).items()
        for when, name in path
        if folded(name) != folded(path[0][1])
    )


def frame(spark, rows):
    ts = F.to_timestamp("date_time")
    parts = {"dt_year": F.year(ts), "dt_month": F.month(ts), "dt_day": F.dayofmonth(ts), "dt_hour": F.hour(ts)}
    sightings = spark.createDataFrame(rows, "p_dt string, mac string, date_time string, name string")
    return sightings.withColumns({"time_stamp": F.unix_timestamp(ts).cast("int"), **parts})


def at(second):
    return f"2018-04-03 {9 + second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}"


def walk(spark, *names):
    return clean_pings(spark, *[clean(at(60 * i), "a", n) for i, n in enumerate(names)], p_dt="20180403")


def test_names_that_differ_by_case_make_no_move(spark):
    assert consecutive_links(walk(spark, "Zara", "ZARA")).count() == 0


def test_case_is_folded_in_full(spark):
    assert consecutive_links(walk(spark, "ΟΔΟΣ", "οδοσ", "οδος")).count() == 0
    assert anchor_links(walk(spark, "ΟΔΟΣ", "x", "οδος")).count() == 1


def test_paths_follow_time_not_text(spark):
    """Clock texts without leading zeros sort in another order than the seconds they stand for."""
    seconds = {"A": "2018-04-03 9:50:00", "B": "2018-04-03 10:00:00", "C": "2018-04-03 10:5:00", "D": "2018-04-03 10:15:00"}
    texts = [message(clock, "a", x=14 * i) for i, clock in enumerate(seconds.values())]
    day = parse_pings(lines(spark, *texts)).withColumns(
        {"name": F.element_at(F.array(*map(F.lit, seconds)), F.col("posX") + 1), "p_dt": F.lit("20180403")}
    )
    moves = [("A", "B"), ("B", "C"), ("C", "D")]
    assert as_sets(consecutive_links(day), "from_name", "to_name") == moves
    assert as_sets(anchor_links(day), "from_name", "to_name") == [("A", "B"), ("A", "C"), ("A", "D")]


def test_consecutive_and_anchor_rules(spark):
    day = walk(spark, "A", "A", "B", None, "A")
    assert as_sets(consecutive_links(day), "from_name", "to_name") == [("A", "B"), ("B", "A")]
    assert as_sets(anchor_links(day), "from_name", "to_name") == [("A", "B")]


def test_random_paths_match_brute_force(spark):
    rng = random.Random(7)
    rows = [
        (
            f"2018040{rng.randint(3, 4)}",
            rng.choice(["a", "b", "c", "d", None]),
            at(rng.randrange(0, 13 * 3600, 900)),
            rng.choice(["A", "a", "B", "C", "走道", None]),
        )
        for _ in range(900)
    ]
    assert as_sets(consecutive_links(frame(spark, rows)), *COLUMNS) == brute_consecutive(rows)
    assert as_sets(anchor_links(frame(spark, rows)), *COLUMNS) == brute_anchor(rows)


def test_hot_device_matches_brute_force(spark):
    """One device holds most rows, many of them in the same second."""
    rng = random.Random(11)
    rows = [("20180403", "hot", at(rng.randrange(0, 7200, 40)), rng.choice("ABCDE")) for _ in range(20_000)]
    rows += [("20180403", f"m{i % 300}", at(rng.randrange(0, 40_000)), rng.choice("ABCDE")) for i in range(3_000)]
    day = frame(spark, rows).repartition(16)
    assert as_sets(consecutive_links(day), *COLUMNS) == brute_consecutive(rows)
    assert as_sets(anchor_links(day), *COLUMNS) == brute_anchor(rows)


def test_repeats_are_folded_before_the_shuffle_and_the_walk_is_shared(spark):
    rows = [("20180403", "hot", at(0), "A")] * 5_000 + [("20180403", "hot", at(5), "B")] * 5_000
    links = consecutive_links(frame(spark, rows))
    assert links.count() == 1
    links.collect()
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_stored_steps_give_the_same_moves(spark):
    rng = random.Random(3)
    rows = [("20180403", rng.choice("abc"), at(rng.randrange(0, 40_000, 300)), rng.choice("ABC")) for _ in range(400)]
    steps = hour_steps(frame(spark, rows))
    moves = hour_links(steps).drop("part").unionByName(edge_links(edges(steps)))
    assert as_sets(moves, *COLUMNS) == brute_consecutive(rows)
    # Counts of parts put together are those of the whole.
    parts = pair_counts(hour_links(steps), "part").drop("part").unionByName(pair_counts(edge_links(steps)))
    assert as_sets(link_matrix(parts), "from_name", "to_name", "times", "total") == as_sets(
        link_matrix(moves), "from_name", "to_name", "times", "total"
    )


def test_matrix(spark):
    day = walk(spark, "A", "B", "A", "B", "A", "C")
    got = as_sets(link_matrix(consecutive_links(day)), "from_name", "to_name", "times", "total")
    assert got == [("A", "B", 2, 3), ("A", "C", 1, 3), ("B", "A", 2, 2)]


def test_links_have_the_declared_columns(spark):
    from mallflow.schema import LINK

    got = consecutive_links(walk(spark, "A", "B")).drop("p_dt").schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in LINK]


def test_anchor_keeps_every_repeat_of_a_hot_second(spark):
    repeated = frame(spark, [("20180403", "hot", at(5), "B")]).crossJoin(spark.range(25_003)).drop("id")
    got = anchor_links(repeated.unionByName(frame(spark, [("20180403", "hot", at(0), "A")])))
    assert got.groupBy("from_name", "to_name").count().collect() == [("A", "B", 25_003)]
