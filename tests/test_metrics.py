from mallflow.operators import floors, flow, shops
from mallflow.operators.visits import visit_summary
from mallflow.plans import documents
from rows import as_sets, clean, clean_pings


def at(hour, minute=0, second=0):
    return f"2018-04-03 {hour:02d}:{minute:02d}:{second:02d}"


def test_null_devices_are_not_counted_but_their_span_is(spark):
    day = clean_pings(
        spark, clean(at(10), "a"), clean(at(10, 1), "a"), clean(at(10), None), clean(at(11), None), clean(at(12), "b")
    )
    assert flow.minute_flow(day).where("dt_hour = 10 and dt_min = 0").first()[2:] == (1, 1)
    assert as_sets(flow.mac_dwell(day).fillna("-"), "mac", "stay") == [("-", 3600), ("a", 60), ("b", 0)]
    assert flow.dwell_totals(day).first()[:] == (2, 3660)
    # 3660 div 2 = 1830 seconds
    assert flow.today_total(day).first()[:] == (2, 30.5)
    assert floors.floor_dwell(day).first()[:] == ("F1", 2, 30.5)


def test_whole_seconds_come_before_minutes_in_the_day_total(spark):
    day = clean_pings(spark, clean(at(10), "a"), clean(at(10, 0, 5), "a"), clean(at(10), "b"))
    assert flow.today_total(day).first()["all_stay"] == 2 / 60.0
    assert flow.today_flow(day, day).first()["stay_min"] == 2.5 / 60.0


def test_empty_day_gives_null_means(spark):
    rt, none = clean_pings(spark, clean(at(8), "a")), clean_pings(spark)
    assert flow.today_flow(rt, none).first()[:] == (8, 0, 1, 1, None)
    assert flow.today_total(none).first()[:] == (0, None)
    only_null = clean_pings(spark, clean(at(10), None))
    assert flow.today_total(only_null).first()[:] == (0, None)
    assert floors.floor_dwell(only_null).first()[:] == ("F1", 0, None)


def test_batch_counts_of_empty_batch(spark):
    none = clean_pings(spark)
    assert flow.batch_counts(none, none).first()[:] == (0, 0)


def test_rankings_break_ties_by_label_and_leave_walkways_out(spark):
    names = [f"s{i:02d}" for i in range(12)]
    rows = [clean(at(10), f"m{i}", name=n, type=None) for i, n in enumerate(reversed(names))]
    rows += [clean(at(10), "w", name="走道"), clean(at(10), "w", name="过道"), clean(at(10), "w", name=None, type=None)]
    day = clean_pings(spark, *rows)
    assert [r["shop"] for r in shops.rt_top_shops(day).collect()] == names[:10]
    assert [r["shop"] for r in shops.day_shop_rank(day).collect()] == [*names, "过道"]
    ranked = floors.floor_shop_rank(day).orderBy("rank").collect()
    assert [(r["name"], r["rank"]) for r in ranked] == [("s00", 1), ("s01", 2), ("s02", 3)]


def test_categories(spark):
    day = clean_pings(
        spark,
        clean(at(10), "a", type="Food"),
        clean(at(10), "a", type="Food"),
        clean(at(10), "b", type="Food"),
        clean(at(10), "a", type=None),
        clean(at(10), "a", type="走道"),
        clean(at(10), "a", type="走道"),
        clean(at(10), "c", name=None, type="Lost"),
        clean(at(10), "c", name="走道", type="Way"),
    )
    assert [r[:] for r in shops.day_top_category(day).collect()] == [("Food", 2), ("走道", 1)]
    # A real walkway category and the missing category stay two rows.
    assert [r[:] for r in shops.rt_top_category(day).collect()] == [("Food", 3), ("走道", 2), ("走道", 1)]


def test_floor_flow_needs_a_ranked_floor(spark):
    day = clean_pings(
        spark,
        clean(at(10), "a", floor="F1"),
        clean(at(10), "b", floor="F1", name="Bar"),
        clean(at(10, 2), "b", floor="F1", name="Bar"),
        clean(at(10), "c", floor="F2", name="走道"),
        clean(at(10), "d", floor=None),
    )
    got = [r[:] for r in floors.rt_floor_flow(day, day).collect()]
    assert got == [("F1", 2, 1.0, "Zara", 1), ("F1", 2, 1.0, "Bar", 1)]


def test_floor_minutes_count_whole_distinct_records(spark):
    day = clean_pings(
        spark,
        clean(at(10), "a"),
        clean(at(10), "a"),
        clean(at(10), "a", ipAddr="other"),
        clean(at(10), "b", type=None),
        clean(at(10, 1), "b", name=None, type=None),
        clean(at(10, 1), None),
    )
    assert as_sets(floors.floor_minute_flow(day), "locName", "dt_hour", "dt_min", "cnt") == [
        ("F1", 10, 0, 2),
        ("F1", 10, 1, 0),
    ]


def test_heat_map_needs_more_than_five(spark):
    rows = [clean(at(10), f"m{i}", x=1) for i in range(5)] * 2 + [clean(at(10), f"m{i}", x=2) for i in range(6)]
    assert as_sets(floors.heat_map(clean_pings(spark, *rows)), "floor", "x", "y", "cnt") == [("F1", 2, 0, 6)]


def test_visits_answer_the_day_metrics_and_merge(spark):
    rows = [
        clean(
            at(9 + i % 13, i * 7 % 60, i * 11 % 60),
            None if i % 17 == 0 else f"m{i % 9}",
            name=[None, "A", "B", "走道", "过道", "C"][i % 6],
            type=[None, "t1", "t2"][i % 3],
            floor=f"F{i % 2}",
            x=i % 3,
        )
        for i in range(300)
    ]
    day = clean_pings(spark, *rows)
    halves = visit_summary(clean_pings(spark, *rows[:140])).unionByName(visit_summary(clean_pings(spark, *rows[140:])))
    merged = visit_summary(halves)
    assert sorted(map(str, merged.collect())) == sorted(map(str, visit_summary(day).collect()))
    for metric in (
        flow.mac_dwell,
        flow.today_total,
        shops.day_shop_rank,
        shops.day_top_category,
        floors.floor_dwell,
        floors.floor_shop_rank,
        floors.heat_map,
    ):
        want = sorted(map(str, metric(day).collect()))
        assert want == sorted(map(str, metric(halves).collect())) == sorted(map(str, metric(merged).collect()))


def test_documents(spark):
    day = clean_pings(spark, *[clean(at(9, 5), f"m{i}") for i in range(6)])
    state = documents.snapshot(day, day)
    as_of = "2018-04-03 09:06:00"

    def docs(name):
        return [r.asDict() for r in documents.product_documents(name, state, as_of).collect()]

    stamp = {"mall_id": "sh001", "p_dt": "20180403", "dt_year": "2018", "dt_month": "04", "dt_day": "03"}
    assert docs("today_flow") == [
        {**stamp, "dt_hour": "09", "dt_min": "06", "bi_name": "today_flow", "bi_value": {"count": "6", "staty": "0.0"}}
    ]
    assert docs("floor_day_flow") == [
        {**stamp, "dt_hour": "9", "dt_min": "5", "bi_name": "floor_day_flow", "bi_value": {"floor": "F1", "count": "6"}}
    ]
    assert docs("heat_map")[0]["bi_value"] == {"floor": "F1", "x": "0", "y": "0", "count": "6"}
    assert docs("day_catalog")[0]["bi_value"] == {"catalog": "Fashion", "total": "6"}
    assert docs("rt_max_shop")[0]["bi_value"] == docs("day_max_shop")[0]["bi_value"] == {"shop": "Zara", "flow": "6"}
    assert docs("today_total")[0]["bi_value"] == {"all_customer": "6", "all_stay": "0.0"}
    assert docs("rt_floor_flow")[0]["bi_value"] == {"floor": "F1", "uv": "6", "stay": "0.0", "shop": "Zara", "flow": "6"}


def test_brand_link_documents(spark):
    from mallflow.operators.links import consecutive_links

    day = clean_pings(spark, clean(at(9), "a", "A"), clean(at(10), "a", "B"), clean(at(11), "a", "C"), p_dt="20180403")
    docs = documents.brand_link_documents(consecutive_links(day), "2018-04-03 12:00:00").collect()
    keys = ("from_name", "to_name", "times", "total")
    assert sorted(tuple(d["bi_value"][k] for k in keys) for d in docs) == [("A", "B", "1", "1"), ("B", "C", "1", "1")]


def test_floor_summary_is_dwell_and_rank(spark):
    rows = [
        clean(
            at(9 + i % 13, i * 7 % 60, i * 11 % 60),
            None if i % 17 == 0 else f"m{i % 9}",
            name=[None, "A", "B", "走道", "过道", "C", "D"][i * i % 7],
            floor=None if i % 19 == 0 else f"F{i % 3}",
        )
        for i in range(300)
    ] + [clean(at(9), "m1", name="走道", floor="F9"), clean(at(9), None, name="A", floor="F8")]
    day = clean_pings(spark, *rows)
    want = floors.floor_dwell(day).drop("total_mac").join(floors.floor_shop_rank(day), "locName")
    for visits in (day, visit_summary(day), visit_summary(day, "dt_hour")):
        got = floors.floor_summary(visits).where("locName is not null")
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
