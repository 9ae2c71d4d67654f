from pyspark.sql import functions as F

from mallflow.operators.clean import clean_batch, enrich_shop, exclude_blacklist, trailing, wash_day
from mallflow.operators.lookup import load_dimensions
from mallflow.operators.flow import mac_dwell
from mallflow.schema import CLEAN_PING
from rows import as_sets, dims, ping, pings

SHOPS = [(0, 0, "F1", "Zara", "Fashion"), (1, 0, "F1", "走道", None), (2, 0, "F1", "Bar", "Food"), (2, 0, "F1", "Cafe", "Food")]


def test_left_join_keeps_unmapped_and_multiplies_duplicates(spark):
    got = enrich_shop(pings(spark, ping(x=0), ping(x=2), ping(x=9), ping(x=0, floor="F2")), dims(spark, SHOPS).shops)
    assert got.schema.names == CLEAN_PING.names
    assert as_sets(got.fillna("-", ["name"]), "locName", "posX", "name") == [
        ("F1", 0, "Zara"),
        ("F1", 2, "Bar"),
        ("F1", 2, "Cafe"),
        ("F1", 9, "-"),
        ("F2", 0, "-"),
    ]


def test_blacklist_keeps_null_macs(spark):
    got = exclude_blacklist(
        pings(spark, ping(mac=None), ping(mac="a"), ping(mac="b")), dims(spark, blacklist=["a", None]).blacklist
    )
    assert {r["mac"] for r in got.collect()} == {None, "b"}


def test_hours_limit_the_day_only(spark):
    day = pings(spark, *[ping(f"2018-04-03 {h:02d}:59:59") for h in (8, 9, 22, 23)])
    tables = dims(spark, SHOPS)
    assert {r["dt_hour"] for r in wash_day(day, tables).collect()} == {9, 22}
    assert clean_batch(day, tables).count() == 4


def test_trailing_window_is_half_open(spark):
    day = pings(spark, *[ping(f"2018-04-03 14:{m}") for m in ("50:00", "50:01", "59:59")], ping("2018-04-03 15:00:00"))
    as_of = ping("2018-04-03 15:00:00")["time_stamp"]
    assert as_sets(trailing(day, as_of, 600), "date_time") == [
        ("2018-04-03 14:50:01",),
        ("2018-04-03 14:59:59",),
        ("2018-04-03 15:00:00",),
    ]


def test_large_lookups_are_joined_by_shuffle_with_equal_rows(spark):
    day = pings(spark, *[ping(mac=f"m{i % 7}", x=i % 3) for i in range(50)])
    small = clean_batch(day, dims(spark, SHOPS, ["m3"]))
    large = clean_batch(day, dims(spark, SHOPS, ["m3"], broadcast_bytes=0))
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert "BroadcastHashJoin" in small._jdf.queryExecution().optimizedPlan().toString() or "broadcast" in (
        small._jdf.queryExecution().optimizedPlan().toString()
    )
    assert "strategy=broadcast" not in large._jdf.queryExecution().optimizedPlan().toString()


def test_hot_cell_and_device_are_split_in_shuffle_joins(spark):
    """A third of all rows on one cell and one device: the join's skewed partition is split, the result is whole."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40000",
    }
    rows = spark.range(0, 60_000, 1, 16)
    hot = F.col("id") % 3 == 0
    base = {name: F.lit(v) for name, v in ping().items()}
    base |= {
        "mac": F.when(hot, "hot").otherwise(F.concat(F.lit("m"), F.col("id"))),
        "ipAddr": F.sha2(F.col("id").cast("string"), 256),
        "posX": F.when(hot, 0).otherwise((F.col("id") % 40).cast("int")),
        "time_stamp": F.col("id").cast("int"),
    }
    day = rows.select(*[c.alias(n) for n, c in base.items()])
    shops = [(x, 0, "F1", f"s{x}", "t") for x in range(40)]
    blacklist = [f"m{i}" for i in range(1, 60_000, 100)]
    try:
        for key, setting in settings.items():
            spark.conf.set(key, setting)
        tables = dims(spark, shops, blacklist, broadcast_bytes=0)
        kept = exclude_blacklist(day, tables.blacklist)
        dwell = mac_dwell(kept).join(kept.groupBy("mac").agg(F.max("ipAddr").alias("ip")), "mac")
        counted = dwell.collect()
        plan = dwell._jdf.queryExecution().executedPlan().toString()
        seen = enrich_shop(day, tables.shops).groupBy("name").agg(F.count("*").alias("n"), F.max("ipAddr").alias("ip"))
        names = {r["name"]: r["n"] for r in seen.collect()}
        shop_plan = seen._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    listed = {m for m in blacklist if int(m[1:]) % 3 != 0}
    assert len(counted) == 40_000 - len(listed) + 1
    assert {r["mac"]: r["stay"] for r in counted}["hot"] == 59_997
    assert sum(names.values()) == 60_000 and names["s0"] >= 20_000
    assert "skew=true" in plan and "skew=true" in shop_plan


def test_version_follows_the_rows(spark):
    one = dims(spark, SHOPS, ["a"])
    assert one.version == dims(spark, SHOPS[::-1], ["a"]).version
    assert one.version != dims(spark, SHOPS, ["b"]).version
    assert one.version != dims(spark, SHOPS[:2], ["a"]).version
    assert load_dimensions(one.shops.limit(0), one.blacklist.limit(0)).version.startswith("blacklist:0")


def test_version_tells_a_value_in_one_column_from_the_next(spark):
    """A null next to a value must not hash like the value next to a null."""
    one = dims(spark, [(0, 0, "F1", "x", None)]).version
    other = dims(spark, [(0, 0, "F1", None, "x")]).version
    assert one != other
