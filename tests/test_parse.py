from pyspark.sql import functions as F

from mallflow.functions import cell, clock, date_keys, date_part, date_path, epoch_seconds
from mallflow.operators.parse import dead_letters, parse_pings
from mallflow.schema import PING
from rows import lines, message, pings, ping


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_good_line_becomes_ping(spark):
    got = parse_pings(lines(spark, message("2018-04-03 09:05:07", "m9", "F2", 27, -1)))
    assert got.schema.names == PING.names
    assert [f.dataType for f in got.schema] == [f.dataType for f in PING]
    assert got.collect() == pings(spark, ping("2018-04-03 09:05:07", "m9", "F2", 2, -1)).collect()


def test_bad_lines_go_to_dead_letters(spark):
    bad = [
        "sh001,2018-04-03 10:00:00,m1,ip,L1,F1,5",
        "sh001,2018-04-03 10:00:00,m1,ip,L1,F1,abc,5",
        "sh001,2018-04-03 10:00:00,m1,ip,L1,F1,5,",
        "sh001,2018-04-03 10:00:00,m1,ip,L1,F1,1.5,5",
        "sh001,2018-04-03 10:00:00,m1,ip,L1,F1,99999999999,5",
        "sh001,2018-02-30 10:00:00,m1,ip,L1,F1,5,5",
        "sh001,2018-04-03,m1,ip,L1,F1,5,5",
        "sh001,2018-04-03 10:00:00.5,m1,ip,L1,F1,5,5",
        "sh001,2018-04-03T10:00:00,m1,ip,L1,F1,5,5",
        "",
        None,
    ]
    frame = lines(spark, *bad, message())
    assert parse_pings(frame).count() == 1
    left = [r["value"] for r in dead_letters(frame).collect()]
    assert len(left) == len(bad) and set(left) == set(bad)


def test_extra_fields_and_blanks_are_accepted(spark):
    got = parse_pings(lines(spark, "sh001,2018-4-3 9:5:7,m1,ip,L1,F1, 27 ,14\r,more,fields")).first()
    assert (got["posX"], got["posY"], got["dt_hour"], got["dt_min"], got["dt_sec"]) == (2, 1, 9, 5, 7)


def test_grid_rounds_towards_minus_infinity(spark):
    frame = spark.createDataFrame([("-1",), ("0",), ("13",), ("14",), ("131",), (" 27 ",), ("x",), (None,)], "raw string")
    assert [r["c"] for r in frame.select(cell(F.col("raw")).alias("c")).collect()] == [-1, 0, 0, 1, 10, 2, None, None]


def test_date_parts_of_text(spark):
    full, short = F.lit("2018-04-03 09:05:07"), F.lit("20180403")
    parts = ["year", "month", "day", "hour", "minute", "second"]
    assert [value(spark, date_part(full, p)) for p in parts] == [2018, 4, 3, 9, 5, 7]
    assert [value(spark, date_part(short, p)) for p in parts] == [0] * 6
    assert value(spark, epoch_seconds(clock(full))) == 1522746307
    assert value(spark, clock(F.lit("2018-13-03 09:05:07"))) is None


def test_epoch_follows_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert value(spark, epoch_seconds(clock(F.lit("2018-04-03 09:05:07")))) == 1522746307 - 8 * 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_date_keys_are_padded(spark):
    ts = F.to_timestamp(F.lit("2018-04-03 09:05:07"))
    got = {name: value(spark, c) for name, c in date_keys(ts).items()}
    assert got == {
        "year": "2018",
        "month": "04",
        "day": "03",
        "hour": "09",
        "minute": "05",
        "second": "07",
        "year_month": "201804",
        "date": "20180403",
    }
    assert value(spark, date_path(ts)) == "2018/201804/20180403"
