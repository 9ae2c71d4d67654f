import pytest
from pyspark.sql import functions as F

from mallflow.__main__ import main
from mallflow.plans.warehouse import Warehouse
from mallflow.schema import BLACKLIST, SHOP
from mallflow.sources.tables import overwrite_day
from rows import as_sets, clean, clean_pings, message


def test_stream_then_backfill(spark, tmp_path):
    root, inbox = str(tmp_path / "mall"), tmp_path / "inbox"
    spark.createDataFrame([(0, 0, "F1", "A", "t"), (1, 0, "F1", "B", "t")], SHOP).write.parquet(str(tmp_path / "shops"))
    spark.createDataFrame([("bad",)], BLACKLIST).write.parquet(str(tmp_path / "blacklist"))
    inbox.mkdir()
    texts = [message(f"2018-04-03 {h:02d}:00:00", m, x=14 * (h % 2)) for h in range(9, 13) for m in ("a", "bad")]
    (inbox / "one.txt").write_text("\n".join(texts))
    files = ["--shops", str(tmp_path / "shops"), "--blacklist", str(tmp_path / "blacklist"), "--directory", str(inbox)]
    main(["stream", "--root", root, *files, "--once", "--no-links"], spark)

    house = Warehouse(spark, root)
    day = house.metrics.read().select("p_dt").distinct().first()["p_dt"]
    assert house.links(day).count() == 0
    main(["backfill", "--root", root, day], spark)
    moves = as_sets(house.links(day), "mac", "date_time", "from_name", "to_name")
    assert moves == [
        ("a", "2018-04-03 10:00:00", "B", "A"),
        ("a", "2018-04-03 11:00:00", "A", "B"),
        ("a", "2018-04-03 12:00:00", "B", "A"),
    ]
    main(["backfill", "--root", root, "--all"], spark)
    assert as_sets(house.links(day), "mac", "date_time", "from_name", "to_name") == moves
    total = house.metrics.read().where(F.col("bi_name") == "today_total").first()["bi_value"]
    assert total == {"all_customer": "1", "all_stay": "180.0"}


def test_kafka_needs_a_topic(spark):
    with pytest.raises(SystemExit):
        main(["stream", "--root", "r", "--shops", "s", "--blacklist", "b", "--kafka", "h:1"], spark)


def test_options_are_names_and_values(spark):
    with pytest.raises(SystemExit):
        main(["stream", "--root", "r", "--shops", "s", "--blacklist", "b", "--kafka", "h:1", "--topic", "t", "--option", "x"], spark)


def test_backfill_is_sized_by_its_input(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr("mallflow.__main__.size_for", lambda _, size: seen.append(size))
    day = clean_pings(spark, clean(name="A"), clean("2018-04-03 11:00:00", name="B"))
    overwrite_day(day, str(tmp_path / "dw"), "20180403")
    main(["backfill", "--root", str(tmp_path), "20180403"], spark)
    main(["backfill", "--root", str(tmp_path), "--all"], spark)
    assert seen[0] > 0 and seen[1] >= seen[0]


@pytest.mark.parametrize("days", [[], ["20180403", "--all"], ["2018-04-03"], ["20180230"], ["yesterday"]])
def test_backfill_needs_days_or_all(spark, days):
    with pytest.raises(SystemExit):
        main(["backfill", "--root", "r", *days], spark)
