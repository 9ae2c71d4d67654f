"""What the physical plans of the registered queries must and must not hold."""

import pytest

from mallflow.plans.queries import registry as queries

SF_DIR = "/root/testdata/sf0.001"


def plan(spark, name):
    frame = queries()[name](spark, SF_DIR)
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in queries() if not n.startswith("stream_")))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    for word in ("CartesianProduct", "NestedLoopJoin", "Python", "MapInPandas", "SinglePartition, REPARTITION"):
        assert word not in text


@pytest.mark.parametrize(
    "name, columns",
    [
        ("mac_dwell", "struct<ts:timestamp_ntz,user_id:bigint>"),
        ("today_total", "struct<ts:timestamp_ntz,user_id:bigint>"),
        ("grid_snap", "struct<event_id:bigint,user_id:bigint,value:double>"),
    ],
)
def test_scans_read_only_needed_columns(spark, name, columns):
    assert f"ReadSchema: {columns}" in plan(spark, name)


@pytest.mark.parametrize("name", ["rt_top_shops", "day_top_category", "rt_top_category"])
def test_top_n_is_taken_per_task(spark, name):
    assert "TakeOrderedAndProject(limit=10" in plan(spark, name)


def test_floor_ranking_is_cut_before_the_shuffle(spark):
    text = plan(spark, "floor_shop_rank")
    assert "row_number(), 3, Partial" in text and "row_number(), 3, Final" in text


def test_blacklist_is_an_anti_join(spark):
    assert "LeftAnti" in plan(spark, "exclude_blacklist")


@pytest.mark.parametrize("name", ["day_shop_rank", "floor_shop_rank", "heat_map", "floor_minute_flow", "minute_flow"])
def test_distinct_counts_are_reduced_before_the_shuffle(spark, name):
    """Group and counted columns are hashed together first, so a hot group is spread over all tasks."""
    text = plan(spark, name)
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(wide) >= 2
    below = text.split(wide[-1])[1].splitlines()[1]
    assert "HashAggregate" in below


def test_message_is_split_once(spark):
    text = plan(spark, "parse_pings")
    assert "Filter" in text
    assert "split(" not in "".join(line for line in text.splitlines() if "Filter" in line)


def test_floor_flow_reads_batch_and_day_once_each(spark):
    text = plan(spark, "rt_floor_flow")
    scans = [line for line in text.splitlines() if "FileScan parquet" in line and "user_id" in line]
    assert len(scans) == 2
    # One shuffle by device for the batch and one for the day; beyond them only rows per floor and shop.
    by_device = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "mac" in line]
    assert len(by_device) == 2
