"""What a batch holds in memory, and how its work is dealt over the cores."""

from pyspark.sql import functions as F

from mallflow.operators import flow, shops
from mallflow.operators.lookup import load_dimensions
from mallflow.plans.warehouse import Warehouse
from mallflow.schema import BLACKLIST, CLEAN_PING, SHOP
from mallflow.session import held
from mallflow.streaming.job import MallJob, Run
from mallflow.streaming.landing import Messages


def test_held_is_worked_out_before_it_is_used(spark):
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    with held(spark.range(100).select((F.col("id") * 2).alias("twice"))) as kept:
        assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == before + 1
        assert kept.agg(F.sum("twice")).first()[0] == 9900
    assert not kept.storageLevel.useMemory


def test_a_batch_is_written_by_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(1000).repartition(4 * cores)
    files = {size: Messages(rows, size << 20).in_files(rows).rdd.getNumPartitions() for size in (0, 15, 48, 16 * cores, 256 * cores)}
    assert files == {0: 1, 15: 1, 48: 3, 16 * cores: cores, 256 * cores: 2 * cores}


def test_the_days_visits_are_dealt_by_device(spark, tmp_path):
    """Distinct devices and dwell of the day are worked out where the visits are: no row per device is shuffled again."""
    house = Warehouse(spark, str(tmp_path))
    pings = [("sh001", "2024-01-15 10:00:00", 2024, 1, 15, 10, 0, n, n, f"m{n % 7}", "", "L1", "F1", n % 3, 0, f"shop{n % 5}", None) for n in range(60)]
    clean = spark.createDataFrame(pings, CLEAN_PING)
    house.refresh(clean, "20240115", 0)
    dims = load_dimensions(spark.createDataFrame([], SHOP), spark.createDataFrame([], BLACKLIST))
    run = Run("2024-01-15 10:01:00", "", [], True, False, 0, [], 0)
    with MallJob(house, lambda: dims)._snapshot(clean, run) as state:
        found = shops.shop_flow(state.day)
        plan = found._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0]
        assert plan.count("Exchange hashpartitioning") == 1
        assert {row["shop"]: row["flow"] for row in found.collect()} == {f"shop{n}": 7 for n in range(5)}
        assert flow.dwell_totals(state.day).first()["total_mac"] == 7
