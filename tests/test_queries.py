"""Every registered query against its SQL on the smallest provided tables."""

import pytest

import oracle_check
from __spark_entry__ import entry
from __spark_entry__ import queries as every_query
from mallflow.plans.oracle import oracle_sql
from mallflow.plans.queries import registry as queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(every_query())


def test_entry(spark):
    assert entry(spark).columns == ["floor", "uv", "stay", "shop", "flow"]
    assert entry(spark).count() == 12


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, con, name):
    frame = queries()[name](spark, SF_DIR)
    names, want = oracle_check.oracle_rows(con, oracle_sql()[name])
    assert names == sorted(frame.columns)
    got = oracle_check.spark_rows(frame)
    assert want and got == want


@pytest.mark.parametrize("partitions", ["1", "4", "16"])
@pytest.mark.parametrize("name", ["brand_link_consecutive", "brand_link_anchor", "floor_shop_rank", "floor_minute_flow"])
def test_partition_count_changes_nothing(spark, con, name, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    _, want = oracle_check.oracle_rows(con, oracle_sql()[name])
    assert oracle_check.spark_rows(queries()[name](spark, SF_DIR)) == want
