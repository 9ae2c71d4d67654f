"""The queries that SQL can express against their SQL, and what the entry registers."""

import pytest

import oracle_check
from __spark_entry__ import oracle_sql, queries
from mallflow.llm.queries import oracle_sql as llm_sql
from mallflow.llm.queries import registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(llm_sql()))
def test_query_matches_sql(spark, name):
    names, want = oracle_check.oracle_rows(oracle_check.connect(SF_DIR), llm_sql()[name])
    frame = registry()[name](spark, SF_DIR)
    assert names == sorted(frame.columns)
    got = oracle_check.spark_rows(frame)
    assert want and got == want


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in registry()}
    assert set(registry()) | {"pipeline"} <= set(queries())
    assert set(llm_sql()) <= set(oracle_sql())
