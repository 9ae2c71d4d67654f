"""Compare registered queries with their SQL on the provided tables: ``python tests/oracle_check.py [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value))
    return (1, str(value))


def spark_rows(df: DataFrame) -> list[tuple]:
    names = sorted(df.columns)
    return sorted(tuple(_key(row[n]) for n in names) for row in df.collect())


def oracle_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(_key(row[i]) for i in order) for row in cursor.fetchall())


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        df = fn(spark, sf_dir)
        got = spark_rows(df)
        took = time.time() - start
        if name not in sqls:
            print(f"rows {name}: {len(got)} ({took:.2f}s)")
            continue
        names, want = oracle_rows(con, sqls[name])
        ok = names == sorted(df.columns) and got == want
        bad += not ok
        print(f"{'ok  ' if ok else 'BAD '} {name}: {len(got)} / {len(want)} ({took:.2f}s)", flush=True)
        if not ok:
            print("  columns", sorted(df.columns), names)
            print("  spark only", [r for r in got if r not in set(want)][:3])
            print("  sql only", [r for r in want if r not in set(got)][:3])
    return bad


if __name__ == "__main__":
    sys.exit(main())
