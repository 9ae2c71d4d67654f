import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from mallflow.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def session():
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("mallflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def spark(session):
    configure(session)
    session.conf.set("spark.sql.shuffle.partitions", "8")
    session.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    return session
