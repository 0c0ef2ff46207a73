import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from editpulse.schemas import BRONZE  # noqa: E402
from editpulse.session import apply_defaults  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield apply_defaults(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


GOLDEN = [
    # page, revid, user, time, size, comment, minor
    ("A", 1, "alice", "2024-01-06T10:00:00Z", 1000, "init", False),
    ("A", 2, "bob", "2024-01-06T10:00:30Z", 50, "", False),
    ("A", 3, "alice", "2024-01-06T10:00:45Z", 1000, None, True),
    ("A", 4, "bob", "2024-01-08T23:00:00Z", 300, "x" * 51, False),
    ("B", 5, "bob", "2024-01-08T23:00:20Z", 20, "typo", True),
    ("B", 6, "alice", "2024-01-08T23:30:00Z", None, "n", None),
    ("B", 7, "alice", "2024-01-09T05:00:00Z", 100, "k", False),
    ("A", 1, "alice", "2024-01-06T10:00:00Z", 1000, "init", False),
    ("A", 8, None, "2024-01-06T10:00:00Z", 1, "", False),
]


def bronze_rows(spark, rows):
    records = [
        (page, "1", 0, revid, 0, ts, user, 1, False, size, comment, minor, False, ["t"], None)
        for page, revid, user, ts, size, comment, minor in rows]
    return spark.createDataFrame(records, BRONZE)


@pytest.fixture(scope="session")
def golden(spark):
    return bronze_rows(spark, GOLDEN)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
