import os
import sys
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from suretygraph import schemas  # noqa: E402
from suretygraph.operators.quality import transaction_day  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("suretygraph-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def tx(
    id="T1", source="A", target="B", amount="100.00", fee="2.00", status="APPROVED",
    at="2026-05-01 10:00:00", country="CL",
):
    return (
        id, source, target,
        None if amount is None else Decimal(amount),
        None if fee is None else Decimal(fee),
        status,
        None if at is None else datetime.fromisoformat(at),
        country,
    )


@pytest.fixture
def transactions(spark):
    def make(*rows):
        return transaction_day(spark.createDataFrame(list(rows), schemas.TRANSACTIONS))

    return make


@pytest.fixture
def edges(spark):
    """Edges from (source, target, amount, day of May 2026)."""

    def make(*rows):
        data = [
            (s, t, Decimal(str(a)), None if d is None else datetime(2026, 5, d).date()) for s, t, a, d in rows
        ]
        return spark.createDataFrame(data, schemas.GRAPH_EDGES)

    return make


def ids(df, column="transaction_id"):
    return sorted(r[column] for r in df.select(column).collect())


def plan_of(df) -> str:
    """The physical plan as planned, whether or not it has run."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
