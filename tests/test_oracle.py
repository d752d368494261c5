"""The queries of the catalogue against their SQL in DuckDB, on the smallest tables."""

import pytest
from compare import duck, rows_of_duck, rows_of_spark
from conftest import SF

import __spark_entry__ as driver
from suretygraph.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    found, columns = rows_of_spark(driver.queries()[name](spark, SF))
    wanted, names = rows_of_duck(connection, driver.oracle_sql()[name])
    assert columns == names
    assert found == wanted


def test_entry(spark):
    frame = driver.entry(spark)
    assert frame.count() == 237
    assert frame.columns == [
        "transaction_day", "total_transactions", "total_guarantee_amount", "avg_transaction_amount", "high_risk_transactions"
    ]


def test_staging_follows_the_cluster(spark):
    from types import SimpleNamespace

    from suretygraph import storage

    def session(**settings):
        # These settings belong to the cluster and can't be changed in a running session.
        conf = {"spark.master": "yarn", "spark.sql.warehouse.dir": "file:/w"} | {k.replace("_", "."): v for k, v in settings.items()}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, *d: conf.get(k, *d)), _jvm=spark._jvm, _jsc=spark._jsc)

    assert storage.shared_root(session(spark_checkpoint_dir="hdfs://shared/checkpoints/")) == "hdfs://shared/checkpoints"
    with pytest.raises(ValueError):
        storage.shared_root(session())
    assert storage.shared_root(session(spark_master="local[2]")) == "file:/w"
    first, second = storage.staging_folder(spark), storage.staging_folder(spark)
    assert first != second and storage.file_names(spark, first) == set()
