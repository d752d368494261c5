"""One account holds a large part of all rows: the joins are split over tasks, and results stay whole."""

import re
from contextlib import contextmanager

import pytest
from conftest import SF
from pyspark.sql import functions as F

from suretygraph import schemas
from suretygraph.operators import exclusion, quality, rings
from suretygraph.sources import tables

SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40KB",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def hub_edges(spark, tmp_path_factory):
    """A third of the edges leave the hub, a sixth reach it."""
    path = str(tmp_path_factory.mktemp("hub") / "edges")
    number = F.col("id")
    other = lambda seed: F.concat(F.lit("A"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(20_000)))
    spark.range(200_000).select(
        F.when(number % 3 == 0, "HUB").otherwise(other(1)).alias("source_account_id"),
        F.when(number % 6 == 1, "HUB").otherwise(other(2)).alias("target_account_id"),
        F.lit(1).cast(schemas.MONEY).alias("guarantee_amount_usd"),
        F.lit("2026-05-01").cast("date").alias("transaction_day"),
    ).repartition(8).write.parquet(path)
    return spark.read.schema(schemas.GRAPH_EDGES).parquet(path)


def test_a_hub_is_split_in_the_ring_joins(spark, hub_edges):
    plain = rings.cycle_count(hub_edges, mode="temporal").first()
    with settings(spark, SPLIT):
        split = rings.cycle_count(hub_edges, mode="temporal")
        assert split.collect() == [plain]
        plan = final_plan(split)
    assert len(re.findall(r"SortMergeJoin\(skew=true\)", plan)) >= 2
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("mode", rings.MODES)
def test_the_edges_are_read_once(hub_edges, mode):
    """By the aggregate that is written when the query is built: no plan of the rings reads them, reused or not."""
    edge_files = set(hub_edges.inputFiles())
    for query in (rings.cycle_count(hub_edges, mode=mode, min_len=1), rings.cycle_paths(hub_edges, mode=mode), rings.cycle_amounts_by_day(hub_edges, mode=mode)):
        assert query.inputFiles() and not edge_files & set(query.inputFiles())


def test_a_hot_account_is_split_in_the_fallback_exclusion(spark):
    rows = spark.range(300_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("A"), F.col("id"))).alias("source_account_id"),
        F.concat(F.lit("A"), F.col("id") + 7).alias("target_account_id"),
    )
    accounts = spark.range(40_000).select(
        F.concat(F.lit("A"), F.col("id") * 5).alias("account_id"), F.lit("WELCOME_OFFER").alias("benefit_type")
    )
    number = F.col("id")
    listed = lambda value: (value % 5 == 0) & (value < 200_000)
    wanted = spark.range(300_000).filter(~((number % 3 != 0) & listed(number)) & ~listed(number + 7)).count()
    assert exclusion.exclude_free_accounts(rows, exclusion.exclusion_list(accounts)).count() == wanted
    with settings(spark, SPLIT):
        merged = exclusion.exclude_free_accounts(rows, exclusion.exclusion_list(accounts, max_rows=10))
        last = merged.agg(F.count("*").alias("n"), F.max("transaction_id").alias("m"))
        assert last.collect()[0].n == wanted
        assert "SortMergeJoin(skew=true)" in final_plan(last)


def test_only_needed_columns_are_read(spark):
    day = tables.transactions(spark, SF).transform(quality.transaction_day).groupBy("transaction_day").count()
    plan = day._jdf.queryExecution().executedPlan().toString()
    lineitem = next(line for line in plan.split("\n") if "lineitem.parquet" in line)
    assert "ReadSchema: struct<l_orderkey:bigint>" in lineitem
