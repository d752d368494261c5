"""The account-to-account guarantee graph: edges, nodes and upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from suretygraph.operators.skew import split_key

PAIR = ("source_account_id", "target_account_id")


def graph_edges(transactions: DataFrame) -> DataFrame:
    return transactions.select(*PAIR, "guarantee_amount_usd", "transaction_day")


def graph_edges_export(edges: DataFrame) -> DataFrame:
    """Edges as a graph store takes them: ``src``, ``tgt``, ``amount`` as double, ``day`` as text."""
    return edges.select(
        F.col("source_account_id").alias("src"),
        F.col("target_account_id").alias("tgt"),
        F.col("guarantee_amount_usd").cast("double").alias("amount"),
        F.col("transaction_day").cast("string").alias("day"),
    )


def edge_count(edges: DataFrame) -> DataFrame:
    return edges.agg(F.count("*").alias("edge_count"))


def connected(edges: DataFrame) -> DataFrame:
    """Edges that have both ends."""
    return edges.filter(F.col("source_account_id").isNotNull() & F.col("target_account_id").isNotNull())


def graph_nodes(edges: DataFrame) -> DataFrame:
    """Every account seen at either end, once. One pass over the edges."""
    return (
        edges.select(F.explode(F.array(*PAIR)).alias("id")).filter(F.col("id").isNotNull()).distinct()
    )


def _first_per_pair(edges: DataFrame, order) -> DataFrame:
    # The row number's bound reaches the map side, so a pair with very many edges is cut before the shuffle.
    rank = F.row_number().over(Window.partitionBy(*PAIR, split_key(PAIR[0])).orderBy(*order))
    return edges.withColumn("_row", rank).filter(F.col("_row") == 1).drop("_row")


def latest_edges(edges: DataFrame) -> DataFrame:
    """One edge per ordered pair of accounts: the latest day, and of that day the largest amount."""
    order = [F.desc_nulls_last("transaction_day"), F.desc_nulls_last("guarantee_amount_usd")]
    return _first_per_pair(connected(edges), order)


def upsert_edges(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """``latest_edges`` over stored and new edges; of equal days the new edge wins."""
    columns = [*PAIR, "guarantee_amount_usd", "transaction_day"]
    merged = (
        existing.select(*columns).withColumn("_new", F.lit(0))
        .unionByName(incoming.select(*columns).withColumn("_new", F.lit(1)))
    )
    order = [
        F.desc_nulls_last("transaction_day"), F.desc("_new"), F.desc_nulls_last("guarantee_amount_usd"),
    ]
    return _first_per_pair(connected(merged), order).drop("_new")
