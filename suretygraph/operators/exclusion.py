"""Promotional accounts and their exclusion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suretygraph.constants import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, FREE_BENEFITS
from suretygraph.operators.skew import split_key


def promotional_ids(free_accounts: DataFrame, *, benefits=FREE_BENEFITS) -> DataFrame:
    return free_accounts.filter(F.col("benefit_type").isin(*benefits)).select("account_id")


def qualifying_free_accounts(free_accounts: DataFrame, *, benefits=FREE_BENEFITS) -> DataFrame:
    """Distinct ids of the accounts with a benefit that takes them out of the risk analysis."""
    return promotional_ids(free_accounts, benefits=benefits).distinct()


def exclusion_list(
    free_accounts: DataFrame,
    *,
    benefits=FREE_BENEFITS,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Promotional ids, ready for the anti joins. Runs one small job that counts them.

    Within both limits the ids are broadcast as they are: an anti join takes repeated keys, so there
    is no shuffle at all. Beyond them the joins are sort-merge, on distinct ids; there Spark can split
    an account that holds a large part of the transactions, as the list has one row for it.
    """
    ids = promotional_ids(free_accounts, benefits=benefits)
    size = ids.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("account_id")), F.lit(0)).alias("bytes")
    ).first()
    if size["n"] <= max_rows and size["bytes"] <= max_bytes:
        return F.broadcast(ids)
    return ids.select("account_id", split_key("account_id")).distinct().select("account_id").hint("merge")


def without_accounts(transactions: DataFrame, column: str, excluded: DataFrame) -> DataFrame:
    """Rows whose ``column`` is not in the list; a null is kept."""
    return transactions.join(excluded, F.col(column) == F.col("account_id"), "left_anti")


def exclude_free_source(transactions: DataFrame, excluded: DataFrame) -> DataFrame:
    return without_accounts(transactions, "source_account_id", excluded)


def exclude_free_accounts(transactions: DataFrame, excluded: DataFrame) -> DataFrame:
    """Drops a transaction when either end is on the list made by ``exclusion_list``."""
    return without_accounts(exclude_free_source(transactions, excluded), "target_account_id", excluded)
