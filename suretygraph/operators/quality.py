"""Event day, incremental window, deduplication and validation of transactions."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from suretygraph.constants import APPROVED_STATUS, VALID_COUNTRIES, WINDOW_DAYS

# Which of several rows with one id is kept: the first in this order, nulls last.
KEEP_ORDER = (
    "timestamp",
    "guarantee_amount_usd",
    "fee_amount_usd",
    "source_account_id",
    "target_account_id",
    "status",
    "country_code",
)


def transaction_day(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn("transaction_day", F.to_date("timestamp"))


def window_bounds(process_date, days: int = WINDOW_DAYS) -> tuple[date, date]:
    """First and last day of the window that ends on ``process_date`` (a date or ``YYYY-MM-DD``)."""
    if isinstance(process_date, datetime):
        last = process_date.date()
    else:
        last = process_date if isinstance(process_date, date) else date.fromisoformat(process_date)
    return last - timedelta(days=days - 1), last


def incremental_window(transactions: DataFrame, process_date, *, days: int = WINDOW_DAYS) -> DataFrame:
    first, last = window_bounds(process_date, days)
    return transactions.filter(F.col("transaction_day").between(F.lit(first), F.lit(last)))


def dedup_transactions(transactions: DataFrame) -> DataFrame:
    """One row per transaction id, rows without an id dropped.

    ``row_number() = 1`` also limits each map task to one row per id, so an id that is repeated
    through the whole table is cut before the shuffle. Both sorts have a hash of the id before the id: ids that begin
    alike, as numbered ones do, are then told apart by a number instead of text.
    """
    order = Window.partitionBy("_hash", "transaction_id").orderBy(*[F.asc_nulls_last(c) for c in KEEP_ORDER])
    return (
        transactions.filter(F.col("transaction_id").isNotNull())
        .withColumn("_hash", F.xxhash64("transaction_id"))
        .withColumn("_row", F.row_number().over(order))
        .filter(F.col("_row") == 1)
        .drop("_hash", "_row")
    )


def valid_rows(transactions: DataFrame, *, countries=VALID_COUNTRIES) -> DataFrame:
    """Rows with a positive amount, a fee of at least 0 and a known country; a null fails."""
    return transactions.filter(
        (F.col("guarantee_amount_usd") > 0)
        & (F.col("fee_amount_usd") >= 0)
        & F.col("country_code").isin(*countries)
    )


def failures(*, countries=VALID_COUNTRIES) -> dict[str, Column]:
    """For each rule of ``valid_rows`` whether a row fails it."""
    passes = {
        "bad_amount": F.col("guarantee_amount_usd") > 0,
        "bad_fee": F.col("fee_amount_usd") >= 0,
        "bad_country": F.col("country_code").isin(*countries),
    }
    return {name: ~F.coalesce(rule, F.lit(False)) for name, rule in passes.items()}


def validate_data_quality(transactions: DataFrame, *, countries=VALID_COUNTRIES) -> DataFrame:
    """Deduplicated rows with a positive amount, a fee of at least 0 and a known country.

    The values are checked after the deduplication: an id whose kept row is invalid goes altogether.
    """
    return valid_rows(dedup_transactions(transactions), countries=countries)


def approved_transactions(transactions: DataFrame, *, status: str = APPROVED_STATUS) -> DataFrame:
    return transactions.filter(F.col("status") == status)
