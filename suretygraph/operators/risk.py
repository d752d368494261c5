"""Risk scores, daily metrics and high-volume accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suretygraph.constants import HIGH_RISK_USD, HIGH_VOLUME_TRANSACTIONS, VERY_HIGH_RISK_USD
from suretygraph.functions import risk as score


def enrich_transactions(
    transactions: DataFrame,
    *,
    high=HIGH_RISK_USD,
    very_high=VERY_HIGH_RISK_USD,
    processed_at=None,
) -> DataFrame:
    """Adds the risk flags, the fee percentage, the category and the time of the run."""
    amount = F.col("guarantee_amount_usd")
    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp")
    return transactions.withColumns({
        "high_risk_transaction": score.exceeds(amount, high),
        "very_high_risk_transaction": score.exceeds(amount, very_high),
        "fee_percentage": score.fee_percentage(F.col("fee_amount_usd"), amount),
        "risk_category": score.risk_category(amount, high, very_high),
        "processed_at": stamp,
    })


def daily_risk_metrics(enriched: DataFrame) -> DataFrame:
    """Counts and amounts per day. Sums are exact decimals, made double at the end."""
    total = F.sum("guarantee_amount_usd").cast("double")
    return enriched.groupBy("transaction_day").agg(
        F.count("*").alias("total_transactions"),
        total.alias("total_guarantee_amount"),
        (total / F.nullif(F.count("guarantee_amount_usd"), F.lit(0))).alias("avg_transaction_amount"),
        F.count_if("high_risk_transaction").alias("high_risk_transactions"),
    )


def high_volume_accounts(enriched: DataFrame, *, min_transactions: int = HIGH_VOLUME_TRANSACTIONS) -> DataFrame:
    """Source accounts with more than ``min_transactions`` transactions."""
    return (
        enriched.groupBy("source_account_id")
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum("guarantee_amount_usd").cast("double").alias("total_amount"),
        )
        .filter(F.col("transaction_count") > min_transactions)
    )
