"""Risk scores of one transaction, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from suretygraph.constants import HIGH_RISK_USD, VERY_HIGH_RISK_USD


def exceeds(amount: Column, limit) -> Column:
    """``amount > limit``; false for a null amount."""
    return F.coalesce(amount > F.lit(limit), F.lit(False))


def fee_percentage(fee: Column, amount: Column) -> Column:
    """Fee in per cent of the amount, two decimals; null for a null or zero amount."""
    return F.round(F.try_divide(fee, amount) * 100, 2).cast("double")


def risk_category(amount: Column, high=HIGH_RISK_USD, very_high=VERY_HIGH_RISK_USD) -> Column:
    return (
        F.when(amount > F.lit(very_high), "CRITICAL").when(amount > F.lit(high), "HIGH").otherwise("NORMAL")
    )
