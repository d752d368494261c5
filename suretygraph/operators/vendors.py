"""Vendor enrichment: domains by keyword, or outcomes read from a log of lookup attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from suretygraph.constants import DOMAIN_KEYWORDS, MAX_ATTEMPTS, UNKNOWN_DOMAIN
from suretygraph.functions import vendor as rule


def resolve_vendor_domain(
    vendors: DataFrame, *, keywords=DOMAIN_KEYWORDS, default: str = UNKNOWN_DOMAIN
) -> DataFrame:
    """Adds ``domain``, found by keyword in the company name."""
    return vendors.withColumn("domain", rule.domain_for(F.col("legal_name"), keywords, default))


def classify_attempts(attempts: DataFrame) -> DataFrame:
    return attempts.withColumn("attempt_class", rule.attempt_class(F.col("status_code")))


def attempt_domains(attempts: DataFrame) -> DataFrame:
    return attempts.withColumn("domain", rule.response_domain(F.col("response_body")))


def number_attempts(log: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """The first ``max_attempts`` attempts of each vendor, numbered from 1 as ``attempt``.

    Later attempts can't change an outcome. The bound on the row number lets Spark keep at most that
    many rows per vendor in each map task, so a vendor with a huge log is cut before the shuffle.
    """
    order = Window.partitionBy("vendor_id").orderBy("attempted_at", "attempt_id")
    return (
        log.withColumn("attempt", F.row_number().over(order))
        .filter(F.col("attempt") <= max_attempts)
        .select("vendor_id", "attempt", "status_code", "response_body")
    )


def earliest_attempts(log: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """The first ``max_attempts`` attempts of each vendor, all columns of the log. Cut on the map side as ``number_attempts``."""
    order = Window.partitionBy("vendor_id").orderBy("attempted_at", "attempt_id")
    return log.withColumn("_row", F.row_number().over(order)).filter(F.col("_row") <= max_attempts).drop("_row")


def merge_attempts(stored: DataFrame, log: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """The earliest attempts of what is stored and a further log, in any order of time. No others can decide an outcome, so a
    log that was merged needn't be read again. An attempt offered twice, with the same time and id, counts once."""
    both = stored.unionByName(earliest_attempts(log, max_attempts).select(*stored.columns))
    return earliest_attempts(both.dropDuplicates(["vendor_id", "attempted_at", "attempt_id"]), max_attempts)


def vendor_outcome(attempts: DataFrame, *, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """What the attempts came to, per vendor.

    The first final attempt among the first ``max_attempts`` decides; without one the vendor failed.
    Only attempts up to the deciding one count. ``attempts`` numbers each vendor's attempts from 1,
    so the window holds at most ``max_attempts`` rows per vendor, and the aggregate after it needs no
    further shuffle. A log numbered by ``number_attempts`` must have been cut at no fewer.
    """
    earlier = (
        Window.partitionBy("vendor_id").orderBy("attempt").rowsBetween(Window.unboundedPreceding, -1)
    )
    tried = classify_attempts(attempts.filter(F.col("attempt") <= max_attempts))
    final = rule.is_final(F.col("attempt_class"))
    live = tried.withColumn("_decided", F.coalesce(F.bool_or(final).over(earlier), F.lit(False))).filter(
        ~F.col("_decided")
    )
    success = F.bool_or(F.col("attempt_class") == rule.SUCCESS)
    return live.groupBy("vendor_id").agg(
        F.when(success, rule.SUCCESS).otherwise(rule.FAILED).alias("outcome"),
        F.max(
            F.when(
                F.col("attempt_class") == rule.SUCCESS, rule.response_domain(F.col("response_body"))
            )
        ).alias("domain"),
        F.count_if(~final).alias("retries"),
        F.count_if(F.col("attempt_class") == rule.NETWORK_ERROR).alias("network_errors"),
    )


def enrichment_counters(outcomes: DataFrame) -> DataFrame:
    """Totals of a run: one row with success, failed, retries and network_errors."""
    return outcomes.agg(
        F.count_if(F.col("outcome") == rule.SUCCESS).alias("success"),
        F.count_if(F.col("outcome") == rule.FAILED).alias("failed"),
        F.coalesce(F.sum("retries"), F.lit(0)).alias("retries"),
        F.coalesce(F.sum("network_errors"), F.lit(0)).alias("network_errors"),
    )


def domains_from_outcomes(vendors: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Adds ``domain`` from the outcome; null for a vendor that was never tried."""
    return vendors.join(outcomes.select("vendor_id", "domain"), "vendor_id", "left")


def enriched_vendors(
    resolved: DataFrame,
    *,
    salt: str,
    run_date: str | None = None,
    processed_at=None,
    null_tax_id: str | None = None,
) -> DataFrame:
    """The vendor output record, from vendors with a ``domain``. The tax id leaves only as its hash."""
    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp")
    return resolved.select(
        "vendor_id",
        "legal_name",
        "country",
        F.col("domain").alias("official_domain"),
        rule.hash_tax_id(F.col("tax_id_pii"), salt, null_tax_id).alias("tax_id_sha256"),
        F.date_format(F.to_utc_timestamp(stamp, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(
            "processed_at"
        ),
        rule.enrichment_status(F.col("domain")).alias("enrichment_status"),
        F.lit(run_date[:10] if run_date else None).cast("string").alias("execution_date"),
    )


def hashed_tax_ids(vendors: DataFrame, *, salt: str, null_tax_id: str | None = None) -> DataFrame:
    return vendors.select(
        "vendor_id", rule.hash_tax_id(F.col("tax_id_pii"), salt, null_tax_id).alias("tax_id_sha256")
    )
