"""Explicit schemas of the stored tables. Nothing is inferred at read time."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
PATH_COUNT = T.DecimalType(38, 0)

TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("source_account_id", T.StringType()),
    T.StructField("target_account_id", T.StringType()),
    T.StructField("guarantee_amount_usd", MONEY),
    T.StructField("fee_amount_usd", MONEY),
    T.StructField("status", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("country_code", T.StringType()),
])

FREE_ACCOUNTS = T.StructType([
    T.StructField("account_id", T.StringType()),
    T.StructField("account_name", T.StringType()),
    T.StructField("client_segment", T.StringType()),
    T.StructField("benefit_type", T.StringType()),
    T.StructField("activation_date", T.DateType()),
])

VENDORS = T.StructType([
    T.StructField("vendor_id", T.StringType()),
    T.StructField("legal_name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("tax_id_pii", T.StringType()),
    T.StructField("search_api_endpoint", T.StringType()),
])

LOOKUP_RESPONSE = T.StructType([
    T.StructField("vendor_id", T.IntegerType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("confidence_score", T.DoubleType()),
    T.StructField("resolved_at", T.StringType()),
])

CURATED = T.StructType(TRANSACTIONS.fields + [
    T.StructField("high_risk_transaction", T.BooleanType()),
    T.StructField("very_high_risk_transaction", T.BooleanType()),
    T.StructField("fee_percentage", T.DoubleType()),
    T.StructField("risk_category", T.StringType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("transaction_day", T.DateType()),
])

GRAPH_EDGES = T.StructType([
    T.StructField("source_account_id", T.StringType()),
    T.StructField("target_account_id", T.StringType()),
    T.StructField("guarantee_amount_usd", MONEY),
    T.StructField("transaction_day", T.DateType()),
])

GRAPH_NODES = T.StructType([T.StructField("id", T.StringType())])

GRAPH_NEIGHBOURS = T.StructType([
    T.StructField("account", T.StringType()),
    T.StructField("other", T.StringType()),
    T.StructField("outgoing", T.IntegerType()),
    T.StructField("incoming", T.IntegerType()),
])

RING_PATHS = T.StructType([
    T.StructField("account", T.StringType()),
    T.StructField("cycle_length", T.IntegerType()),
    T.StructField("path", T.StringType()),
    T.StructField("path_count", PATH_COUNT),
])

RING_CHANGES = T.StructType([
    T.StructField("account", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("total_amount", T.DecimalType(38, 2)),
    T.StructField("previous_amount", T.DecimalType(38, 2)),
    T.StructField("change", T.DecimalType(38, 2)),
    T.StructField("change_ratio", T.DoubleType()),
])

RISK_METRICS = T.StructType([
    T.StructField("transaction_day", T.DateType()),
    T.StructField("total_transactions", T.LongType()),
    T.StructField("total_guarantee_amount", T.DoubleType()),
    T.StructField("avg_transaction_amount", T.DoubleType()),
    T.StructField("high_risk_transactions", T.LongType()),
])

HIGH_VOLUME_ACCOUNTS = T.StructType([
    T.StructField("source_account_id", T.StringType()),
    T.StructField("transaction_count", T.LongType()),
    T.StructField("total_amount", T.DoubleType()),
])

ENRICHED_VENDORS = T.StructType([
    T.StructField("vendor_id", T.StringType()),
    T.StructField("legal_name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("official_domain", T.StringType()),
    T.StructField("tax_id_sha256", T.StringType()),
    T.StructField("processed_at", T.StringType()),
    T.StructField("enrichment_status", T.StringType()),
    T.StructField("execution_date", T.StringType()),
])

OUTCOMES = T.StructType([
    T.StructField("vendor_id", T.StringType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("retries", T.LongType()),
    T.StructField("network_errors", T.LongType()),
])

INTAKE = T.StructType([
    *TRANSACTIONS.fields,
    T.StructField("_corrupt", T.StringType()),
    T.StructField("delivery", T.DateType()),
    T.StructField("take", T.IntegerType()),
    T.StructField("transaction_day", T.DateType()),
])

FILES_TAKEN = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modified", T.LongType()),
    T.StructField("delivery", T.DateType()),
    T.StructField("take", T.IntegerType()),
])

REJECTED_LINES = T.StructType([
    T.StructField("line", T.StringType()),
    T.StructField("delivery", T.DateType()),
    T.StructField("take", T.IntegerType()),
])

TRANSACTION_COUNTERS = T.StructType([T.StructField(name, T.LongType()) for name in (
    "files_taken", "lines_taken", "lines_rejected", "rows_read", "without_id", "duplicates", "ids", "bad_amount", "bad_fee",
    "bad_country", "valid", "not_approved", "approved", "promotional", "written",
)])

#: The attempts of a vendor that can still decide its outcome.
ATTEMPTS = T.StructType([
    T.StructField("vendor_id", T.StringType()),
    T.StructField("attempted_at", T.TimestampNTZType()),
    T.StructField("attempt_id", T.LongType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("response_body", T.StringType()),
])
