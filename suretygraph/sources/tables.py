"""The benchmark tables in the shape of the engine's inputs (FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from suretygraph.schemas import MONEY


# The columns used of each table. Given to the reader, they save a pass over the file footers.
COLUMNS = {
    "lineitem": "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_tax double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey long, s_nationkey int",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, *values) -> Column:
    """The value at ``index``, counted from 0; null past the end."""
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The narrow order side meets the customers first; line items are shuffled once, for the last join.
    placed = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
        F.col("o_custkey") == F.col("c_custkey"),
    ).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "c_nationkey")
    lines = table(spark, sf_dir, "lineitem").join(placed, F.col("l_orderkey") == F.col("o_orderkey"))

    # The price is cast once, in a step of its own: from double that is the dearest part of a row, and both amounts use it.
    quantity, price = F.col("l_quantity"), F.col("_price")
    line = F.coalesce(F.concat(F.lit("_"), F.col("l_linenumber")), F.lit(""))
    return lines.withColumn("_price", F.col("l_extendedprice").cast(MONEY)).select(
        F.when(quantity != 5, F.concat(F.lit("TX_"), F.col("l_orderkey"), line)).alias("transaction_id"),
        F.concat(F.lit("ACC_"), F.col("o_custkey")).alias("source_account_id"),
        F.concat(F.lit("ACC_"), F.col("l_partkey")).alias("target_account_id"),
        # Cast branch by branch, so that the plain price stays as it is.
        F.when(quantity == 1, F.lit(None))
        .when(quantity == 2, F.lit(0).cast(MONEY))
        .when(quantity == 3, (-price).cast(MONEY))
        .when(quantity >= 45, (price * 5).cast(MONEY))
        .otherwise(price)
        .alias("guarantee_amount_usd"),
        F.when(quantity == 4, F.lit(None))
        .when(quantity == 6, F.lit(-1))
        .otherwise((price * F.col("l_tax").cast(MONEY)).cast(MONEY))
        .cast(MONEY)
        .alias("fee_amount_usd"),
        F.when(F.col("o_orderstatus") == "F", "APPROVED")
        .when(F.col("o_orderstatus") == "O", "PENDING_RISK_AUDIT")
        .otherwise("DECLINED")
        .alias("status"),
        F.col("o_orderdate").alias("timestamp"),
        _pick(F.col("c_nationkey") % 6, "CL", "PE", "MX", "BR", "AR").alias("country_code"),
    )


def free_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = F.col("c_custkey") % 20
    return (
        table(spark, sf_dir, "customer")
        .filter(slot < 4)
        .select(
            F.concat(F.lit("ACC_"), F.col("c_custkey")).alias("account_id"),
            F.col("c_name").alias("account_name"),
            F.col("c_mktsegment").alias("client_segment"),
            _pick(
                slot.cast("int"), "FREE_PROMO_90D", "PARTNER_ZERO_FEE", "WELCOME_OFFER", "OTHER_BENEFIT"
            ).alias("benefit_type"),
            F.lit("2026-01-01").cast("date").alias("activation_date"),
        )
    )


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    name = _pick(
        (key % 6).cast("int"),
        "Delta Trading", "Norte Holding", "Norte Delta Group", "Lumen Works", "Quartz Corp", "DELTA Marine",
    )
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("VEN_"), key).alias("vendor_id"),
        F.concat_ws(" ", name, F.lit("Division"), key).alias("legal_name"),
        _pick(F.col("s_nationkey") % 4, "CL", "PE", "MX", "BR").alias("country"),
        F.concat(F.lit("T-"), key * 7919).alias("tax_id_pii"),
        F.concat(F.lit("lookup/"), key).alias("search_api_endpoint"),
    )


# Lookup keywords that go with the mapped vendor names above.
KEYWORDS = (("delta", "delta.example"), ("norte", "norte.example"), ("lumen", "lumen.example"))


def attempt_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lookup attempt with its time and id; ``vendors.number_attempts`` counts them per vendor."""
    kind = F.col("event_type")
    body = F.when(F.col("value") < 3, "{}").otherwise(
        F.concat(F.lit('{"domain": "d'), F.col("user_id"), F.lit('.example"}'))
    )
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("VEN_"), F.col("user_id")).alias("vendor_id"),
        F.col("ts").alias("attempted_at"),
        F.col("event_id").alias("attempt_id"),
        F.when(kind == "click", 200).when(kind == "signup", 429).when(kind == "view", 503)
        .when(kind == "purchase", 404).alias("status_code"),
        F.when(kind == "click", body).alias("response_body"),
    )
