"""The queries of this package, one for each operator, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suretygraph.llm import (
    chat,
    crf,
    decontamination,
    host_quality,
    minhash,
    mixture,
    prefix_trie,
    resampling,
    secrets,
    substring,
    toxicity,
    url_filter,
    warc,
)
from suretygraph.llm.split import held_out
from suretygraph.storage import staging_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query
def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.classes_and_links(docs).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.contamination(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, weights).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


@query
def op2_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    field = crf.fit(docs)
    return crf.predict(docs.select("doc_id", "text"), field).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


#: Fixed values of the task.
URL_RULES = (
    url_filter.Rule("block", "net/"),
    url_filter.Rule("allow", "example.net/en/"),
    url_filter.Rule("block", "example.com/de/"),
    url_filter.Rule("allow", "org/fr/"),
)


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{staging_folder(spark)}/warc"
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_records(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to")


@query
def op1_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return host_quality.judge(docs, keep_text=False).select("doc_id", *host_quality.MEASURES, "base_failed", "kept")


@query
def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixture.plan(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "<|im_end|><|im_start|>assistant ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], turns.schema)
    return chat.digests(chat.expand(turns.unionByName(hard)))


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.ranked(docs, table(spark, sf_dir, "benchmark").select("text")).select(
        "doc_id", "n_features", "weight", "score", "rank")


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations")).drop("chars")


@query
def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.digests(secrets.find_secrets(docs))
