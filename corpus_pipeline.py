"""The corpus pipeline: documents through five stages in order, each written and read again.

Toxic documents go, one document of each group of near copies stays, long passages that an earlier document has are taken
out, documents that hold benchmark passages go, and what is left is mixed to the sources' target weights. All stages but the
last return the columns of documents; the last adds ``copy``, the number of a repetition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suretygraph.llm import decontamination, minhash, mixture, substring, toxicity
from suretygraph.llm.arrow import row_of
from suretygraph.llm.staging import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    weights = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, weights)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies share 0.8 or more of their shingles of five words."""
    return minhash.drop_near_duplicates(docs, shingle=5, share=80)


def remove_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A text that loses words is its other words joined by one space; a text that loses none stays as it is."""
    cut = substring.remove_repeats(docs.select("doc_id", "text", row_of(docs).alias("whole")))
    changed = F.col("n_removed") > 0
    new = {
        "text": F.when(changed, F.col("kept_text")).otherwise(F.col("whole.text")),
        "n_chars": F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("whole.n_chars")),
    }
    return cut.select(*[new.get(c, F.col("whole").getField(c)).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", remove_passages),
    ("decontamination", drop_contaminated),
    ("mixture", mix_sources),
]

#: SQL can't express the stages that learn; the run is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
