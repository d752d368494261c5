"""Mixing of sources to target weights by repetition rates.

The size of a document is its number of words. Sources share the size of all documents by weight, but none is taken more
than ``most`` times: what a source can't take is shared again by the others. A document is emitted floor(rate) times, and
once more with a probability of the rate's fraction, by a hash of its id, so a rerun takes the same.

Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from suretygraph.llm.arrow import put, row_of
from suretygraph.llm.host_quality import words_of
from suretygraph.llm.places import numbered
from suretygraph.llm.staging import stored, with_small


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """From rows (source, size) a row for each source: ``source``, ``source_size``, ``weight``, ``target``.

    Sources by code point, null last, weigh as ``weights`` says, again and again; their places come from range partitions.
    A level gives each source its weight times the level, or its limit where that is less. It begins where the weights share
    all, and rises as sources that are full leave the rest to the others, until no more are full. A round is one aggregate over
    the sources, and there are about as many as levels of fullness that matter: the level meets its end by Newton's steps.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = numbered(totals, [F.col("source").asc_nulls_last()], "k")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("k") - 1) % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * most
    weighed = stored(placed.select("source", "source_size", weight.cast("long").alias("weight"), limit.alias("limit")), "weights")
    total, full, level = None, None, None
    while True:
        is_full = F.lit(False) if level is None else F.col("limit").cast("double") <= F.col("weight") * F.lit(level)
        sums = weighed.agg(
            F.sum("source_size"), F.count_if(is_full), F.coalesce(F.sum(F.when(is_full, F.col("limit"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~is_full, F.col("weight"))), F.lit(0))).first()
        total = sums[0] or 0
        if sums[1] == full or not sums[3]:  # no more are full, or all are
            break
        full, level = sums[1], (total - sums[2]) / sums[3]
    if level is None or not sums[3]:
        target = F.col("limit").cast("double")
    else:
        target = F.least(F.col("limit").cast("double"), F.col("weight") * F.lit(level))
    return weighed.select("source", "source_size", "weight", target.alias("target"))


def chance(id_col: Column, text: Column) -> Column:
    """A number from 0 to 1 that depends on the id, or on the text where there is none."""
    seed = F.concat(F.lit("mixture:"), F.coalesce(id_col.cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text, F.lit(""))))))
    return F.conv(F.substring(F.md5(seed), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def plan(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    weights: Sequence[int] = (1, 2, 3), most: int = 3,
) -> DataFrame:
    """Adds ``size``, ``source_size``, ``target``, ``rate`` and ``copies`` to every row, in place of columns of these names.

    Null and empty texts have size 0 and count for nothing. A source whose size is 0 has rate 0. Rows without a source are
    one source, the last. Repeated rows with one id are taken the same number of times.
    """
    return put(_planned(docs, id_col, source_col, text_col, weights, most), "_own", "size", "source_size", "target", "rate", "copies")


def _planned(docs: DataFrame, id_col: str, source_col: str, text_col: str, weights: Sequence[int], most: int) -> DataFrame:
    """The plan beside each whole row, ``_own``."""
    text = F.col(text_col)
    key = [F.col(source_col).alias("_source"), F.size(words_of(text)).cast("long").alias("size")]
    shares = stored(targets(docs.select(F.col(source_col).alias("source"), key[1]), weights, most), "targets")
    rows = docs.select(row_of(docs).alias("_own"), *key, chance(F.col(id_col), text).alias("_chance"))
    joined = with_small(
        rows, shares.select(F.col("source").alias("_of"), "source_size", "target"), F.col("_source").eqNullSafe(F.col("_of")), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor("rate")
    copies = F.least(whole + (F.col("_chance") < F.col("rate") - whole).cast("long"), F.lit(most).cast("long"))
    return joined.withColumn("rate", rate).withColumn("copies", copies)


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    weights: Sequence[int] = (1, 2, 3), most: int = 3,
) -> DataFrame:
    """The mixed documents: each row as often as planned, numbered by ``copy`` from 1. A column of that name is replaced, all
    others stay."""
    planned = _planned(docs, id_col, source_col, text_col, weights, most).filter("copies > 0")
    return put(planned.select("_own", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")), "_own", "copy")
