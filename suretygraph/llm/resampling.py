"""Importance resampling of documents towards a target's distribution of n-grams.

Texts are lower-cased (A to Z), every run of separators becomes one space, and an overlapped regular expression with
lookarounds at the words' bounds gives the spans of all n-grams of up to ``longest`` words, which are counted by their CRC-32
in a fixed number of buckets. A bucket's gain is the logarithm of its share in the target to its share in the corpus, both
smoothed by one, in thousandths and floored; a document's weight is the floored mean of its features' gains. A Gumbel number
drawn from the document's id is added, and the documents with the highest sums are drawn, without replacement.

Every text is scanned once: its buckets, two bytes a feature, are written and read again for the counts and the weights.
Counts cover all features of all rows. What comes to the driver and to every task is one gain for each bucket. Places come
from range partitions.

A null text has no features and weighs 0, as one without words does. A null id draws as the empty text does and comes last
among ties. Repeated rows are rows of their own, with one score; of equal rows any may be drawn. With an empty target or corpus
its counts are 0. Only the columns named are read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suretygraph.llm.arrow import arrow_map, batch, longs, row_of
from suretygraph.llm.places import numbered
from suretygraph.llm.staging import session_of, stored

BUCKETS, LONGEST = 10_000, 2
LEAST_WORDS, PERCENT, SEED = 20, 25, 7
#: A batch of results is closed beyond so many bytes of buckets.
OUT_BYTES = 4 << 20

#: Letters, digits and all bytes beyond ASCII as they are, A to Z lower-cased, others a space.
_FOLD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in bytes(range(256)).lower())
_SPACES = re.compile(b"  +")


def gram_pattern(size: int):
    """A whole n-gram of so many words in a text with single spaces; to be searched overlapped."""
    return regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (size - 1))


def single_spaced(text: bytes) -> bytes:
    return _SPACES.sub(b" ", text.translate(_FOLD)).strip(b" ")


def gram_crcs(line: bytes, pattern) -> np.ndarray:
    spans = (m.span() for m in pattern.finditer(line, overlapped=True))
    return np.fromiter((zlib.crc32(line[a:b]) for a, b in spans), np.uint32)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``id``, ``n_words``, ``n_features`` and the features' buckets as 16-bit numbers in ``buckets``, for every row."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("a bucket's number has 16 bits")

    def scan(batches):
        patterns = [gram_pattern(n + 1) for n in range(longest)]
        for rows in batches:
            ids, texts = rows.column("id"), rows.column("text")
            words, grams, slots, begin, held = [], [], [], 0, 0
            for row in range(rows.num_rows):
                text = texts[row].as_buffer()
                line = single_spaced(text.to_pybytes()) if text is not None else b""
                found = [gram_crcs(line, p) for p in patterns]
                packed = (np.concatenate(found) % np.uint32(buckets)).astype("<u2").tobytes()
                words.append(len(found[0]))
                grams.append(len(packed) // 2)
                slots.append(packed)
                held += len(packed)
                if held > OUT_BYTES or row + 1 == rows.num_rows:
                    yield batch(id=ids.slice(begin, row + 1 - begin), n_words=longs(np.array(words)), n_features=longs(np.array(grams)),
                                buckets=pa.array(slots, pa.binary()))
                    words, grams, slots, begin, held = [], [], [], row + 1, 0

    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = own.schema["id"].dataType.simpleString()
    return arrow_map(own, scan, f"id {kind}, n_words long, n_features long, buckets binary")


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, ``n``: how many features of all rows fall in each bucket. A task adds up its own rows first."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for rows in batches:
            for slots in rows.column("buckets"):
                total += np.bincount(np.frombuffer(slots.as_buffer(), "<u2"), minlength=buckets)
        used = np.flatnonzero(total)
        yield batch(bucket=longs(used), n=longs(total[used]))

    partial = arrow_map(found.select("buckets"), count, "bucket long, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """For each bucket floor(1000 ln((t + 1) (S + buckets) / ((s + 1) (T + buckets)))), in doubles."""
    sides = corpus.select("bucket", F.col("n").alias("s"), F.lit(0).alias("t")).unionByName(
        target.select("bucket", F.lit(0).alias("s"), F.col("n").alias("t")))
    every = session_of(corpus).range(buckets).select(F.col("id").alias("bucket"), F.lit(0).alias("s"), F.lit(0).alias("t"))
    counts = sides.unionByName(every).groupBy("bucket").agg(F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t"))
    all_s, all_t = (float(x) for x in counts.agg(F.sum("s"), F.sum("t")).first())
    ratio = (F.col("t") + 1) * (all_s + buckets) / ((F.col("s") + 1) * (all_t + buckets))
    rows = counts.select("bucket", F.floor(F.log(ratio) * 1000).cast("long").alias("gain")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows["bucket"].to_numpy()] = rows["gain"].to_numpy()
    return out


def weigh(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``id``, ``n_words``, ``n_features`` and ``weight``, the floored mean of the features' gains (0 without features)."""

    def add(batches):
        for rows in batches:
            sums = [int(gain[np.frombuffer(slots.as_buffer(), "<u2")].sum()) for slots in rows.column("buckets")]
            n = rows.column("n_features").to_numpy()
            yield batch(id=rows.column("id"), n_words=rows.column("n_words"), n_features=rows.column("n_features"),
                        weight=longs(np.array(sums, np.int64) // np.maximum(n, 1)))

    kind = found.schema["id"].dataType.simpleString()
    return arrow_map(found, add, f"id {kind}, n_words long, n_features long, weight long")


def drawn_number(id_col: str, seed: int = SEED):
    """A Gumbel number in thousandths, floored, from the first 32 bits of a digest of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    uniform = (F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)
    return F.floor(F.log(-F.log(uniform)) * -1000).cast("long")


def ranked(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", *,
    longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """A row for each document: ``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``, its place among the
    drawn, from 1 (null: not drawn). Drawn are ``percent`` of the documents of at least ``least_words`` words, rounded down."""
    own = stored(features(docs, id_col, text_col, longest, buckets), "features")
    wanted = features(target, target_text_col, target_text_col, longest, buckets)
    gain = gains(bucket_counts(own, buckets), bucket_counts(wanted, buckets), buckets)
    # The same rows are numbered alike in every run of a task: they are read from a written table.
    scored = weigh(own, gain).select(
        F.col("id").alias("doc_id"), "n_words", "n_features", "weight", (F.col("weight") + drawn_number("id", seed)).alias("score"))
    eligible = F.col("n_words") >= least_words
    in_order = numbered(
        scored.filter(eligible), [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("n_features")], "place")
    n_drawn = in_order.count() * percent // 100
    rank = F.when(F.col("place") <= n_drawn, F.col("place"))
    return in_order.withColumn("rank", rank).drop("place").unionByName(
        scored.filter(~eligible).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The drawn documents, all their columns. Rows of one id go together, those without an id too."""
    ids = ranked(docs, target, id_col, text_col, **options).filter("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct()
    own = docs.select(F.col(id_col).alias("_id"), row_of(docs).alias("_own"))
    return own.join(ids, F.col("_id").eqNullSafe(F.col("_drawn")), "left_semi").select("_own.*")
