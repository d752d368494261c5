"""Benchmark passages in documents, by a prefix-filtered set join.

1. Each item gives its windows of ``window`` words (an item of fewer words is one window), each window its set of
   shingles of three words. The shingles are counted over the whole corpus.
2. Order a window's shingles by rarity. A document that holds the window holds all its shingles, so the prefix of
   one, the rarest, is necessary: only documents with it are joined.
3. The place of the shingle in the document and in the window fixes where the window would have to begin and end.
   Both must lie in the document (positional and length bound); then the window's words are compared one by one.

Which shingles matter is asked of a bitmap of bounded size before anything is shuffled; the join is exact. Words are
compared by their 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suretygraph.llm.arrow import arrow_map, batch, long_lists, longs, row_of
from suretygraph.llm.bitmaps import MOST_BITS, bitmap
from suretygraph.llm.staging import session_of, stored
from suretygraph.llm.tokens import ALNUM, U, grams, words

SHINGLE = 3


def _windows(size: int):
    """Windows of the items with their shingles."""

    def run(batches):
        for b in batches:
            for w in words(b["text"], ALNUM):
                row, found = [], []
                for i in range(len(w)):
                    own = w.hashes[w.first[i] : w.first[i + 1]]
                    if len(own):
                        found += [own[k : k + size] for k in range(max(len(own) - size, 0) + 1)]
                        row += [w.row + i] * (len(found) - len(row))
                if found:
                    shingles = [grams(x, min(SHINGLE, len(x))) for x in found]
                    ends = lambda xs: np.concatenate([[0], np.cumsum([len(x) for x in xs])])
                    yield batch(
                        item_id=b["item_id"].take(pa.array(row)),
                        words=long_lists(np.concatenate(found), ends(found)),
                        shingles=long_lists(np.concatenate(shingles), ends(shingles)),
                    )

    return run


def _counts(wanted, sizes: list[int]):
    def run(batches):
        for b in batches:
            for w in words(b["text"], ALNUM):
                for k in sizes:
                    _, found = _occurrences(w, k, wanted.value)
                    if len(found):
                        name, n = np.unique(found, return_counts=True)
                        yield batch(shingle=longs(name), n=longs(n))

    return run


def _occurrences(w, k: int, wanted) -> tuple[np.ndarray, np.ndarray]:
    """First words and names of the shingles of k words that may be wanted."""
    found = grams(w.hashes, k)
    text = np.repeat(np.arange(len(w)), np.diff(w.first))[: len(found)]
    whole = np.arange(len(found)) + k <= w.first[text + 1]
    at = np.flatnonzero(whole & wanted.hits(found))
    return at, found[at]


def _postings(size: int, wanted, sizes: list[int]):
    """For each document its number of words and the wanted shingles, each with the words around it."""

    def run(batches):
        for b in batches:
            for w in words(b["text"], ALNUM):
                found = [_occurrences(w, k, wanted.value) for k in sizes]
                at = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
                name = np.concatenate([x for _, x in found]) if found else np.zeros(0, U)
                order = np.argsort(at, kind="stable")
                at, name = at[order], name[order]
                text = np.searchsorted(w.first, at, "right") - 1
                low = np.maximum(at - size + 1, w.first[text])
                high = np.minimum(at + size, w.first[text + 1])
                length = high - low
                ends = np.concatenate([[0], np.cumsum(length)])
                around = w.hashes[np.arange(ends[-1]) - np.repeat(ends[:-1] - low, length)]
                postings = pa.StructArray.from_arrays(
                    [longs(name), longs(at - w.first[text]), longs(at - low), long_lists(around, ends)],
                    names=["shingle", "place", "before", "around"],
                )
                per_text = np.searchsorted(at, w.first)
                yield batch(
                    doc_id=b["doc_id"].slice(w.row, len(w)),
                    text_key=b["text_key"].slice(w.row, len(w)),
                    n_words=longs(np.diff(w.first)),
                    postings=pa.ListArray.from_arrays(pa.array(per_text.astype(np.int32)), postings),
                )

    return run


def _covered(spans: F.Column) -> F.Column:
    """Words in sorted spans (place, length), each counted once."""
    step = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(x["place"] + x["length"] - F.greatest(s["end"], x["place"]), F.lit(0))).cast("long").alias("n"),
            F.greatest(s["end"], x["place"] + x["length"]).cast("long").alias("end"),
        ),
    )
    return step["n"]


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = 13, share: int = 20, most_bits: int = MOST_BITS,
) -> DataFrame:
    """One row for each document: ``doc_id``, ``text_key``, ``n_words``, ``n_hit``, ``item_ids`` and ``contaminated``.

    Words are runs of letters a-z (A-Z lower-cased), digits and characters beyond ASCII. A word is hit if any
    occurrence of an item's window covers it; a document is contaminated if n_hit > 0 and share * n_hit >= n_words.
    ``item_ids`` are the ids of the items with an occurring window, as strings in order. Null, empty and wordless
    texts have no words and no windows, so nothing hits them. An item whose id is null hits words, but is not in
    item_ids. Rows are judged by their own text, whatever their id; repeated rows and items count once each.
    """
    spark = session_of(docs)
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
        F.xxhash64(F.col(text_col)).alias("text_key"),
    )
    item_texts = items.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).alias("text"))
    found = stored(
        arrow_map(item_texts, _windows(window), "item_id string, words array<bigint>, shingles array<bigint>"), "windows")
    sizes = [r[0] for r in found.select(F.least(F.size("words"), F.lit(SHINGLE))).distinct().collect()]
    windows = found.groupBy("words").agg(F.any_value("shingles").alias("shingles"))
    parts = windows.select("words", F.posexplode("shingles").alias("offset", "shingle"))
    named = stored(parts.select("shingle").distinct(), "shingles")
    wanted = spark.sparkContext.broadcast(bitmap(named, "shingle", most_bits))
    counts = arrow_map(texts.select("text"), _counts(wanted, sizes), "shingle long, n long").groupBy("shingle").agg(
        F.sum("n").alias("n"))
    # A shingle that occurs nowhere is the rarest of all: its window can't occur either.
    prefix = stored(
        parts.join(counts, "shingle", "left")
        .groupBy("words").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("rarest"))
        .filter("rarest.n > 0").select("words", "rarest.shingle", "rarest.offset"),
        "prefixes",
    )
    first = spark.sparkContext.broadcast(bitmap(stored(prefix.select("shingle").distinct(), "first"), "shingle", most_bits))
    rows = stored(
        arrow_map(
            texts, _postings(window, first, sizes),
            "doc_id long, text_key long, n_words long,"
            " postings array<struct<shingle: bigint, place: bigint, before: bigint, around: array<bigint>>>",
        ),
        "postings",
    )
    begin = F.col("before") - F.col("offset")
    length = F.size("words")
    hits = stored(
        rows.select("doc_id", "text_key", F.explode("postings").alias("p")).select("doc_id", "text_key", "p.*")
        .join(prefix, "shingle")
        .filter((begin >= 0) & (begin + length <= F.size("around")))
        .filter(F.slice("around", begin.cast("int") + 1, length) == F.col("words"))
        .select("doc_id", "text_key", (F.col("place") - F.col("offset")).alias("place"), "words"),
        "hits",
    )
    spans = hits.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.struct("place", F.size("words").cast("long").alias("length")))).alias("spans"))
    ids = (
        hits.select("doc_id", "text_key", "words").distinct()
        .join(found.select("item_id", "words").distinct(), "words")
        .groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )
    judged = stored(
        spans.alias("s").join(ids.alias("i"), F.col("s.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("s.text_key") == F.col("i.text_key")))
        .select("s.doc_id", "s.text_key", _covered(F.col("spans")).alias("n_hit"), "item_ids"),
        "judged",
    )
    same = F.col("r.doc_id").eqNullSafe(F.col("j.doc_id")) & (F.col("r.text_key") == F.col("j.text_key"))
    n_hit = F.coalesce("j.n_hit", F.lit(0).cast("long"))
    return rows.drop("postings").alias("r").join(judged.alias("j"), same, "left").select(
        "r.doc_id", "r.text_key", "r.n_words", n_hit.alias("n_hit"),
        F.coalesce("j.item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & (share * n_hit >= F.col("r.n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input without the contaminated rows."""
    gone = contamination(docs, items, id_col, text_col, **options).filter("contaminated").select(
        F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key")).distinct()
    own = docs.select(row_of(docs).alias("_own"), F.col(id_col).cast("long").alias("_id"), F.xxhash64(F.col(text_col)).alias("_key"))
    same = F.col("_id").eqNullSafe(F.col("_gone_id")) & (F.col("_key") == F.col("_gone_key"))
    return own.join(gone, same, "left_anti").select("_own.*")
