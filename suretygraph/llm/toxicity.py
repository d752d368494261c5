"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct words, pairs of neighbours and pairs with one word between, A-Z lower-cased, as
64-bit hashes. Learning takes a bounded sample of labelled rows, up to ``most_toxic`` toxic and ``most_clean`` others in
a fixed random order of ids, and only features of at least ``least_texts`` of these texts. The shares of the two
classes among all labelled rows correct the intercept. Each coordinate has its own rate; the L1 term leaves few
weights, which are broadcast. Every text is scored whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suretygraph.llm.arrow import arrow_map, batch, long_lists, longs, put
from suretygraph.llm.bitmaps import Bitmap, bitmap
from suretygraph.llm.split import draw, held_out
from suretygraph.llm.staging import session_of, stored
from suretygraph.llm.tokens import ALNUM, U, grams, mix, words


MOST_TOXIC, MOST_CLEAN = 3000, 5000
LEAST_TEXTS = 3


def features(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes and the number of the text each belongs to; repeated ones are still in."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    names, texts = [mix(hashes)], [text]
    for gap, seed in ((1, U(0x51ED270B35D1C3A7)), (2, U(0x2545F4914F6CDD1D))):
        if len(hashes) > gap:
            same = text[gap:] == text[:-gap]
            names.append(mix(mix(hashes[:-gap] + seed) * seed + hashes[gap:])[same])
            texts.append(text[gap:][same])
    return np.concatenate(names), np.concatenate(texts)


def _distinct(names: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((names, texts))
    names, texts = names[order], texts[order]
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]) | (texts[1:] != texts[:-1])
    return names[new], texts[new]


def _feature_rows(batches):
    for b in batches:
        for w in words(b["text"], ALNUM):
            names, _ = _distinct(*features(w.hashes, w.first))
            yield batch(feature=longs(names))


def _feature_lists(kept):
    def run(batches):
        for b in batches:
            for w in words(b["text"], ALNUM):
                names, texts = features(w.hashes, w.first)
                hit = kept.value.hits(names)
                names, texts = _distinct(names[hit], texts[hit])
                yield batch(
                    toxic=b["toxic"].slice(w.row, len(w)), at=b["at"].slice(w.row, len(w)),
                    features=long_lists(names, np.searchsorted(texts, np.arange(len(w) + 1))),
                )

    return run


@dataclass
class Weights:
    """A sparse model: sorted feature hashes, their weights, and the intercept."""

    names: np.ndarray
    values: np.ndarray
    intercept: float

    def __post_init__(self):
        bits = 1 << 16
        while bits < 32 * len(self.names):
            bits <<= 1
        cells = np.zeros(bits // 64, U)
        for shift in (0, 32):
            slot = (self.names >> U(shift)) & U(bits - 1)
            np.bitwise_or.at(cells, (slot >> U(6)).astype(np.int64), U(1) << (slot & U(63)))
        self.seen = Bitmap(cells)

    def scores(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        names, texts = features(hashes, first)
        hit = self.seen.hits(names)
        names, texts = _distinct(names[hit], texts[hit])
        margin = np.full(len(first) - 1, self.intercept)
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
            known = self.names[at] == names
            margin += np.bincount(texts[known], self.values[at[known]], len(first) - 1)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def ftrl(
    lists: list[np.ndarray], labels: np.ndarray, size: int, epochs: int = 20, alpha: float = 2.0, beta: float = 1.0,
    l1: float = 10.0, l2: float = 0.01,
) -> tuple[np.ndarray, float]:
    """Weights of the features 0 to size and the intercept. One coordinate more, always on, is the intercept."""
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at):
        x = z[at]
        w = -(x - np.sign(x) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        w[np.abs(x) <= l1] = 0
        return w

    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(lists)):
            at = np.append(lists[i], size)
            w = weights(at)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - labels[i]
            step = (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / alpha
            z[at] += gradient - step * w
            n[at] += gradient**2
    out = weights(np.arange(size + 1))
    return out[:-1], out[-1]


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN, least_texts: int = LEAST_TEXTS,
) -> Weights:
    """Learns from labelled rows that aren't held out. Labels other than 0 and 1 and null ids are passed over; a
    document labelled twice counts as toxic if one label says so. Without rows of both classes the score is the
    share of toxic rows, 0 if there are none."""
    spark = session_of(docs)
    known = (
        labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("toxic"))
        .filter(F.col("toxic").isin(0, 1) & ~held_out("_id")).groupBy("_id").agg(F.max("toxic").alias("toxic"))
    )
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = draw("_id", "toxicity")
    sample = None
    for label, most in ((1, most_toxic), (0, most_clean)):
        part = known.filter(F.col("toxic") == label).withColumn("at", order).orderBy("at", "_id").limit(most)
        sample = part if sample is None else sample.union(part)
    sample = stored(sample, "sample")
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text")).join(
        F.broadcast(sample), "_id").select("text", "toxic", "at")  # at most most_toxic + most_clean rows
    frequent = stored(
        arrow_map(texts, _feature_rows, "feature long").groupBy("feature").count()
        .filter(F.col("count") >= least_texts).select("feature"),
        "features",
    )
    kept = spark.sparkContext.broadcast(bitmap(frequent, "feature"))
    rows = arrow_map(texts, _feature_lists(kept), "toxic int, at long, features array<bigint>").orderBy("at").toArrow()
    y = rows["toxic"].to_numpy()
    if len(np.unique(y)) < 2:
        share = totals.get(1, 0) / max(sum(totals.values()), 1)
        return Weights(np.zeros(0, U), np.zeros(0), float(np.log(max(share, 1e-12) / max(1 - share, 1e-12))))
    lists = rows["features"].combine_chunks() if isinstance(rows["features"], pa.ChunkedArray) else rows["features"]
    flat, ends = lists.flatten().to_numpy().view(U), lists.offsets.to_numpy()
    names, number = np.unique(flat, return_inverse=True)
    values, intercept = ftrl([number[a:b] for a, b in zip(ends[:-1] - ends[0], ends[1:] - ends[0])], y, len(names))
    sampled = y.sum() / (len(y) - y.sum())
    intercept += np.log(totals[1] / totals[0] / sampled)
    keep = values != 0
    return Weights(names[keep], values[keep], float(intercept))


def _score(weights):
    def run(batches):
        for b in batches:
            parts = [weights.value.scores(w.hashes, w.first) for w in words(b["text"], ALNUM)]
            score = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b["_row"], pa.array(score)], names=["_row", "score"])

    return run


def score(docs: DataFrame, weights: Weights, text_col: str = "text") -> DataFrame:
    """Adds ``score``, between 0 and 1, to every row. Null and empty texts have no features and get the intercept's.
    An input column named score is replaced."""
    shared = session_of(docs).sparkContext.broadcast(weights)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["_row"], T.StructField("score", T.DoubleType())])
    return put(arrow_map(rows, _score(shared), schema), "_row", "score")


def _below(weights, most: float):
    def run(batches):
        for b in batches:
            parts = [weights.value.scores(w.hashes, w.first) for w in words(b["text"], ALNUM)]
            if parts:
                yield b.select(["_row"]).filter(pa.array(np.concatenate(parts) < most))

    return run


def drop_toxic(docs: DataFrame, weights: Weights, most: float = 0.7, text_col: str = "text") -> DataFrame:
    """The input without the rows whose score is ``most`` or more."""
    shared = session_of(docs).sparkContext.broadcast(weights)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text_col).alias("text"))
    return put(arrow_map(rows, _below(shared, most), T.StructType([rows.schema["_row"]])), "_row")
