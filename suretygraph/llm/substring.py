"""Removal of long passages that an earlier document has, by recompression.

1. Every text is recompressed (see ``recompression``) and its symbols are counted over the corpus: those in two
   documents or more are shared.
2. A window of ``window`` words holds the same symbols wherever it occurs, as far as their contexts lie within it.
   Windows all of whose symbols are shared, and the few without any, are candidates; the others occur once.
3. Candidates are verified word for word by a 96-bit hash of the window, whose smallest document is found by an
   aggregate. Windows of larger documents are removed.

Symbols shared are looked up in a bitmap of bounded size; a wrong hit only makes one more candidate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suretygraph.llm.arrow import arrow_map, batch, longs, put
from suretygraph.llm.bitmaps import MOST_BITS, Bitmap, bitmap
from suretygraph.llm.recompression import recompress
from suretygraph.llm.staging import session_of, stored
from suretygraph.llm.tokens import PLAIN, U, _table, mix, words

ROUNDS = 7
LONGEST = 12
_TAG = 40  # a place is a word's number below this bit and 23 bits of the text's hash above it


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """For each word the hash of the ``size`` words from it on, as far as there are so many."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.empty(n, U)
    step = 1 << 18
    up, down = _table(step + size)
    for at in range(0, n, step):
        part = hashes[at : at + step + size - 1]
        total = np.zeros(len(part) + 1, U)
        np.cumsum(mix(part) * up[: len(part)], out=total[1:])
        m = len(part) - size + 1
        out[at : at + m] = (total[size:] - total[:m]) * down[:m]
    return out


def _tags(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A few bits of each text's hash: rows that share an id but not their text are told apart by them."""
    total = np.zeros(len(hashes) + 1, U)
    np.cumsum(mix(hashes + (np.arange(len(hashes)) - np.repeat(first[:-1], np.diff(first))).astype(U)), out=total[1:])
    return (mix(total[first[1:]] - total[first[:-1]]) >> U(64 - 23)).astype(np.int64)


def _symbols(size: int):
    def run(batches):
        for b in batches:
            ids = b["doc_id"].to_numpy(zero_copy_only=False)
            for w in words(b["text"], PLAIN):
                s = recompress(w.hashes, w.first, ROUNDS, LONGEST)
                within = s.high - s.low <= size
                name, text = s.name[within], s.text[within]
                order = np.lexsort((name, text))
                name, text = name[order], text[order]
                new = np.ones(len(name), bool)
                new[1:] = (name[1:] != name[:-1]) | (text[1:] != text[:-1])
                yield batch(name=longs(name[new]), doc_id=longs(ids[w.row + text[new]]))

    return run


def candidate_windows(hashes: np.ndarray, first: np.ndarray, size: int, shared: Bitmap) -> tuple[np.ndarray, np.ndarray]:
    """First words of the windows that may occur elsewhere, and the number of each one's text."""
    text = np.repeat(np.arange(len(first) - 1), np.maximum(np.diff(first) - size + 1, 0))
    if not len(text):
        return text, text
    offset = np.concatenate([[0], np.cumsum(np.maximum(np.diff(first) - size + 1, 0))])
    start = np.arange(len(text)) - offset[text] + first[text]
    s = recompress(hashes, first, ROUNDS, LONGEST)
    alone = np.zeros(len(s) + 1, np.int64)
    np.cumsum(~shared.hits(s.name), out=alone[1:])
    begin = np.searchsorted(s.low, start)
    end = np.maximum(np.searchsorted(s.high, start + size, "right"), begin)
    perhaps = alone[end] == alone[begin]
    return start[perhaps], text[perhaps]


def _windows(size: int, shared):
    def run(batches):
        for b in batches:
            ids = b["doc_id"].to_numpy(zero_copy_only=False)
            for w in words(b["text"], PLAIN):
                start, text = candidate_windows(w.hashes, w.first, size, shared.value)
                if not len(start):
                    continue
                tags = _tags(w.hashes, w.first)
                name = mix(window_hashes(w.hashes, size)[start])
                check = window_hashes(w.hashes ^ U(0xA5A5A5A55A5A5A5A), size)[start]
                yield batch(
                    name=longs(name),
                    check=pa.array((mix(check) >> U(32)).astype(np.uint32).view(np.int32)),
                    doc_id=longs(ids[w.row + text]),
                    place=longs(tags[text] << _TAG | (start - w.first[text])),
                )

    return run


def _cut(text: bytes | None, places: list[int] | None, size: int) -> tuple[int, int, bytes]:
    """Number of words, of those removed, and the words kept."""
    split = (text or b"").split()
    n = len(split)
    if places and n:
        w = next(words(pa.array([text]), PLAIN))
        found = np.array(places, np.int64)
        found = found[found >> _TAG == _tags(w.hashes, w.first)[0]] & ((1 << _TAG) - 1)
        cover = np.zeros(n + 1, np.int64)
        np.add.at(cover, found, 1)
        np.add.at(cover, found + size, -1)
        split = [x for x, over in zip(split, np.cumsum(cover[:-1]).tolist()) if not over]
    return n, n - len(split), b" ".join(split)


def _remove(size: int, listed=None):
    """Cuts the texts; where ``listed`` is given, those that it doesn't hold, which have no places."""

    def run(batches):
        for b in batches:
            if listed:
                b = b.filter(pa.array(~listed.value.hits(b["key"].to_numpy().view(U))))
            texts = b["text"].cast(pa.large_binary())
            places = b["places"] if "places" in b.schema.names else None
            cut = [_cut(t.as_py(), places[i].as_py() if places else None, size) for i, t in enumerate(texts)]
            yield pa.RecordBatch.from_arrays(
                [b["_row"], *[pa.array([c[k] for c in cut], pa.int64()) for k in (0, 1)],
                 pa.array([c[2] for c in cut], pa.binary()).cast(pa.string(), safe=False)],
                names=["_row", "n_words", "n_removed", "kept_text"],
            )

    return run


def _listed(listed):
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(listed.value.hits(b["key"].to_numpy().view(U))))

    return run


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, most_bits: int = MOST_BITS
) -> DataFrame:
    """Adds ``n_words``, ``n_removed`` and ``kept_text`` (kept words joined by one space) to every row.

    A word goes if a window of ``window`` consecutive words that covers it also starts in a document with a
    smaller id. Windows are judged on the input. Null and empty texts have no words. A row whose id is null has
    no smaller or larger one: it keeps all and takes from none. Rows with one id take nothing from each other.
    Result columns replace input columns of the same name.
    """
    spark = session_of(docs)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id is not null")
    names = arrow_map(texts, _symbols(window), "name long, doc_id long")
    shared = stored(
        names.groupBy("name").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .filter("least < most").select("name"),
        "shared_symbols",
    )
    bits = spark.sparkContext.broadcast(bitmap(shared, "name", most_bits))
    windows = arrow_map(texts, _windows(window, bits), "name long, check int, doc_id long, place long")
    # The last key follows from the others: it makes the join shuffle anew, so that a hot window can be split there.
    least = (
        windows.groupBy("name", "check", (F.col("name") % 7).alias("_split"))
        .agg(F.min("doc_id").alias("least")).select("name", "check", "least")
    )
    places = stored(
        windows.join(least, ["name", "check"]).filter("doc_id > least")
        .groupBy("doc_id").agg(F.collect_list("place").alias("places")),
        "places",
    )
    # Only texts that may have places are shuffled to them; the others are finished where they are read.
    listed = spark.sparkContext.broadcast(bitmap(places.select(F.xxhash64("doc_id").alias("key")), "key", most_bits))
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).cast("long").alias("_id"),
        F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("long")).alias("key"),
    )
    with_places = arrow_map(row, _listed(listed), row.schema).join(places, F.col("_id") == F.col("doc_id"), "left")
    schema = T.StructType([
        row.schema["_row"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("kept_text", T.StringType()),
    ])
    cut = arrow_map(row.select("_row", "text", "key"), _remove(window, listed), schema).union(
        arrow_map(with_places.select("_row", "text", "places"), _remove(window), schema))
    return put(cut, "_row", "n_words", "n_removed", "kept_text")
