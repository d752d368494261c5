"""Near-duplicate documents by one-permutation MinHash.

1. A document's set is its distinct word shingles, as 64-bit hashes. Documents with equal sets are one class,
   led by the smallest id, and only classes go on.
2. One permutation: the hash's leading bits choose a bin, the least hash of a bin is its value. An empty bin takes
   the value of another, drawn by a fixed random sequence of the bin until it meets a full one (optimal
   densification). Bands of bins give the buckets.
3. Candidates are stars: in each bucket the first member with all others, of a size that can reach the threshold.
   Links are confirmed on the whole sets. Then members already joined are one, and buckets that still hold several
   components get further stars: around the member with the most company in all its buckets, which is the likely
   original of a group of copies; within buckets of up to SMALL members every two that are still apart; and around
   members drawn anew each round until a round finds no link.
4. What large buckets still hold apart is settled by a prefix-filtered join: a set's shingles are ordered by rarity
   among these members, and two sets that reach the threshold share one of their first few, at places that leave
   enough of both. The pairs that pass are confirmed like the others.

A group of copies costs a few stars, not all its pairs. Two texts that reach the threshold are linked, or reachable over
links, if they share a bucket of any size.
"""

from __future__ import annotations

import hashlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suretygraph.llm.arrow import arrow_map, batch, long_lists, longs, row_of
from suretygraph.llm.bitmaps import MOST_BITS, bitmap
from suretygraph.llm.components import components
from suretygraph.llm.staging import session_of, stored, with_small
from suretygraph.llm.tokens import FOLDED, U, grams, mix, sequence_hash, words

#: A pair at the threshold of 0.85 shares no bucket of 42 bands of 6 bins with a probability of 2e-9.
BANDS, BINS_PER_BAND = 42, 6
_BINS = BANDS * BINS_PER_BAND
#: Buckets of up to so many members are compared pair by pair, a bounded number of pairs for each member.
SMALL = 16
#: Most slots of the counts that order shingles by rarity. More shingles than slots blur the order, which costs time, not pairs.
MOST_RARITY_BITS = 22
#: A shingle with more members to be found under it is dealt out in parts of this size.
HOT = 1000
_SALT = U(0x8CB92BA72F3D8DD7)


def shingle_sets(hashes: np.ndarray, first: np.ndarray, size: int) -> list[np.ndarray]:
    """For each text its distinct shingles, sorted. A text of fewer words is one shingle; without words, none."""
    n = np.diff(first)
    all_grams = grams(hashes, size)
    out = []
    for i in range(len(n)):
        if n[i] >= size:
            out.append(np.unique(all_grams[first[i] : first[i + 1] - size + 1]))
        elif n[i]:
            out.append(np.array([sequence_hash(hashes[first[i] : first[i + 1]])], U))
        else:
            out.append(hashes[:0])
    return out


def _draws() -> np.ndarray:
    return np.random.default_rng(8).integers(0, _BINS, (_BINS, 4096), dtype=np.int64)


_DRAWS = _draws()
_EDGES = (np.arange(_BINS + 1, dtype=object) * ((1 << 64) // _BINS)).astype(U)
_BAND_SEED = mix(np.arange(1, BANDS + 1).astype(U))


def buckets(shingles: np.ndarray) -> np.ndarray:
    """The bucket of each band for a sorted set that isn't empty."""
    at = np.searchsorted(shingles, _EDGES[:-1])
    end = np.append(at[1:], len(shingles))
    full = at < end
    source = np.arange(_BINS)
    empty = np.flatnonzero(~full)
    begin, width = 0, 16
    while len(empty) and begin < _DRAWS.shape[1]:
        drawn = _DRAWS[empty, begin : begin + width]
        met = full[drawn]
        some = met.any(axis=1)
        source[empty[some]] = drawn[some, met[some].argmax(axis=1)]
        empty, begin, width = empty[~some], begin + width, width * 8
    if len(empty):  # the sequence has ended: the next full bin in the circle
        filled = np.flatnonzero(full)
        source[empty] = filled[np.searchsorted(filled, empty) % len(filled)]
    value = shingles[at[source]].reshape(BANDS, BINS_PER_BAND)
    out = _BAND_SEED
    for k in range(BINS_PER_BAND):
        out = mix(out * _SALT + value[:, k])
    return out


def _signatures(size: int):
    def run(batches):
        for b in batches:
            for w in words(b["text"], FOLDED):
                sets = shingle_sets(w.hashes, w.first, size)
                bands = [buckets(s) if len(s) else s for s in sets]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in bands])])
                yield batch(
                    doc_id=b["doc_id"].slice(w.row, len(w)),
                    text_key=b["text_key"].slice(w.row, len(w)),
                    n=longs(np.array([len(s) for s in sets], np.int64)),
                    set_key=pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    buckets=long_lists(np.concatenate(bands) if bands else np.zeros(0, U), offsets),
                )

    return run


def _sets(size: int, wanted):
    def run(batches):
        for b in batches:
            b = b.filter(pa.array(wanted.value.hits(b["key"].to_numpy().view(U))))
            for w in words(b["text"], FOLDED):
                sets = shingle_sets(w.hashes, w.first, size)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
                yield batch(
                    doc_id=b["doc_id"].slice(w.row, len(w)),
                    shingles=long_lists(np.concatenate(sets) if sets else np.zeros(0, U), offsets),
                )

    return run


def _confirm(share: int):
    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b["x"], b["y"]):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= share * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _links(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    with_x = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
    with_both = with_x.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")
    return arrow_map(with_both.select("a", "b", "x", "y"), _confirm(share), "a long, b long")


def _apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with their present component and the bucket's size."""
    own = members.join(labels.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "own", F.coalesce("component", "doc")).drop("component")
    several = (
        own.groupBy("bucket", (F.col("bucket") % 7).alias("_split"))
        .agg(F.min("own").alias("u"), F.max("own").alias("v"), F.count("*").alias("size"))
        .filter("u < v").select("bucket", "size")
    )
    return own.join(several, "bucket")


def _star(apart: DataFrame, choice, share: int) -> DataFrame:
    """In each bucket the member that is largest by ``choice``, with those of other components."""
    hubs = (
        apart.groupBy("bucket", (F.col("bucket") % 7).alias("_split"))
        .agg(F.max(F.struct(choice.alias("choice"), "doc", "n", "own")).alias("hub"))
        .select("bucket", F.col("hub.doc").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.own").alias("hub_own"))
    )
    return apart.join(hubs, "bucket").filter((F.col("own") != F.col("hub_own")) & _reach(share))


def _all_of_small(apart: DataFrame, share: int) -> DataFrame:
    small = apart.filter(F.col("size") <= SMALL)
    other = small.select("bucket", F.col("doc").alias("hub"), F.col("n").alias("hub_n"), F.col("own").alias("hub_own"))
    return small.join(other, "bucket").filter(
        (F.col("doc") > F.col("hub")) & (F.col("own") != F.col("hub_own")) & _reach(share))


def _reach(share: int):
    """Whether two set sizes allow the similarity at all."""
    return 100 * F.least("n", "hub_n") >= share * F.greatest("n", "hub_n")


def _rarity(sets: DataFrame) -> np.ndarray:
    """How often the shingles of each slot occur. The driver receives at most 2**MOST_RARITY_BITS counts."""
    n = sets.agg(F.sum(F.size("shingles").cast("long"))).first()[0] or 0
    bits = min(max(n.bit_length(), 12), MOST_RARITY_BITS)
    slots = (
        sets.select(F.explode("shingles").alias("shingle"))
        .groupBy(F.col("shingle").bitwiseAND(F.lit((1 << bits) - 1)).alias("slot"))
        .count().toArrow()
    )
    out = np.zeros(1 << bits, np.uint32)
    out[slots["slot"].to_numpy()] = np.minimum(slots["count"].to_numpy(), 0xFFFFFFFF)
    return out


def _prefixes(share: int, rarity):
    """The rarest shingles of each set with their places in the order: those by which it finds sets that aren't larger,
    and marked among them those under which larger ones find it."""

    def run(batches):
        for b in batches:
            found, places, finds, lengths = [], [], [], []
            for x in b["shingles"]:
                x = x.values.to_numpy().view(U)
                n = len(x)
                order = np.lexsort((x, rarity.value[(x & U(len(rarity.value) - 1)).astype(np.int64)]))
                k = n - max(-(-share * n // 100), 1) + 1
                found.append(x[order[:k]])
                places.append(np.arange(k))
                finds.append(np.arange(k) < n - max(-(-2 * share * n // (100 + share)), 1) + 1)
                lengths.append(k)
            if not found:
                continue
            row = pa.array(np.repeat(np.arange(len(lengths)), lengths))
            yield batch(
                shingle=longs(np.concatenate(found)), place=longs(np.concatenate(places)),
                indexed=pa.array(np.concatenate(finds)), doc=b["doc_id"].take(row), own=b["own"].take(row),
                n=longs(np.repeat([len(x.values) for x in b["shingles"]], lengths)),
            )

    return run


def _prefix_pairs(left: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """All pairs (a, b) of the members left (doc, own) in different components that can reach the threshold."""
    own = stored(sets.join(left, sets.doc_id == left.doc).select("doc_id", "own", "shingles"), "left_sets")
    rarity = session_of(sets).sparkContext.broadcast(_rarity(own))
    rows = stored(
        arrow_map(own, _prefixes(share, rarity), "shingle long, place long, indexed boolean, doc long, own long, n long"),
        "prefixes",
    )
    hot = stored(
        rows.filter("indexed").groupBy("shingle").agg(F.count("*").alias("m")).filter(F.col("m") > HOT)
        .select("shingle", F.ceil(F.col("m") / HOT).alias("parts")),
        "hot",
    )
    dealt = with_small(rows, hot, "shingle", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    finder = dealt.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    indexed = dealt.filter("indexed").select(
        "shingle", F.pmod(F.xxhash64("doc"), "parts").alias("part"), F.col("doc").alias("hub"), F.col("n").alias("hub_n"),
        F.col("own").alias("hub_own"), F.col("place").alias("hub_place"),
    )
    ahead = (F.col("n") > F.col("hub_n")) | ((F.col("n") == F.col("hub_n")) & (F.col("doc") > F.col("hub")))
    enough = (100 + share) * F.least(F.col("n") - F.col("place"), F.col("hub_n") - F.col("hub_place")) >= share * (
        F.col("n") + F.col("hub_n"))
    both = finder.withColumnRenamed("shingle", "s").withColumnRenamed("part", "p")
    return both.join(
        indexed,
        (both.s == indexed.shingle) & (both.p == indexed.part) & (F.col("own") != F.col("hub_own")) & ahead & enough & _reach(share),
    ).select(F.least("hub", "doc").alias("a"), F.greatest("hub", "doc").alias("b")).distinct()


def _stars(labels: DataFrame) -> DataFrame:
    """Links that join what is known to belong together, one for each node: fewer than those it was found by."""
    return labels.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))


def classes_and_links(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, share: int = 85,
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """One row for each input row: ``doc_id``, ``text_key`` (hash of the text), ``n_shingles`` and ``component_id``.

    Two documents are linked where 100 * intersection >= share * union of their sets of distinct shingles of
    ``shingle`` words, A-Z lower-cased; a text of fewer words is one shingle. ``component_id`` is the smallest id
    reachable over links, the document itself included. Null, empty and wordless texts have the empty set and are
    linked with nothing. Rows with a null id are linked with nothing and have a null component. Rows that share an
    id are judged by their own texts, but count as one node where each leads a class.
    """
    spark = session_of(docs)
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
        F.xxhash64(F.col(text_col)).alias("text_key"),
    )
    rows = stored(
        arrow_map(texts, _signatures(shingle), "doc_id long, text_key long, n long, set_key binary, buckets array<bigint>"),
        "signatures",
    )
    filled = rows.filter("doc_id is not null and n > 0")
    leaders = stored(
        filled.groupBy("set_key", F.hash("set_key").alias("_split")).agg(F.min("doc_id").alias("leader")).drop("_split"),
        "leaders",
    )
    lists = filled.join(leaders, (filled.doc_id == leaders.leader) & (filled.set_key == leaders.set_key)).select(
        F.col("leader").alias("doc"), "n", "buckets").dropDuplicates(["doc", "buckets"])
    members = lists.select(F.explode("buckets").alias("bucket"), "doc", "n")
    centres = (
        members.groupBy("bucket", (F.col("bucket") % 7).alias("_split"))
        .agg(F.min(F.struct("doc", "n")).alias("hub"), F.max("doc").alias("last"), F.count("*").alias("company"))
        .filter("hub.doc < last")
        .select("bucket", F.col("hub.doc").alias("hub"), F.col("hub.n").alias("hub_n"), "company")
    )
    members = stored(members.join(centres, "bucket"), "shared_buckets")
    wanted = stored(members.select(F.xxhash64("doc").alias("key")).distinct(), "wanted")
    bits = spark.sparkContext.broadcast(bitmap(wanted, "key", most_bits))
    sets = stored(
        arrow_map(texts.filter("doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id").alias("key")),
                  _sets(shingle, bits), "doc_id long, shingles array<bigint>"),
        "sets",
    )
    pairs = stored(
        members.filter((F.col("doc") != F.col("hub")) & _reach(share))
        .select(F.col("hub").alias("a"), F.col("doc").alias("b")).distinct(),
        "pairs",
    )
    links = stored(_links(pairs, sets, share), "links")
    labels = components(links)
    company = members.groupBy("doc").agg(F.sum("company").alias("company"))
    apart = members.select("bucket", "doc", "n").join(company, "doc")
    for step in count(1):
        apart = stored(_apart(apart, labels), "apart")
        if apart.isEmpty():
            break
        if step == 2:
            new = _all_of_small(apart, share)
            apart = apart.filter(F.col("size") > SMALL)
        else:
            new = _star(apart, F.col("company") if step == 1 else F.xxhash64(F.lit(step), "bucket", "doc"), share)
        new = stored(
            new.select(F.least("hub", "doc").alias("a"), F.greatest("hub", "doc").alias("b")).distinct()
            .join(pairs, ["a", "b"], "left_anti"),
            "pairs",
        )
        found = stored(_links(new, sets, share), "links")
        pairs, left = pairs.union(new), apart.select("doc", "own").distinct()
        apart = apart.drop("own", "size")
        if not found.isEmpty():
            labels = components(_stars(labels).union(found))
        elif step > 2:
            if not left.isEmpty():
                new = stored(_prefix_pairs(left, sets, share).join(pairs, ["a", "b"], "left_anti"), "pairs")
                labels = components(_stars(labels).union(stored(_links(new, sets, share), "links")))
            break
    classes = leaders.join(labels.withColumnRenamed("node", "leader"), "leader", "left").select(
        "set_key", F.coalesce("component", "leader").alias("component_id"))
    return rows.join(classes, "set_key", "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input without the rows whose component has a smaller id, so one document of each group stays.

    Rows with a null id stay. Equal rows with the group's smallest id all stay: they are one document.
    """
    gone = classes_and_links(docs, id_col, text_col, **options).filter("doc_id <> component_id").select(
        F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key"))
    own = docs.select(row_of(docs).alias("_own"), F.col(id_col).cast("long").alias("_id"), F.xxhash64(F.col(text_col)).alias("_key"))
    same = (F.col("_id") == F.col("_gone_id")) & (F.col("_key") == F.col("_gone_key"))
    return own.join(gone, same, "left_anti").select("_own.*")
