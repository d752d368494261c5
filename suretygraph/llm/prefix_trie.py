"""A trie of conversations' prefixes, screened by a count-min sketch.

A prefix of d turns has a digest of 128 bits, the sum of its turns' digests tagged with their places; digests stand for the
turns from the first scan on, so texts are never shuffled. A sketch of two tables counts the digests of all prefixes, up to
two. It never counts too few: an estimate of one proves that only one conversation has the prefix, and its row is finished
where it is, without a shuffle (**tails**). Only the others, possibly shared, are grouped exactly by their digest.

What a node sums over its subtree needs no walk. A conversation **owns** the nodes whose smallest member it is, and these are
all its prefixes from some depth on. So a node's sum is the sum over its members of what each owns at the node's depth or
below: the owner's own running sum from its end, and the other members' totals, which each sends once to every possibly
shared prefix above its own nodes. That is one row for a member and prefix, as many as were grouped before.

Sizes. The sketch has four cells for a prefix and is broadcast, two bits a cell; it stops growing at ``MOST_CELLS`` a table
(32 MB in all), where some 10**8 prefixes begin to fill it. Beyond, more prefixes are taken for possibly shared and go through
the exact grouping: the results are the same, the shuffles larger. Conversations of any length are split over range partitions.
The ids of the conversations that end at one shared node are sorted over range partitions too, and joined there to pieces of
text; only the digest of the pieces is taken by one task, a piece at a time.

Turns are ordered by number, nulls first, turns of one number by the digest of their role and text; repeated rows are turns of
their own. A null role or text is empty. Rows without a conversation id belong to none and are left out. A table without
conversations has no nodes, not even the root. Only the four columns named are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from suretygraph.llm.arrow import arrow_map, batch, longs
from suretygraph.llm.ordering import running_sums
from suretygraph.llm.staging import session_of, stored
from suretygraph.llm.tokens import U, mix

#: Cells of one of the sketch's two tables at most.
MOST_CELLS = 1 << 26
CELLS_PER_PREFIX = 4
CHUNK = 1 << 14
#: Ids are joined to pieces of about so many bytes before their digest is taken.
PIECE_BYTES = 1 << 20

KEY = ("k1", "k2")
PARENT = ("p1", "p2")
NO_END = hashlib.sha256(b"").hexdigest()


def ordered_turns(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id``, ``depth`` (the turn's place from 1), its digest ``t1``, ``t2`` and its text's ``chars``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    hexes = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    part = lambda at: F.conv(F.substring("hexes", at, 15), 16, 10).cast("long")
    own = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), hexes.alias("hexes"), F.length(text).cast("long").alias("chars"),
    ).select("conv_id", "turn", "chars", part(1).alias("t1"), part(16).alias("t2"), F.lit(1).cast("long").alias("one"))
    order = [F.asc_nulls_first("turn"), F.col("t1"), F.col("t2")]
    return running_sums(own, "conv_id", order, ["one"]).select(
        "conv_id", F.col("one_sum").alias("depth"), "t1", "t2", "chars")


def conversations(ordered: DataFrame) -> DataFrame:
    """``conv_id`` and ``length`` of each."""
    return ordered.groupBy("conv_id").agg(F.max("depth").alias("length"))


def share_heads(ordered: DataFrame, every: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations with other first turns, and their lengths: h = CRC-32 of the id modulo ``most`` + 1, the first h turns come
    from the conversation c - c % ``every`` (all if it has fewer, none if there is none), the others are c's own after its first h."""
    ordered = stored(ordered, "ordered")
    turn = F.struct("depth", "t1", "t2", "chars")
    # The second key leaves the groups as they are, and lets adaptive execution split a hot conversation in the join below.
    heads = ordered.groupBy("conv_id", F.hash("conv_id").alias("_split")).agg(
        F.max("depth").alias("n"), F.array_sort(F.collect_list(F.when(F.col("depth") <= most, turn))).alias("head")).drop("_split")
    heads = stored(heads, "heads")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    bases = heads.select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    plan = heads.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base")).join(bases, "base", "left")
    first = F.slice(F.coalesce("base_head", F.array()), 1, F.col("h").cast("int"))
    plan = stored(plan.select("conv_id", "h", first.alias("first"), F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("own")), "plan")
    length = (F.size("first") + F.col("own")).alias("length")
    copied = plan.select("conv_id", length, F.inline("first")).select("conv_id", "length", "depth", "t1", "t2", "chars")
    own = ordered.join(plan.select("conv_id", "h", F.size("first").alias("k"), length), "conv_id").filter(F.col("depth") > F.col("h")).select(
        "conv_id", "length", (F.col("depth") - F.col("h") + F.col("k")).alias("depth"), "t1", "t2", "chars")
    return copied.unionByName(own), plan.select("conv_id", length)


def prefixes(ordered: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row for each conversation and depth from 0: digest ``k1``, ``k2`` of the prefix, ``p1``, ``p2`` of the one before it,
    and the conversation's length. ``ordered`` has the length of its conversation."""
    tagged = ordered.withColumns({
        "k1": F.xxhash64("t1", F.col("depth").cast("long")), "k2": F.xxhash64("t2", F.col("depth").cast("long"), F.lit(1))}).drop("t1", "t2")
    sums = running_sums(tagged, "conv_id", [F.col("depth")], list(KEY)).select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.col("length").cast("long").alias("length"), "chars",
        F.col("k1_sum").alias("k1"), F.col("k2_sum").alias("k2"), F.col("k1_before").alias("p1"), F.col("k2_before").alias("p2"))
    zero = F.lit(0).cast("long")
    roots = lengths.select("conv_id", zero.alias("depth"), F.col("length").cast("long").alias("length"), zero.alias("chars"),
                           *[zero.alias(c) for c in (*KEY, *PARENT)])
    return sums.unionByName(roots)


class Sketch:
    """Two tables of two-bit counts of 128-bit digests; 2 stands for two or more."""

    def __init__(self, cells: int):
        self.cells, self.packed = cells, np.zeros(2 * cells // 4, np.uint8)

    @staticmethod
    def slots(k1: np.ndarray, k2: np.ndarray, cells: int) -> np.ndarray:
        mask = U(cells - 1)
        return np.stack([mix(k1) & mask, (mix(k2) & mask) + U(cells)]).astype(np.int64)

    def estimate(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        at = self.slots(k1, k2, self.cells)
        return ((self.packed[at >> 2] >> ((at & 3) * 2).astype(np.uint8)) & 3).min(axis=0)


def pack(counts: np.ndarray) -> np.ndarray:
    four = counts.reshape(-1, 4)
    return four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6


def unpack(packed: np.ndarray) -> np.ndarray:
    return np.stack([packed >> s & 3 for s in (0, 2, 4, 6)], axis=1).reshape(-1)


def sketch(members: DataFrame, n: int, most_cells: int = MOST_CELLS) -> Sketch:
    """Counts the prefixes of all rows. Each task adds up its own rows, chunks of the tables are added up by tasks of their own."""
    cells = CHUNK
    while cells < min(n * CELLS_PER_PREFIX, most_cells):
        cells <<= 1

    def count(batches):
        counts = np.zeros(2 * cells, np.uint8)
        for rows in batches:
            found = Sketch.slots(*[rows.column(c).to_numpy().view(U) for c in KEY], cells)
            slots, times = np.unique(found, return_counts=True)
            counts[slots] = np.minimum(counts[slots] + np.minimum(times, 2), 2)
        for at in range(0, len(counts), CHUNK):
            if counts[at : at + CHUNK].any():
                yield batch(chunk=longs(np.array([at // CHUNK])), counts=pa.array([pack(counts[at : at + CHUNK]).tobytes()], pa.binary()))

    def add(batches):
        total = {}
        for rows in batches:
            for chunk, counts in zip(rows.column("chunk").to_pylist(), rows.column("counts")):
                more = unpack(np.frombuffer(counts.as_buffer(), np.uint8))
                total[chunk] = np.minimum(total.get(chunk, 0) + more, 2).astype(np.uint8)
        for chunk, counts in total.items():
            yield batch(chunk=longs(np.array([chunk])), counts=pa.array([pack(counts).tobytes()], pa.binary()))

    schema = "chunk long, counts binary"
    partial = arrow_map(members.select(*KEY), count, schema)
    out = Sketch(cells)
    merged = arrow_map(partial.repartition("chunk"), add, schema).toArrow()
    for chunk, counts in zip(merged["chunk"].to_pylist(), merged["counts"].to_pylist()):
        at = chunk * CHUNK // 4
        out.packed[at : at + CHUNK // 4] = np.frombuffer(counts, np.uint8)
    return out


def screen(members: DataFrame, counts: Sketch) -> DataFrame:
    """Adds ``single`` and ``parent_single``: proven to be a prefix of one conversation only."""

    def look_up(batches):
        for rows in batches:
            single, above = ([rows.column(c).to_numpy().view(U) for c in names] for names in (KEY, PARENT))
            yield batch(**dict(zip(rows.schema.names, rows.columns)), single=pa.array(counts.estimate(*single) == 1),
                        parent_single=pa.array((counts.estimate(*above) == 1) & (rows.column("depth").to_numpy() > 0)))

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema.fields)
    return arrow_map(members, look_up, f"{columns}, single boolean, parent_single boolean")


def id_digests(ends: DataFrame) -> DataFrame:
    """For each (k1, k2) the SHA-256 of its ``conv_id`` in decimal, ascending, joined by commas."""
    kind = ends.schema["conv_id"].dataType.simpleString()
    spread = ends.select(*KEY, "conv_id").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")

    def pieces(batches):
        for rows in batches:
            k1, k2 = (rows.column(c).to_numpy() for c in KEY)
            ids = rows.column("conv_id").to_pylist()
            cuts = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1
            bounds = [0, *cuts.tolist(), len(ids)] if len(ids) else []
            step = PIECE_BYTES // 16
            spans = [(at, min(at + step, b)) for a, b in zip(bounds[:-1], bounds[1:]) for at in range(a, b, step)]
            if spans:
                first = np.array([a for a, _ in spans])
                yield batch(k1=longs(k1[first]), k2=longs(k2[first]), first=rows.column("conv_id").take(pa.array(first)),
                            piece=pa.array([",".join(map(str, ids[a:b])) for a, b in spans]))

    def digest(batches):
        now, state = None, None
        for rows in batches:
            out = []
            for k1, k2, piece in zip(rows.column("k1").to_pylist(), rows.column("k2").to_pylist(), rows.column("piece")):
                if (k1, k2) != now:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = (k1, k2), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(piece.as_buffer())
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(("k1", "k2", "sha"), x)) for x in out])
        if now is not None:
            yield pa.RecordBatch.from_pylist([{"k1": now[0], "k2": now[1], "sha": state.hexdigest()}])

    joined = arrow_map(spread, pieces, f"k1 long, k2 long, first {kind}, piece string")
    by_node = joined.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return arrow_map(by_node, digest, "k1 long, k2 long, sha string")


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(a).alias(b) for a, b in names.items()])


def trie(ordered: DataFrame, lengths: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """The nodes: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``, and ``chars`` of the last text.

    ``ordered`` has ``conv_id``, ``length``, ``depth``, ``t1``, ``t2``, ``chars`` for each turn, ``lengths`` every conversation
    with its length, turnless ones too.
    """
    lengths = stored(lengths, "lengths")
    n = lengths.agg(F.coalesce(F.sum(F.col("length") + 1), F.lit(0)).cast("long")).first()[0]
    members = prefixes(ordered, lengths)
    screened = stored(screen(members, sketch(members, n, most_cells)), "screened")
    tails, shared = screened.filter("single"), screened.filter("not single")

    grouped = shared.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        *[F.max(c).alias(c) for c in ("depth", "chars", *PARENT, "parent_single")])
    grouped = stored(grouped.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")), "nodes")
    hanging = "depth > 0 and not parent_single"
    children = grouped.filter(hanging).select(*PARENT).unionByName(tails.filter(hanging).select(*PARENT)).groupBy(*PARENT).agg(
        F.count("*").alias("n_children"))
    nodes = grouped.join(_renamed(children, {"p1": "k1", "p2": "k2", "n_children": "n_children"}), list(KEY), "left")
    nodes = stored(nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "children")

    # What each conversation owns, from its own end on, and in all.
    leaf = (F.col("n_children") == 0).cast("long")
    zero = F.lit(0).cast("long")
    owned = nodes.select("conv_id", "depth", "saved", leaf.alias("leaves")).unionByName(
        tails.filter("depth = length").select("conv_id", F.lit(None).cast("long").alias("depth"), zero.alias("saved"), (zero + 1).alias("leaves")))
    totals = owned.groupBy("conv_id", F.hash("conv_id").alias("_split")).agg(
        F.min("depth").alias("from_depth"), F.sum("saved").alias("all_saved"), F.sum("leaves").alias("all_leaves")).drop("_split")
    totals = stored(totals, "totals")
    sent = shared.select("conv_id", "depth", *KEY).join(totals, "conv_id").filter(
        (F.col("from_depth").isNull() | (F.col("depth") < F.col("from_depth"))) & ((F.col("all_saved") > 0) | (F.col("all_leaves") > 0)))
    received = sent.groupBy(*KEY).agg(F.sum("all_saved").alias("more_saved"), F.sum("all_leaves").alias("more_leaves"))
    summed = running_sums(nodes.select(*KEY, "conv_id", "depth", "saved"), "conv_id", [F.desc("depth")], ["saved"])
    ends = id_digests(shared.filter("depth = length"))
    full = (
        nodes.join(summed.select(*KEY, "saved_sum"), list(KEY))
        .join(totals.select("conv_id", "all_leaves"), "conv_id")
        .join(received, list(KEY), "left").join(ends, list(KEY), "left")
    )
    parents = _renamed(grouped, {"k1": "p1", "k2": "p2", "conv_id": "above"})

    def parent(df: DataFrame) -> DataFrame:
        up = F.when(F.col("depth") == 0, F.lit(None)).when(F.col("parent_single"), F.col("conv_id")).otherwise(F.col("above"))
        return df.withColumn("parent_conv_id", up)

    exact = parent(full.join(parents, list(PARENT), "left")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("all_leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"),
        (F.col("saved_sum") + F.coalesce("more_saved", zero)).alias("saved_tokens"), F.coalesce("sha", F.lit(NO_END)).alias("ends_sha256"), "chars")
    last = F.col("depth") == F.col("length")

    def alone(df: DataFrame) -> DataFrame:
        return parent(df).select(
            "conv_id", "depth", "parent_conv_id", (zero + 1).alias("n_convs"), (~last).cast("long").alias("n_children"), (zero + 1).alias("n_leaves"),
            zero.alias("saved_tokens"), F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(NO_END).alias("ends_sha256"), "chars")

    # Only the first row of a tail looks its parent up.
    own = tails.filter(f"not ({hanging})").withColumn("above", F.lit(None).cast(tails.schema["conv_id"].dataType))
    hung = tails.filter(hanging).join(parents, list(PARENT), "left").select(own.columns)
    return exact.unionByName(alone(own)).unionByName(alone(hung))


def prefix_trie(turns: DataFrame, most_cells: int = MOST_CELLS, **columns) -> DataFrame:
    """The trie of the conversations as they are."""
    ordered = stored(ordered_turns(turns, **columns), "ordered")
    lengths = stored(conversations(ordered), "lengths")
    return trie(ordered.join(lengths, "conv_id"), lengths, most_cells)


def rebuilt_trie(turns: DataFrame, every: int = 100, most: int = 5, most_cells: int = MOST_CELLS, **columns) -> DataFrame:
    """The trie of conversations that share their first turns by ``share_heads``."""
    return trie(*share_heads(ordered_turns(turns, **columns), every, most), most_cells)
