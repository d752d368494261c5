"""The trie against one built in plain Python, with sketches of any size."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import clashing

from suretygraph.llm import ordering, places, prefix_trie
from suretygraph.llm.tokens import U

COLUMNS = "conv_id long, turn long, role string, text string"


def sequences(rows):
    """Turns in order; those of one number by digest, as the operator says."""
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:30]
            out.setdefault(conv, []).append((turn is not None, turn or 0, key, role, text))
    return {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in out.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def nodes(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), set()).add(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)

    def subtree(path):
        """Saved characters and leaves, children before their parents."""
        done, stack = {}, [path]
        while stack:
            at = stack[-1]
            todo = [c for c in children.get(at, ()) if c not in done]
            if todo:
                stack += todo
                continue
            stack.pop()
            below = [done[c] for c in children.get(at, ())]
            own = (len(members[at]) - 1) * len(at[-1][1]) if at else 0
            done[at] = (own + sum(s for s, _ in below), sum(n for _, n in below) or (0 if below else 1))
        return done

    sums = subtree(()) if members else {}
    return sorted(
        (min(who), len(path), min(members[path[:-1]]) if path else None, len(who), len(children.get(path, ())), sums[path][1], sums[path][0],
         hashlib.sha256(",".join(map(str, sorted(c for c in who if len(convs[c]) == len(path)))).encode()).hexdigest())
        for path, who in members.items())


def rows_of(frame):
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in frame.collect())


def chats(seed, n=150):
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        conv = draw.choice([c, c + 100, c * 7 % 350, 100 * (c % 4)])
        for turn in range(draw.randint(1, 9)):
            rows.append((conv, draw.choice([turn, turn, turn, None]), draw.choice(["user", "assistant", None]), draw.choice(["a", "bb", "ccc", "", None, "é😀"])))
    return rows


@pytest.mark.parametrize("most_cells", [prefix_trie.CHUNK, prefix_trie.MOST_CELLS])
def test_the_trie_of_rebuilt_conversations(spark, most_cells):
    rows = chats(1)
    found = prefix_trie.rebuilt_trie(clashing(spark.createDataFrame(rows, COLUMNS)).repartition(5), most_cells=most_cells)
    assert rows_of(found) == nodes(rebuilt(sequences(rows)))


def test_a_full_sketch_changes_nothing(spark, monkeypatch):
    """With one chunk of sixteen cells nearly all prefixes are taken for possibly shared."""
    rows = chats(2, 60)
    monkeypatch.setattr(prefix_trie, "CHUNK", 16)
    found = prefix_trie.prefix_trie(spark.createDataFrame(rows, COLUMNS), most_cells=16)
    assert rows_of(found) == nodes(sequences(rows))


def test_a_hot_conversation_and_a_hot_prefix(spark):
    """One conversation has a third of the turns, another third are copies; the order is split over range partitions."""
    rows = [(7, t, "user", f"t{t % 50}") for t in range(900)]
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(300) for t in range(3)]
    rows += [(5000 + c, t, "user", f"own {c} {t}") for c in range(100) for t in range(4)]
    rows += [(9000, t, "user", f"t{t % 50}") for t in range(880)]
    frame = spark.createDataFrame(rows, COLUMNS).repartition(7)
    assert rows_of(prefix_trie.prefix_trie(frame)) == nodes(sequences(rows))


def test_conversations_without_rows_nulls_and_repeats(spark):
    rows = [(None, 0, "user", "x"), (None, None, None, None), (-101, 1, "user", "a"), (-101, 1, "user", "a"), (3, None, None, None), (3, None, None, None),
            (100, 0, "user", "a"), (101, 0, "user", "a" * 100_000), (102, 0, "user", "b"), (103, 5, "b", "")]
    frame = spark.createDataFrame(rows, COLUMNS)
    assert rows_of(prefix_trie.rebuilt_trie(frame)) == nodes(rebuilt(sequences(rows)))
    assert rows_of(prefix_trie.prefix_trie(frame)) == nodes(sequences(rows))
    assert prefix_trie.rebuilt_trie(frame.limit(0)).count() == 0
    only = [r for r in rows if r[0] == 3]
    assert rows_of(prefix_trie.prefix_trie(frame.filter("conv_id = 3"))) == nodes(sequences(only))


def test_the_sketch_never_counts_too_few(spark):
    draw = np.random.default_rng(3)
    keys = draw.integers(-(1 << 62), 1 << 62, (4000, 2))
    keys = np.concatenate([keys, keys[:500], keys[:100]])
    frame = spark.createDataFrame([(int(a), int(b)) for a, b in keys], "k1 long, k2 long").repartition(6)
    counts = prefix_trie.sketch(frame, len(keys))
    guess = counts.estimate(keys[:4000, 0].view(U), keys[:4000, 1].view(U))
    assert (guess[:500] == 2).all() and (guess >= 1).all()
    assert (guess[500:] == 1).mean() > 0.9
    assert (prefix_trie.unpack(prefix_trie.pack(np.arange(8, dtype=np.uint8) % 3)) == np.arange(8) % 3).all()


def test_running_sums_and_places(spark):
    draw = random.Random(9)
    rows = [(draw.choice(["hot", "hot", f"g{i % 40}"]), i, draw.choice([1, -5, (1 << 62) + i])) for i in range(3000)]
    frame = spark.createDataFrame(rows, "g string, i long, x long").repartition(6)
    found = {r.i: (r.x_before, r.x_sum) for r in ordering.running_sums(frame, "g", [frame.i.asc()], ["x"]).collect()}
    wrap = lambda x: (x + (1 << 63)) % (1 << 64) - (1 << 63)
    sums = {}
    for g, i, x in sorted(rows, key=lambda r: r[1]):
        before = sums.get(g, 0)
        sums[g] = before + x
        assert found[i] == (wrap(before), wrap(before + x))
    order = [frame.x.desc(), frame.i.asc()]
    at = {r.i: r.place for r in places.numbered(clashing(frame), order, "place").collect()}
    assert [i for i, _ in sorted(at.items(), key=lambda p: p[1])] == [i for _, i, _ in sorted(rows, key=lambda r: (-r[2], r[1]))]
    assert sorted(at.values()) == list(range(1, 3001))
    assert places.numbered(frame.limit(0), order, "i").count() == 0
