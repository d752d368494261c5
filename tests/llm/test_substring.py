import random

import numpy as np
from helpers import LONG, awkward, clashing, documents

from suretygraph.llm import substring
from suretygraph.llm.recompression import recompress


def brute(rows, size):
    first = {}
    texts = {i: (t or "").split() for i, t in rows}
    for i in sorted(texts):
        for k in range(len(texts[i]) - size + 1):
            first.setdefault(tuple(texts[i][k : k + size]), i)
    out = {}
    for i, w in texts.items():
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone |= set(range(k, k + size))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def found(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in df.collect()}


def test_shared_parts_runs_and_periods(spark):
    draw = random.Random(5)
    word = lambda n: "".join(draw.choice("ab") for _ in range(draw.randint(1, 3)))
    parts = [" ".join(word(0) for _ in range(70)) for _ in range(4)] + ["x " * 120, "p q " * 60, "u v w " * 40]
    rows = []
    for i in range(40):
        text = " ".join(
            draw.choice(parts)[draw.randint(0, 9) :] if draw.random() < 0.5 else " ".join(word(0) for _ in range(draw.randint(0, 80)))
            for _ in range(3))
        rows.append((i, text))
    rows += [(40, "x " * 49), (41, "x " * 50), (42, "x " * 51 + "y"), (43, "q p " * 30), (44, rows[0][1])]
    docs = documents(spark, [(i, t, None, None, None) for i, t in rows])
    for size in (50, 12):
        assert found(substring.remove_repeats(docs, window=size)) == brute(rows, size)


def test_awkward_rows(spark):
    out = substring.remove_repeats(clashing(awkward(spark)))
    assert out.count() == 12
    rows = {(r.doc_id, r.n_words): r for r in out.collect()}
    assert rows[(4, 30_000)].n_removed == 0 and rows[(4, 30_000)].kept_text == LONG
    assert rows[(5, 30_001)].n_removed == 30_000 and rows[(5, 30_001)].kept_text == "end"
    assert rows[(None, 5)].n_removed == 0 and rows[(1, 0)].kept_text == ""
    assert rows[(6, 1)].name == "x"


def test_one_id_with_two_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    docs = documents(spark, [(1, b, None, None, None), (2, a, None, None, None), (2, b, None, None, None), (2, a, None, None, None)])
    assert sorted((r.doc_id, r.n_removed) for r in substring.remove_repeats(docs).collect()) == [(1, 0), (2, 0), (2, 0), (2, 60)]


def test_empty_table(spark):
    assert substring.remove_repeats(awkward(spark).limit(0)).count() == 0


def test_a_symbol_follows_from_its_context():
    draw = np.random.default_rng(1)
    middle = draw.integers(0, 6, 200).astype(np.uint64)
    seen = []
    for k in range(30):
        left, right = (draw.integers(0, 6, draw.integers(0, 40)).astype(np.uint64) for _ in range(2))
        words = np.concatenate([left, middle, right])
        s = recompress(words, np.array([0, len(words)]), 7, 12)
        lo, hi = len(left), len(left) + len(middle)
        within = (s.low >= lo) & (s.high <= hi)
        seen.append({(a - lo, b - lo, c - lo, d - lo, int(n)) for a, b, c, d, n in zip(s.start[within], s.end[within], s.low[within], s.high[within], s.name[within])})
    assert all(x == seen[0] for x in seen) and len(seen[0]) > 5
