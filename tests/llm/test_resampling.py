"""Importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from helpers import LONG, awkward, clashing, documents

from suretygraph.llm import resampling


def words(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def buckets(text, longest=2):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def plan(docs, target):
    s, t = Counter(b for _, x in docs for b in buckets(x)), Counter(b for x in target for b in buckets(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = {}
    for doc, text in docs:
        found = buckets(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out[doc] = len(words(text)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
    eligible = sorted((d for d in out if out[d][0] >= 20), key=lambda d: (-out[d][3], d is None, d or 0))
    ranks = {d: k + 1 for k, d in enumerate(eligible[: len(eligible) * 25 // 100])}
    return {d: (*v, ranks.get(d)) for d, v in out.items()}


@pytest.mark.parametrize("text", [
    "", " ", "one", "One, TWO--three\x00four", "é É ß'x ` { z 9:8 ", "a  b\n\n c", "x" * 300, "日本 語 x  y", "-a-", "a b a b a b", LONG,
])
def test_overlapped_scanning_gives_every_span_once(text):
    line = resampling.single_spaced(text.encode())
    assert line.decode() == " ".join(words(text))
    for n in (1, 2, 3):
        pattern = resampling.gram_pattern(n)
        w = words(text)
        assert [m.group().decode() for m in pattern.finditer(line, overlapped=True)] == [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)]


def test_weights_scores_and_ranks(spark):
    draw = random.Random(8)
    pool = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(draw.choice(pool[i % 3 * 40 : i % 3 * 40 + 80]) for _ in range(draw.randint(0, 60)))) for i in range(400)]
    docs += [(400, None), (401, ""), (402, LONG), (None, "null id " * 15)]
    target = [" ".join(draw.choice(pool[:50]) for _ in range(40)) for _ in range(20)] + [None, ""]
    frame = clashing(documents(spark, [(i, t, None, None, None) for i, t in docs])).repartition(6)
    goal = clashing(spark.createDataFrame([(t,) for t in target], "text string"))
    found = resampling.ranked(frame, goal)
    rows = {r.doc_id: (r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()}
    assert rows == plan(docs, target)
    near = [r for d, r in rows.items() if d is not None and d < 400 and d % 3 == 0 and r[0]]
    far = [r for d, r in rows.items() if d is not None and d < 400 and d % 3 == 2 and r[0]]
    assert sum(r[2] for r in near) / len(near) > sum(r[2] for r in far) / len(far) + 500
    drawn = resampling.resample(frame, goal)
    assert drawn.columns == frame.columns
    assert {r.doc_id for r in drawn.select("doc_id").collect()} == {d for d, r in rows.items() if r[4]}


def test_resampling_of_awkward_rows(spark):
    docs = clashing(awkward(spark))
    goal = spark.createDataFrame([("some words",)], "text string")
    found = resampling.ranked(docs, goal)
    assert found.count() == 12
    assert found.filter("n_features = 0 and weight <> 0").isEmpty()
    assert resampling.ranked(docs.limit(0), goal).count() == 0
    assert resampling.ranked(docs, goal.limit(0)).count() == 12
    with pytest.raises(ValueError):
        resampling.features(docs, buckets=1 << 20)
