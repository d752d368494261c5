"""A run of the whole pipeline against plain Python, stage by stage, on documents with cases put in."""

import math
import random
from collections import Counter, defaultdict

import pandas as pd
import pyarrow as pa
import pytest
from conftest import SF
from helpers import awkward, clashing
from test_decontamination import words as item_words
from test_minhash import brute as near_copies
from test_native import levels
from test_substring import brute as cut

import corpus_pipeline as pipeline
from suretygraph.llm import toxicity
from suretygraph.llm.tokens import ALNUM, words

FIRST = 1_000_000


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """The given tables; beside the given documents, ones that each stage has to act on."""
    path = tmp_path_factory.mktemp("pipeline")
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    items = pd.read_parquet(f"{SF}/benchmark.parquet")
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    draw = random.Random(5)

    def fresh(n):
        return [f"{draw.choice('abcdefgh')}{draw.randrange(10_000)}" for _ in range(n)]

    texts = []
    for _ in range(6):  # near copies, one word of 200 changed
        text = fresh(200)
        texts += [text, text, text[:100] + ["other"] + text[101:]]
    passage = fresh(80)
    for _ in range(6):
        texts.append(fresh(90) + passage + fresh(90))
    for text in items["text"][:5]:
        texts.append(fresh(20) + text.split() + fresh(20))
    toxic = [fresh(30) + ["vilest"] + fresh(30) for _ in range(60)]
    texts += toxic
    ids = [FIRST + i for i in range(len(texts))]
    added = pd.DataFrame({
        "doc_id": ids, "text": [" ".join(t) for t in texts], "lang": "en",
        "source": [draw.choice(["src0", "src1", "one more", None]) for _ in ids], "n_chars": [len(" ".join(t)) for t in texts]})
    odd = pd.DataFrame({
        "doc_id": [1, 2], "text": [None, ""], "lang": [None, "en"], "source": [None, "src2"], "n_chars": [0, 0]})
    odd["doc_id"] += 2 * FIRST
    marked = pd.DataFrame({"doc_id": ids, "quality": 1, "toxic": [0] * (len(texts) - len(toxic)) + [1] * len(toxic)})
    pd.concat([docs, added, odd]).astype({"doc_id": "int64", "n_chars": "int64"}).to_parquet(path / "documents.parquet", index=False)
    pd.concat([labels, marked]).astype(labels.dtypes.to_dict()).to_parquet(path / "labels.parquet", index=False)
    items.to_parquet(path / "benchmark.parquet", index=False)
    return str(path)


def toxic(weights, text):
    weight = dict(zip(weights.names.tolist(), weights.values))
    own = next(words(pa.array([text]), ALNUM)) if text else None
    present = set(toxicity.features(own.hashes, own.first)[0].tolist()) if own else set()
    return 1 / (1 + math.exp(-weights.intercept - sum(weight.get(x, 0) for x in present))) >= 0.7


def contaminated(items, text, size=13):
    windows = defaultdict(set)
    for item in items:
        v = item_words(item)
        n = min(size, len(v))
        for k in range(len(v) - n + 1 if n else 0):
            windows[n].add(tuple(v[k : k + n]))
    w, hit = item_words(text), set()
    for n, known in windows.items():
        for k in range(len(w) - n + 1):
            if tuple(w[k : k + n]) in known:
                hit |= set(range(k, k + n))
    return bool(hit) and 20 * len(hit) >= len(w)


def test_run(spark, folder):
    given = spark.read.parquet(f"{folder}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    weights = toxicity.fit(given, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = {r.doc_id: r.asDict() for r in given.collect()}
    left = [len(rows)]

    rows = {i: r for i, r in rows.items() if not toxic(weights, r["text"])}
    left.append(len(rows))
    groups = near_copies([(i, r["text"]) for i, r in rows.items()], 5, 80)
    rows = {i: r for i, r in rows.items() if groups[i][1] == i}
    left.append(len(rows))
    shorter = 0
    for i, (_, gone, text) in cut([(i, r["text"]) for i, r in rows.items()], 50).items():
        if gone:
            shorter += 1
            rows[i] |= {"text": text, "n_chars": len(text)}
    rows = {i: r for i, r in rows.items() if not contaminated(items, r["text"])}
    left.append(len(rows))
    assert left[0] - left[1] >= 50 and left[1] - left[2] >= 12 and shorter >= 5 and left[2] - left[3] >= 5

    size = {i: len((r["text"] or "").split()) for i, r in rows.items()}
    of_source = Counter()
    for i, r in rows.items():
        of_source[r["source"]] += size[i]
    target = levels(of_source, (1, 2, 3))
    found = defaultdict(list)
    for r in pipeline.run(spark, folder).collect():
        row = r.asDict()
        found[r.doc_id].append(row.pop("copy"))
        assert row == rows[r.doc_id]
    for i, r in rows.items():
        rate = target[r["source"]] / of_source[r["source"]] if of_source[r["source"]] else 0
        assert sorted(found[i]) == list(range(1, len(found[i]) + 1))
        assert math.floor(rate - 1e-9) <= len(found[i]) <= math.floor(rate + 1e-9) + 1


def test_columns_named_as_the_operators_own_stay(spark, folder):
    """Every stage over rows with more columns, nulls in any of them, and no rows at all."""
    docs = clashing(awkward(spark))
    mine = [c for c in docs.columns if c not in awkward(spark).columns]
    for _, stage in pipeline.STAGES:
        out = stage(spark, docs, folder)
        last = stage is pipeline.mix_sources
        assert out.columns == docs.columns or last and set(out.columns) == set(docs.columns) | {"copy"}
        for row in out.collect():
            assert all(row[c] == "x" for c in mine if not (last and c == "copy"))
        assert stage(spark, docs.limit(0), folder).count() == 0
    cut = pipeline.remove_passages(spark, docs, folder).filter("doc_id = 5").first()
    assert cut.text == "end" and cut.n_chars == 3 and cut.kept_text == "x"
