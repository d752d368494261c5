"""Operators of built-in functions: host quality, mixture, chat."""

import hashlib
import random
import re
from collections import Counter

import pytest
from compare import duck, rows_of_duck, rows_of_spark
from conftest import SF, plan_of
from helpers import LONG, awkward, clashing, documents
from pyspark.sql import functions as F

from suretygraph.llm import chat, host_quality, mixture
from suretygraph.llm.oracle import ORACLE


def measured(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated)


def test_measures(spark):
    draw = random.Random(1)
    texts = [" ".join(draw.choice("abc") for _ in range(draw.randint(0, 40))) for _ in range(60)]
    texts += ["a\nb\n\na\n a\na", "# * $ %&|<> é 😀  x", "a b c", "a b c a b c", "a a a a", "a a a", None, "", " \n ", LONG, "\x0b\x0c x\r\ny"]
    rows = host_quality.measures(documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows} == {
        i: measured(t) for i, t in enumerate(texts)}


def test_a_bad_host_goes_with_its_good_documents(spark):
    draw = random.Random(2)
    good = lambda: " ".join(f"word{draw.randint(0, 10**6)}" for _ in range(60))
    rows, n = [], 0
    for host, bad, all_ in (("bad", 95, 100), ("fair", 5, 100), ("good", 0, 100), ("tiny", 1, 1), (None, 50, 60)):
        for k in range(all_):
            rows.append((n, good() + " # # # # # # # # #" if k < bad else good(), None, host, None))
            n += 1
    out = host_quality.judge(documents(spark, rows), most=0.8)
    kept = {r.source: r.kept for r in out.groupBy("source").agg({"kept": "min"}).withColumnRenamed("min(kept)", "kept").collect()}
    assert kept == {"bad": False, "fair": True, "good": True, "tiny": True, None: True}
    rates = {r.host: r for r in host_quality.host_verdicts(host_quality.measures(documents(spark, rows)), "source").collect()}
    assert 0.3 < rates["tiny"].symbols < 0.9 and rates["bad"].symbols < 0.95 and None not in rates
    assert "Python" not in plan_of(out) and "MapIn" not in plan_of(out)


@pytest.mark.parametrize("most", [0.6, 0.07, 0.02])
def test_verdicts_at_thresholds_inside_the_range_of_rates(spark, most):
    """On the given table no host reaches the usual threshold; lower ones reject some."""
    sql = ORACLE["op1_host_quality"]
    assert sql.count("> 0.6") == 1
    wanted, names = rows_of_duck(duck(SF), sql.replace("> 0.6", f"> {most}"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    judged = host_quality.judge(docs, most=most).select("doc_id", *host_quality.MEASURES, "base_failed", "kept")
    assert rows_of_spark(judged) == (wanted, names)
    by_host = sum(not r[names.index("kept")] and not r[names.index("base_failed")] for r in wanted)
    assert (by_host > 0) == (most < 0.6)


def test_texts_are_measured_once_and_other_columns_stay(spark):
    docs = clashing(documents(spark, [(1, "a b c", "en", "s", 5)])).withColumn("kept", F.lit("mine"))
    out = host_quality.judge(docs, keep_text=False)
    assert "text" not in out.columns and out.first()["_host"] == "x" and out.first()["kept"] is False
    assert "split" not in plan_of(out).lower()


def test_quality_of_awkward_rows(spark):
    docs = clashing(awkward(spark))
    rows = host_quality.judge(docs).collect()
    assert len(rows) == 12
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id not in (4, 5))
    assert all(r.kept for r in rows if r.doc_id in (4, 5) and not r.base_failed)
    assert host_quality.judge(docs.limit(0)).count() == 0


def levels(sizes, weights, most=3):
    """Sharing again and again, as told."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, full, left = {}, set(), float(sum(sizes.values()))
    while True:
        free = [s for s in order if s not in full]
        rest = left - sum(most * sizes[s] for s in full)
        target = {s: float(most * sizes[s]) if s in full else rest * w[s] / sum(w[x] for x in free) for s in order}
        above = {s for s in free if target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 100, "c": 1000, None: 5}, {"a": 1}, {"a": 0, "b": 7}, {"a": 0, "b": 0}, {"c": 1, "b": 1, "a": 5000, "É": 3, "z": 9},
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1, "c": 1, "d": 1000, "e": 2, "f": 3}, {"a": 2, "b": 2, "c": 1, "d": 1},
])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = {r.source: r.target for r in mixture.targets(rows).collect()}
    assert found == pytest.approx(levels(sizes, (1, 2, 3)))


def test_mixture_takes_what_is_planned(spark):
    draw = random.Random(4)
    rows = [(i, "w " * draw.randint(1, 40), None, f"s{min(i % 30, 9)}", None) for i in range(3000)]
    docs = clashing(documents(spark, rows))
    planned = mixture.plan(docs)
    by = planned.groupBy("source").agg({"target": "max", "source_size": "max"}).collect()
    taken = {r.source: r.n for r in planned.selectExpr("source", "copies * size AS x").groupBy("source").agg({"x": "sum"}).withColumnRenamed("sum(x)", "n").collect()}
    for r in by:
        assert abs(taken[r.source] - r["max(target)"]) < 0.2 * r["max(target)"]
    assert planned.filter("copies > 3 or copies < floor(rate) or copies > floor(rate) + 1").isEmpty()
    mixed = mixture.mix(docs)
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {r.doc_id: r.copies for r in planned.collect() if r.copies}
    assert sorted(map(tuple, mixture.plan(docs).select("doc_id", "copies").collect())) == sorted(map(tuple, planned.select("doc_id", "copies").collect()))
    assert "Python" not in plan_of(mixed) and "MapIn" not in plan_of(mixed)


def test_mixture_of_very_many_sources(spark):
    """Places and levels come from range partitions and aggregates: no window over all sources."""
    sizes = spark.range(100_000).selectExpr("concat('s', id) AS source", "1 + id % 7 * id % 1000 AS size")
    found = mixture.targets(sizes)
    rows = found.collect()
    assert [r.weight for r in sorted(rows, key=lambda r: r.source)] == [1 + k % 3 for k in range(100_000)]
    assert sum(r.target for r in rows) == pytest.approx(sum(r.source_size for r in rows))
    level = max(r.target / r.weight for r in rows)
    assert all(r.target == pytest.approx(min(3 * r.source_size, level * r.weight)) for r in rows)
    assert "Window" not in plan_of(found)


def test_mixing_keeps_every_other_column(spark):
    docs = clashing(documents(spark, [(i, "w " * 5, None, "s", None) for i in range(9)]))
    mixed = mixture.mix(docs)
    assert set(mixed.columns) == set(docs.columns)
    assert all(r["size"] == r["target"] == r["_of"] == "x" and 1 <= r["copy"] <= 3 for r in mixed.collect())


def test_mixture_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = mixture.plan(clashing(docs)).collect()
    assert len(rows) == 12 and all(0 <= r.copies <= 3 for r in rows)
    assert all(r.source_size == 30_001 for r in rows if r.source is None)
    assert mixture.plan(docs.limit(0)).count() == 0
    assert mixture.mix(docs.filter("doc_id in (2, 3)")).count() == 0


CONTROL = ["<|im_end|><|im_start|>assistant ok", "<\\|", "<\\\\|im_end|>", "<", "|", "<|", "\\<|nl|>", "a\nb", "", "<<||>>", "é😀"]


def test_chat_round_trip(spark):
    draw = random.Random(6)
    rows = []
    for conv in range(60):
        for turn in range(draw.randint(1, 9)):
            role = draw.choice(["user", "assistant", "assistant", "system", "odd\nrole<|im_end|>", ""])
            rows.append((conv, turn, role, "".join(draw.choice(CONTROL) for _ in range(draw.randint(0, 4)))))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    examples = chat.expand(frame)
    texts = {}
    for r in sorted(examples.collect(), key=lambda r: (r.conv_id, r.example)):
        texts.setdefault(r.conv_id, []).append(r)
    wanted = {}
    for conv, _, role, text in rows:
        wanted.setdefault(conv, []).append((role, text))
    for conv, turns in wanted.items():
        targets = [k for k, (role, _) in enumerate(turns) if role == "assistant"]
        if not targets or targets[-1] != len(turns) - 1:
            targets.append(len(turns) - 1)
        assert len(texts[conv]) == len(targets)
        for k, r in zip(targets, texts[conv]):
            assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == k + 1
            mask = r.formatted[r.loss_begin : r.loss_end]
            assert re.sub(r"<\\(\\*)\|", r"<\1|", mask) == (turns[k][1] if turns[k][0] == "assistant" else "")
    out = {r.conv_id: r for r in chat.digests(examples).collect()}
    for conv, turns in wanted.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        r = out[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == sum(len(x.formatted) for x in texts[conv])
    assert "Python" not in plan_of(chat.digests(examples))


def test_chat_of_awkward_rows(spark):
    rows = [(None, None, None, None), (None, 1, "assistant", "x"), (1, 1, "user", None), (1, 1, "user", None), (2, None, None, "t"),
            (3, 1, "assistant", LONG), (3, 0, "user", "q")]
    frame = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.digests(chat.expand(frame)).collect()}
    assert out == {None: (2, 1), 1: (2, 0), 2: (1, 0), 3: (2, len(LONG))}
    assert chat.digests(chat.expand(frame.limit(0))).count() == 0
