"""Secret scans against a count of every window."""

import random
import re

from conftest import plan_of
from helpers import LONG, awkward, clashing, documents
from pyspark.sql import functions as F

from suretygraph.llm import secrets as scan

TOKEN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"


def entropy_spans(text):
    for kind, c in enumerate(scan.CLASSES, len(scan.BASE)):
        for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text):
            if any(re.search(a, m.group()) for a in scan.ALLOWED):
                continue
            ranges = []
            for i in range(len(m.group()) - c.width + 1):
                w = m.group()[i : i + c.width]
                total = sum(scan.n_log_n(c.width)[w.count(x)] for x in set(w))
                if set(w) <= set(c.characters) and 0 < sum(x.isdigit() for x in w) < c.width and total <= scan.largest_sum(c):
                    if ranges and i <= ranges[-1][1]:
                        ranges[-1][1] = i + c.width
                    else:
                        ranges.append([i, i + c.width])
            yield from ((m.start() + a, kind, m.start() + b) for a, b in ranges)


def spans(text):
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in re.finditer(scan.ASSIGN, text) if len(m.group(1)) >= 8]
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
        base += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m.group()) >= least]
    more = [x for x in entropy_spans(text) if not any(b[0] <= x[0] and x[2] <= b[2] for b in base)]
    kinds = [*scan.BASE, *(c.name for c in scan.CLASSES)]
    return [(kinds[k], a, b) for a, k, b in sorted(base + more)]


def test_spans_of_mixed_texts(spark):
    draw = random.Random(5)
    texts = [
        None, "", "password=hunter2abc", "é😀 token: 'abcdefgh' x", "AKIA" + "A1" * 8 + ' api_key="short" API-KEY apikey==abcdefghij',
        "04dbebab91ab85687d33eeaaf9ac699e1188f962", "token=secret: abcdefghij", "PassWD\"  :\"abc.def-gh", "ſecret=abcdefghij toKen=12345678",
        "x " * 400 + "deadbeefdeadbeefdeadbeefdeadbeef" * 3, LONG, "AKIAAKIA" * 3, "secret=" * 5 + "abc",
    ]
    for _ in range(60):
        glue = lambda: draw.choice([" ", "é ", "\n", "token=", "secret : ", "AKIA", "", "😀"])
        pool = lambda: TOKEN[: draw.choice([62, 67, 10])] if draw.random() < 0.8 else "0123456789abcdef"
        texts.append("".join(glue() + "".join(draw.choice(pool()) for _ in range(draw.randint(1, 70))) for _ in range(draw.randint(1, 6))))
    # Runs of several pieces, many matches in a text.
    texts += ["".join(draw.choice(TOKEN) for _ in range(9000)), "".join(draw.choice("0123456789abcdefABCDEF") for _ in range(9000)),
              " ".join("".join(draw.choice("0123456789abcdef") for _ in range(40)) for _ in range(700))]
    docs = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    found = scan.find_secrets(docs)
    rows = {r.doc_id: [tuple(x) for x in r.spans] for r in found.collect()}
    assert rows == {i: spans(t) for i, t in enumerate(texts)}
    assert sum(map(len, rows.values())) > 900
    assert {k for v in rows.values() for k, _, _ in v} == {*scan.BASE, *(c.name for c in scan.CLASSES)}
    assert "Python" not in plan_of(found) and "Exchange" not in plan_of(found)


def test_each_pattern_searches_a_text_once(spark):
    """Three patterns and the candidates search texts, each class the candidates; no search is written twice into the plan."""
    plan = plan_of(scan.find_secrets(documents(spark, [(1, "x", None, None, None)])))
    assert plan.count("regexp_extract_all(") == plan.count("split(") - len(scan.CLASSES) == len(scan.BASE) + 1 + len(scan.CLASSES)


def test_spelled_patterns_match_the_same():
    assert scan.spelled("[a-c9_=-]{2,}") == "[abc9_=-]{2,}"
    every = "".join(map(chr, range(1, 0x250)))
    for c in (scan.CANDIDATE, scan.HEX.partition("{")[0]):
        assert re.findall(scan.spelled(c), every) == re.findall(c, every) != []


def test_the_allow_list(spark):
    draw = random.Random(3)
    mixed = lambda n: "".join(draw.choice(TOKEN[:62]) for _ in range(n)) + "a1"
    texts = ["550e8400-e29b-41d4-a716-446655440000", "sha512-" + mixed(86), mixed(20) + "EXAMPLE", "abcdefghijklmnopqrstuvwxyz0123456789", mixed(40),
             "incomprehensibilities", "/2024/01/some-long-title-of-a-page/index"]
    docs = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    with_list = {r.doc_id for r in scan.find_secrets(docs).filter("size(spans) > 0").collect()}
    without = {r.doc_id for r in scan.find_secrets(docs, allowed=()).filter("size(spans) > 0").collect()}
    assert with_list == {4} and without >= {1, 2, 3, 4} and not without & {5, 6}


def test_secrets_of_awkward_rows(spark):
    docs = clashing(awkward(spark)).withColumns({"spans": F.lit("x"), "_own": F.lit("x"), "_text": F.lit("x"), "_k0": F.lit("x")})
    found = scan.find_secrets(docs)
    assert found.count() == 12 and set(found.columns) == set(docs.columns)
    assert found.filter("size(spans) > 0").isEmpty()
    assert scan.digests(found).filter("n_assign + n_access + n_hex > 0").isEmpty()
    assert scan.find_secrets(docs.limit(0)).count() == 0

