"""Learnt operators: language field, toxicity weights, URL models."""

import itertools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import awkward, clashing, documents

from suretygraph.llm import crf, toxicity, url_filter
from suretygraph.llm.tokens import ALNUM, FOLDED, words


def test_forward_backward_is_the_sum_over_all_labellings():
    draw = np.random.default_rng(4)
    emission, transition = draw.normal(size=(7, 3)), draw.normal(size=(3, 3))
    first = np.array([0, 4, 4, 5, 7])
    marginal, alpha, beta, e, starts = crf.chain(emission, first, transition, block=3)
    wanted, pairs = np.zeros_like(emission), np.zeros((3, 3))
    for a, b in zip(first[:-1], first[1:]):
        total, own, two = 0.0, np.zeros((b - a, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=b - a) if b > a else []:
            weight = math.exp(sum(emission[a + i, y] for i, y in enumerate(path)) + sum(transition[x, y] for x, y in zip(path, path[1:])))
            total += weight
            for i, y in enumerate(path):
                own[i, y] += weight
            for x, y in zip(path, path[1:]):
                two[x, y] += weight
        if b > a:
            wanted[a:b], pairs = own / total, pairs + two / total
    assert np.allclose(marginal, wanted)
    assert np.allclose(crf.transition_marginals(alpha, beta, e, starts, transition), pairs)


def _languages(spark, n=60):
    draw = np.random.default_rng(7)
    sets = {"en": ["the", "thing", "with", "other"], "de": ["der", "schon", "nicht", "ungen"], "fr": ["le", "eaux", "quoi", "etre"]}
    rows = []
    for i in range(n):
        lang = list(sets)[i % 3]
        rows.append((i, " ".join(draw.choice(sets[lang], 30)), lang, "s", 1))
    return documents(spark, rows), sets


def test_language_of_held_out_and_switched_texts(spark):
    docs, sets = _languages(spark)
    field = crf.fit(docs)
    out = crf.predict(docs, field)
    assert out.filter("lang <> lang_pred").isEmpty()
    switched = " ".join(sets["en"] * 5 + sets["de"] * 5)
    w = next(words(pa.array([switched]), FOLDED))
    best = field.marginals(w)[1].argmax(axis=1)
    assert [field.languages[k] for k in best] == ["en"] * 20 + ["de"] * 20


def _positions(text):
    """Words cut as told: every ``LONGEST`` bytes, back to the first byte of a character."""
    out = []
    for word in text.encode().split():
        cuts = [0]
        for at in range(crf.LONGEST, len(word), crf.LONGEST):
            while word[at] & 0xC0 == 0x80:
                at -= 1
            cuts.append(at)
        out += [(word, a, b) for a, b in zip(cuts, [*cuts[1:], len(word)])]
    return out


def _features(word, begin, end):
    """Numbers of the n-grams that begin in a part of a word, and of its affixes if they do."""
    word, found = word.lower(), Counter()
    for n in (1, 2, 3):
        for at in range(begin, min(end, len(word) - n + 1)):
            gram = n
            for byte in word[at : at + n]:
                gram = (gram * 257 + byte + 1) % (1 << 64)
            for kind, holds in ((0, True), (1, at == 0), (2, at + n == len(word))):
                if holds:
                    found[int(crf.mix(np.array([(gram * 3 + kind) % (1 << 64)], np.uint64))[0]) % (1 << crf.FEATURE_BITS)] += 1
    return found


def test_features_of_whole_words():
    texts = ["The thing", "", "x", "a" * 64 + "z" * 16, "é" * 100 + "ß", "日本語" * 60 + " word " + "q" * 48, "w" * 49, "a" * 47 + "é" + "b" * 5, None]
    found = list(words(pa.array(texts), FOLDED))
    assert len(found) == 1
    w = found[0]
    p = crf.positions(w)
    wanted = [x for t in texts for x in _positions(t or "")]
    assert [bytes(w.buffer[a:b]) for a, b in zip(p.starts, p.ends)] == [word[a:b] for word, a, b in wanted]
    assert np.diff(p.first).tolist() == [len(_positions(t or "")) for t in texts]
    names, owner = crf.character_features(w, p, np.arange(len(p.word)))
    for k, (word, a, b) in enumerate(wanted):
        assert Counter(names[owner == k].tolist()) == _features(word, a, b)


def test_a_long_word_is_read_to_its_end(spark):
    docs, sets = _languages(spark)
    field = crf.fit(docs)
    run = lambda lang: "".join(sets[lang] * 30)
    w = next(words(pa.array([run("fr")[:100] + run("en"), run("de"), run("en") + run("de")]), FOLDED))
    p, marginal = field.marginals(w)
    best = [field.languages[k] for k in marginal.argmax(axis=1)]
    first, second, third = (best[a:b] for a, b in zip(p.first[:-1], p.first[1:]))
    assert first.count("en") > 0.7 * len(first) > 5 and second.count("de") > 0.8 * len(second)
    half = len(third) // 2
    assert third[: half - 1].count("en") > 0.7 * half and third[half + 1 :].count("de") > 0.7 * half
    labelled = crf.predict(documents(spark, [(0, run("fr")[:100] + run("en") * 3, None, None, None)]), field).first()
    assert labelled.lang_pred == "en"


def test_the_lexicon_counts_every_word(spark):
    draw = np.random.default_rng(3)
    rows = [(int(draw.integers(0, 2)), " ".join(f"W{x}" for x in draw.zipf(1.3, 50) % 500)) for _ in range(40)]
    frame = spark.createDataFrame(rows, "language int, text string").repartition(3)
    counts = Counter((language, word.lower()) for language, text in rows for word in text.split())
    names = sorted({word for _, word in counts})
    hashes = next(words(pa.array(names), FOLDED)).hashes
    in_all = [sum(n for (j, _), n in counts.items() if j == k) for k in (0, 1)]
    for most in (10_000, 60, 3):
        totals = Counter()
        for (_, word), n in counts.items():
            totals[word] += n
        least = min((c for c in set(totals.values()) if sum(n >= c for n in totals.values()) <= most), default=None)
        found = crf.lexicon(frame, 2, most).of(hashes)
        for word, row in zip(names, found):
            if least is None or totals[word] < least:
                assert not row.any()
            else:
                rates = np.array([counts[(k, word)] / in_all[k] * 1e6 + 0.05 for k in (0, 1)])
                assert np.allclose(row, np.log(rates / rates.sum()), atol=1e-5)
    assert not crf.lexicon(frame.limit(0), 2).of(hashes).any()


def test_language_of_awkward_rows(spark):
    docs, _ = _languages(spark)
    rows = crf.predict(clashing(awkward(spark)), crf.fit(docs.union(awkward(spark)))).collect()
    assert len(rows) == 12
    for r in rows:
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0)
    empty = docs.limit(0)
    assert crf.fit(empty) is None
    assert {r.lang_pred for r in crf.predict(docs, None).collect()} == {"und"}
    assert crf.predict(empty, None).count() == 0
    assert crf.predict(empty, crf.fit(docs)).count() == 0


def test_toxic_words_are_learnt(spark):
    draw = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(400):
        text = list(draw.choice([f"w{k}" for k in range(80)], 40))
        if i % 4 == 0:
            text[int(draw.integers(40))] = str(draw.choice(["Vile,", "nasty"]))
        rows.append((i, " ".join(text), None, None, None))
        labels.append((i, int(i % 4 == 0)))
    docs = documents(spark, rows)
    table = spark.createDataFrame(labels + [(7, None), (None, 1)], "doc_id long, toxic int")
    weights = toxicity.fit(docs, table)
    out = toxicity.score(docs, weights).collect()
    assert all((r.score >= 0.7) == (r.doc_id % 4 == 0) for r in out)
    assert len(weights.names) < 40
    kept = toxicity.drop_toxic(docs, weights)
    assert kept.columns == docs.columns and kept.count() == 300


def test_scores_are_those_of_the_features():
    draw = np.random.default_rng(3)
    texts = [" ".join(draw.choice(list("abcd"), n)) for n in (0, 1, 2, 3, 9, 30)]
    w = next(words(pa.array(texts), ALNUM))
    names, _ = toxicity.features(w.hashes, w.first)
    names = np.unique(names)[::2]
    model = toxicity.Weights(names, draw.normal(size=len(names)), -0.3)
    weight = dict(zip(names.tolist(), model.values))
    for text, score in zip(texts, model.scores(w.hashes, w.first)):
        own = next(words(pa.array([text]), ALNUM)) if text else None
        present = set(toxicity.features(own.hashes, own.first)[0].tolist()) if own else set()
        assert math.isclose(score, 1 / (1 + math.exp(0.3 - sum(weight.get(x, 0) for x in present))))


def test_ftrl_against_one_coordinate_at_a_time():
    draw = np.random.default_rng(6)
    lists = [np.unique(draw.integers(0, 12, 5)) for _ in range(40)]
    labels = np.array([int(3 in x or 7 in x) for x in lists])
    alpha, beta, l1, l2 = 0.5, 1.0, 1.5, 0.1
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for epoch in range(4):
        for t in np.random.default_rng(epoch).permutation(len(lists)):
            own = [*lists[t].tolist(), "intercept"]
            w = {i: weight(i) for i in own}
            gradient = 1 / (1 + math.exp(-sum(w.values()))) - labels[t]
            for i in own:
                z[i] += gradient - (math.sqrt(n[i] + gradient**2) - math.sqrt(n[i])) / alpha * w[i]
                n[i] += gradient**2
    values, intercept = toxicity.ftrl(lists, labels, 12, 4, alpha, beta, l1, l2)
    assert np.allclose(values, [weight(i) for i in range(12)]) and math.isclose(intercept, weight("intercept"))
    assert 0 < (values == 0).sum() < 12 and values[3] > 0 < values[7]


def test_toxicity_of_awkward_rows(spark):
    docs = clashing(awkward(spark))
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (6, 1), (9, 1)], "doc_id long, toxic int")
    for table in (labels, labels.limit(0), labels.filter("toxic = 0")):
        rows = toxicity.score(docs, toxicity.fit(docs, table)).collect()
        assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


def test_url_models_against_counting_one_by_one(spark):
    accepted, rejected = ["a.org/fr/1", "b.org/fr/22", "a.org/fr/3"], ["x.net/q", "xx.net/qq/7"]
    judged = spark.createDataFrame([(side, t) for side, texts in ((False, rejected), (True, accepted)) for t in texts], "accepted boolean, text string")
    models = url_filter._keyed(url_filter.counted(judged.repartition(3)).toArrow())
    probability = []
    for texts in (rejected, accepted):
        counts, kinds = Counter(), {}
        for text in texts:
            padded = "\0" * url_filter.ORDER + text + "\1"
            for i in range(url_filter.ORDER, len(padded)):
                for k in range(url_filter.ORDER + 1):
                    counts[padded[i - k : i], padded[i]] += 1
                    kinds.setdefault(padded[i - k : i], Counter())[padded[i]] += 1

        def log_p(text, counts=counts, kinds=kinds):
            padded, total = "\0" * url_filter.ORDER + text + "\1", 0.0
            for i in range(url_filter.ORDER, len(padded)):
                p = 1 / 257
                for k in range(url_filter.ORDER + 1):
                    after = kinds.get(padded[i - k : i])
                    if after:
                        p = (counts[padded[i - k : i], padded[i]] + len(after) * p) / (sum(after.values()) + len(after))
                total += math.log(p)
            return total

        probability.append(log_p)
    texts = ["a.org/fr/9", "x.net/q", "", "zzz.com/de/1", "b.org/en"]
    wanted = [(probability[1](t) - probability[0](t)) / (len(t) + 1) for t in texts]
    assert np.allclose(models.difference(pa.array(texts)), wanted)


RULES = (url_filter.Rule("block", "net/"), url_filter.Rule("allow", "example.net/en/"))


def test_urls_without_a_rule_follow_the_models(spark):
    rows = []
    for i in range(300):
        rows.append((i, f"http://host{i % 7}.example.net/en/page/{i}" if i % 2 else f"HTTP://Ads{i % 5}.NET/track?click={i}"))
    rows += [(1000, "http://host3.example.com/en/page/17"), (1001, "http://ads2.com/track")]
    rows += [(1002, None), (1003, "nothing"), (1004, ""), (None, "http://ads1.net/track"), (1005, "x://NET"), (1006, "a://b://c/d#e")]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string"))
    out = {r.page_id: r for r in url_filter.judge_urls(pages, RULES).collect()}
    assert out[1000].verdict == "allow" and out[1001].verdict == "block" and out[1000].rule is None
    assert all(out[i].verdict == ("allow" if i % 2 else "block") for i in range(300))
    assert [(out[i].host, out[i].path, out[i].rule) for i in (1002, 1003, 1004)] == [("", "", None)] * 3
    assert out[1002].verdict == out[1004].verdict  # null is the empty text
    assert out[None].rule == "net/" and out[1005].host == "net" and out[1005].rule is None
    assert (out[1006].host, out[1006].path) == ("b:", "//c/d")
    none = url_filter.judge_urls(pages, ())
    assert {r.verdict for r in none.collect()} == {"allow"}
    assert url_filter.judge_urls(pages.limit(0), RULES).count() == 0


def test_url_counts_are_kept_under_whole_hashes(spark, monkeypatch):
    draw = np.random.default_rng(9)
    word = lambda: "".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz0123456789"), 8))
    rows = [(i, f"http://{word()}.{'example.net/en/' if i % 2 else 'other.net/'}{word()}") for i in range(300)]
    rows += [(1000 + i, f"http://{word()}.com/{word()}") for i in range(50)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    verdicts = lambda **options: {
        r.page_id: (r.verdict, round(r.accept, 9)) for r in url_filter.judge_urls(pages, RULES, **options).collect()}
    out = verdicts()
    monkeypatch.setattr(url_filter, "BLOCK", 16)
    assert verdicts(most_keys=0) == out  # looked up by a join


def test_url_models_read_query_fragment_and_urls_without_a_scheme(spark):
    rows = [(i, f"http://h{i % 7}.example.net/en/?good={i}" if i % 2 else f"http://h{i % 7}.b.net/en/?casino={i}") for i in range(300)]
    rows += [(1000, "http://h3.c.com/en/?good=5"), (1001, "http://h3.c.com/en/?casino=5"), (1002, "casino=casino=8"), (1003, None)]
    out = {r.page_id: r for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), RULES).collect()}
    assert (out[1000].verdict, out[1001].verdict) == ("allow", "block")
    assert (out[1002].host, out[1002].path, out[1002].verdict) == ("", "", "block") and out[1003].rule is None
