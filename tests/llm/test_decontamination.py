import random
import re

from helpers import awkward, clashing, documents

from suretygraph.llm import decontamination


def words(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows, items, size):
    out = {}
    for i, text in rows:
        w, hit, ids = words(text), set(), set()
        for item, item_text in items:
            v = words(item_text)
            n = min(size, len(v))
            for k in range(len(v) - n + 1 if n else 0):
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == v[k : k + n]:
                        hit |= set(range(j, j + n))
                        ids.add(item)
        out[i] = (len(w), len(hit), sorted(str(x) for x in ids), bool(hit) and 20 * len(hit) >= len(w))
    return out


def found(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in df.collect()}


def test_windows_of_items(spark):
    draw = random.Random(9)
    items = [(k, " ".join(draw.choice("abcde") * draw.randint(1, 2) for _ in range(draw.randint(1, 30)))) for k in range(12)]
    items += [(12, "Ä-ö ü"), (13, None), (14, "?!"), (15, "a"), (16, items[0][1]), (16, items[0][1])]
    rows = []
    for i in range(40):
        text = " ".join(draw.choice("abcdef") for _ in range(draw.randint(0, 60)))
        if i % 2:
            text = text + " " + draw.choice(items)[1].upper() if draw.random() < 0.8 and draw.choice(items)[1] else (draw.choice(items)[1] or "") + ". " + text
        rows.append((i, text))
    rows += [(40, "ä ö ü"), (41, None), (42, "Ä ö,Ü")]
    docs = documents(spark, [(i, t, None, None, None) for i, t in rows])
    table = spark.createDataFrame(items, "item_id long, text string")
    for chosen, size in ((table, 13), (table.filter("item_id <> 15"), 13), (table.filter("item_id <> 15"), 4)):
        own = [(r.item_id, r.text) for r in chosen.collect()]
        assert found(decontamination.contamination(docs, chosen, window=size)) == brute(rows, own, size)


def test_awkward_rows_and_items(spark):
    docs = clashing(awkward(spark))
    items = clashing(spark.createDataFrame([(None, "second text"), (1, None), (2, "nothing of this"), (2, "w3 w4 w5")], "item_id long, text string"))
    rows = decontamination.contamination(docs, items).collect()
    assert len(rows) == 12
    assert {(r.doc_id, r.n_hit, tuple(r.item_ids)) for r in rows if r.n_hit} == {(7, 2, ()), (4, 93, ("2",)), (5, 93, ("2",))}
    kept = decontamination.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == 11


def test_empty_tables(spark):
    docs, items = awkward(spark), spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(docs.limit(0), items).count() == 0
    rows = decontamination.contamination(docs, items).collect()
    assert len(rows) == 12 and not any(r.contaminated or r.n_hit for r in rows)
