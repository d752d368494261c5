import random

from helpers import LONG, awkward, clashing, documents

from suretygraph.llm import minhash
from suretygraph.llm.components import components


def brute(rows, size, share):
    def shingles(text):
        w = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        return {tuple(w)} - {()} if len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}

    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= share * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_groups_of_copies(spark):
    draw = random.Random(3)
    rows, n = [], 0
    for group in range(6):
        base = [f"g{group}w{draw.randint(0, 50)}" for _ in range(150)]
        for _ in range(30):
            copy = list(base)
            for _ in range(draw.randint(0, 7)):  # from equal to too far, with chains between
                copy[draw.randrange(len(copy))] = f"new{draw.randint(0, 3)}"
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(n + i, t) for i, t in enumerate(["a b", "A B", "a b c", "a b c d", "a", "", None, "B a"])]
    draw.shuffle(rows)
    docs = documents(spark, [(i, t, None, None, None) for i, t in rows])
    for size, share in ((3, 85), (5, 80)):
        out = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.classes_and_links(docs, shingle=size, share=share).collect()}
        assert out == brute(rows, size, share)


def test_close_pairs_in_a_family_below_the_threshold(spark):
    template, rows = [f"t{i}" for i in range(200)], []
    for i in range(300):
        own = [f"own{i}x{k}" for k in range(16)]
        if i % 30 == 29:  # a few own words of the text before: 183 of 213 shingles, where others share 180 of 216
            own[:5] = [f"own{i - 1}x{k}" for k in range(5)]
        rows.append((i, " ".join(template[:90] + own + template[106:])))
    wanted = brute(rows, 3, 85)
    assert sorted(i for i, (_, root) in wanted.items() if root != i) == list(range(29, 300, 30))
    docs = documents(spark, [(i, t, None, None, None) for i, t in rows])
    for hot in (1000, 7):
        before, minhash.HOT = minhash.HOT, hot
        try:
            out = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.classes_and_links(docs).collect()}
        finally:
            minhash.HOT = before
        assert out == wanted


def test_awkward_rows(spark):
    docs = clashing(awkward(spark))
    rows = minhash.classes_and_links(docs).collect()
    assert len(rows) == 12
    by = {(r.doc_id, r.n_shingles): r.component_id for r in rows}
    assert by[(1, 0)] == 1 and by[(2, 0)] == 2 and by[(3, 0)] == 3 and by[(None, 0)] is None and by[(None, 3)] is None
    assert {r.component_id for r in rows if r.doc_id in (4, 5)} == {4}
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == 11 and not kept.filter("doc_id = 5").count()
    assert len(LONG) > 100_000


def test_empty_table(spark):
    assert minhash.classes_and_links(awkward(spark).limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(10, 90)] + [(5, 3), (3, 4)], "a long, b long")
    out = {r.node: r.component for r in components(links).collect()}
    assert out == {**{i: 10 for i in range(10, 91)}, 3: 3, 4: 3, 5: 3}


def test_a_node_with_very_many_links_is_split(spark):
    """The join of the stars shuffles both sides for itself, so adaptive execution can split the hot centre."""
    from pyspark.sql import functions as F

    from suretygraph.llm import components as stars
    from suretygraph.llm.staging import stored

    links = stored(spark.range(1, 400_001).select(F.lit(0).cast("long").alias("b"), F.col("id").alias("a")), "links")
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        out = stars._star(links, both=True)
        assert len(out.collect()) == 400_000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
