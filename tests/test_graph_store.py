"""Merges of the bucketed graph, and rings counted by difference."""

import random

import pytest
from conftest import plan_of

from suretygraph.operators import graph, rings
from suretygraph.operators.ring_change import cycle_count_change, near_changes, pair_changes
from suretygraph.sinks import parquet as sink
from suretygraph.sinks.graph_store import GraphStore
from suretygraph.storage import file_names


def window(draw, n, accounts=12, day=1):
    name = lambda: f"A{draw.randint(0, accounts)}"
    return [(name(), name(), draw.randint(1, 9), day) for _ in range(n)]


def stored(edges, spark, tmp_path, rows, name):
    folder = str(tmp_path / name)
    edges(*rows).write.parquet(folder)
    return spark.read.parquet(folder)


def files_of(spark, table):
    return {part: file_names(spark, f"{table.path}/run={run}/{part}") for part, run in table.snapshot(spark).folders.items()}


@pytest.mark.parametrize("mode", rings.MODES)
@pytest.mark.parametrize("lengths", [(1, 1), (1, 3), (2, 2), (2, 3), (3, 3)])
def test_a_difference_is_that_of_two_counts(edges, mode, lengths):
    draw = random.Random(f"{mode}{lengths}")
    before, after = window(draw, 40), window(draw, 45)
    after += draw.sample(before, 25)
    a, b = edges(*before), edges(*after)
    options = {"mode": mode, "min_len": lengths[0], "max_len": lengths[1]}
    wanted = rings.cycle_count(b, **options).first()[0] - rings.cycle_count(a, **options).first()[0]
    pairs = pair_changes(a, b, mode)
    assert cycle_count_change(pairs, **options).first()[0] == wanted
    assert cycle_count_change(near_changes(pairs), **options).first()[0] == wanted


def test_nothing_changed(edges):
    same = edges(*window(random.Random(1), 30))
    assert near_changes(pair_changes(same, same)).count() == 0
    assert cycle_count_change(pair_changes(same, same)).first()[0] == 0
    assert cycle_count_change(pair_changes(same.limit(0), same.limit(0)), mode="temporal", min_len=1).first()[0] == 0


def test_random_windows_give_the_graph_of_all(spark, edges, tmp_path):
    draw = random.Random(6)
    store, all_rows = GraphStore(str(tmp_path / "g"), buckets=5), []
    for k in range(4):
        rows = window(draw, 12, accounts=9, day=k + 1) + [(None, "A1", 1, 1), ("A2", None, 1, 1)]
        all_rows += rows
        offered = stored(edges, spark, tmp_path, rows, f"w{k}")
        (store.merge if k else store.build)(offered)
        whole = graph.latest_edges(edges(*all_rows))
        assert sorted(store.edges(spark).collect()) == sorted(whole.collect())
        assert store.cycle_count(spark) == rings.cycle_count(whole).first()[0]
        assert sorted(store.nodes(spark).collect()) == sorted(graph.graph_nodes(whole).collect())
    store.merge(offered)  # the same window again changes nothing
    assert sorted(store.edges(spark).collect()) == sorted(whole.collect())
    assert store.cycle_count(spark) == rings.cycle_count(whole).first()[0]


def test_untouched_buckets_keep_their_files(spark, edges, tmp_path):
    store = GraphStore(str(tmp_path / "g"), buckets=16)
    store.build(edges(*[(f"A{i}", f"A{i + 1}", 1, 1) for i in range(200)]))
    before = [files_of(spark, t) for t in (store.edge_table, store.node_table, store.neighbour_table)]
    store.merge(stored(edges, spark, tmp_path, [("A1", "A2", 5, 2)], "same"))  # a known pair: no new neighbours
    after = [files_of(spark, t) for t in (store.edge_table, store.node_table, store.neighbour_table)]
    assert sum(before[0][p] != after[0][p] for p in before[0]) == 1
    assert before[1:] == after[1:]
    store.merge(stored(edges, spark, tmp_path, [("A3", "A1", 5, 2)], "new"))
    last = [files_of(spark, t) for t in (store.edge_table, store.node_table, store.neighbour_table)]
    assert [sum(b.get(p) != a[p] for p in a) for b, a in zip(after, last)] <= [1, 2, 2]
    assert store.cycle_count(spark) == 3


def test_a_merge_that_dies_is_made_up_for(spark, edges, tmp_path, monkeypatch):
    store = GraphStore(str(tmp_path / "g"), buckets=4)
    store.build(edges(("A", "B", 1, 1), ("B", "C", 1, 1)))
    offered = stored(edges, spark, tmp_path, [("C", "A", 1, 2), ("B", "A", 1, 2)], "w")
    publish = GraphStore._publish
    def dies(self, table, *rest):
        if table.path.endswith("/edges"):
            raise RuntimeError("killed")
        publish(self, table, *rest)
    monkeypatch.setattr(GraphStore, "_publish", dies)
    with pytest.raises(RuntimeError):
        store.merge(offered)
    assert store.edges(spark).count() == 2 and store.cycle_count(spark) == 0
    with pytest.raises(RuntimeError):
        store.build(edges(("X", "Y", 1, 1)))  # a new graph that isn't finished either
    monkeypatch.undo()
    store.merge(offered)
    assert store.edges(spark).count() == 4 and store.cycle_count(spark) == 2 + 3
    assert sorted(r.id for r in store.nodes(spark).collect()) == ["A", "B", "C"]


def test_the_difference_reads_only_buckets_of_touched_accounts(spark, edges, tmp_path, monkeypatch):
    from suretygraph.sinks import graph_store

    store = GraphStore(str(tmp_path / "g"), buckets=32)
    store.build(edges(*[(f"A{i}", f"A{i + 1}", 1, 1) for i in range(300)]))
    seen = []
    count = graph_store.cycle_count_change
    monkeypatch.setattr(graph_store, "cycle_count_change", lambda pairs: seen.append(pairs) or count(pairs))
    store.merge(stored(edges, spark, tmp_path, [("A3", "A1", 5, 2)], "new"))
    read = [f for f in seen[0].inputFiles() if "/neighbours/" in f]
    assert 1 <= len(read) <= 2 and len(store.neighbour_table.scan(spark).inputFiles()) > 20
    assert "CartesianProduct" not in plan_of(seen[0]) and "NestedLoop" not in plan_of(seen[0])


def test_attempts_are_merged_in_any_order(spark, tmp_path):
    from datetime import datetime

    from suretygraph import schemas
    from suretygraph.operators import vendors

    draw = random.Random(2)
    log = [(f"V{draw.randint(0, 6)}", datetime(2026, 5, 1, draw.randint(0, 23)), i, draw.choice([200, 429, 503, 404, None]), None) for i in range(90)]
    path = str(tmp_path / "attempts")
    for part in (log[30:60], log[:30], log[60:], log[:30]):
        sink.publish_attempts(spark.createDataFrame(part, schemas.ATTEMPTS), path, buckets=3)
    state = sink.attempt_table(path).scan(spark)
    assert state.groupBy("vendor_id").count().filter("count > 5").isEmpty()
    outcome = lambda df: sorted(map(tuple, vendors.vendor_outcome(vendors.number_attempts(df)).collect()), key=str)
    assert outcome(state) == outcome(spark.createDataFrame(log, schemas.ATTEMPTS))


def test_the_difference_reads_its_pairs_once(spark, tmp_path):
    """They are written when the query is built: none of its parts works out again what the pairs come from."""
    path = str(tmp_path / "pairs")
    spark.createDataFrame([("A", "B", 1, 1, 1, 1), ("B", "C", 0, 0, 1, 0), ("A", "C", 0, 1, 1, 1)], "lo string, hi string, up0 int, down0 int, up1 int, down1 int").write.parquet(path)
    pairs = spark.read.parquet(path)
    for change in (cycle_count_change(pairs), cycle_count_change(near_changes(pairs))):
        assert change.inputFiles() and not set(change.inputFiles()) & set(pairs.inputFiles())
        assert change.first()[0] == 2 + 3


def test_a_merge_works_out_its_new_pairs_once(spark, edges, tmp_path, monkeypatch):
    from suretygraph.sinks import graph_store

    store, seen, count = GraphStore(str(tmp_path / "g"), buckets=4), [], graph_store.cycle_count_change
    store.build(edges(("A", "B", 1, 1), ("B", "C", 1, 1)))
    monkeypatch.setattr(graph_store, "cycle_count_change", lambda pairs: seen.append(pairs) or count(pairs))
    offered = stored(edges, spark, tmp_path, [("C", "A", 1, 2), ("B", "A", 1, 2)], "w")
    store.merge(offered)
    read = seen[0].inputFiles()
    assert read and not [f for f in read if "/g/edges/" in f] and not set(read) & set(offered.inputFiles())
    assert store.cycle_count(spark) == 2 + 3
