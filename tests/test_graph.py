from datetime import date

from conftest import plan_of, tx

from suretygraph.operators import graph


def flat(df):
    return {tuple(float(v) if k == "guarantee_amount_usd" else v for k, v in r.asDict().items()) for r in df.collect()}


def test_edges_and_export(transactions):
    edges = graph.graph_edges(transactions(tx(amount="12.50")))
    assert edges.columns == ["source_account_id", "target_account_id", "guarantee_amount_usd", "transaction_day"]
    assert [tuple(r) for r in graph.graph_edges_export(edges).collect()] == [("A", "B", 12.5, "2026-05-01")]
    assert graph.edge_count(edges).first().edge_count == 1


def test_nodes_are_distinct_and_not_null(edges):
    rows = edges(("A", "B", 1, 1), ("B", "A", 1, 1), ("C", None, 1, 1), ("D", "D", 1, 1))
    assert sorted(r.id for r in graph.graph_nodes(rows).collect()) == ["A", "B", "C", "D"]


def test_latest_edge_per_pair(edges):
    rows = edges(
        ("A", "B", 1, 1), ("A", "B", 2, 3), ("A", "B", 9, 2), ("A", "B", 3, 3), ("A", "B", 99, None),
        ("B", "A", 5, 1), ("A", None, 5, 1), (None, "A", 5, 1),
    )
    latest = graph.latest_edges(rows)
    assert flat(latest) == {("A", "B", 3.0, date(2026, 5, 3)), ("B", "A", 5.0, date(2026, 5, 1))}
    assert plan_of(latest).count("WindowGroupLimit") == 2


def test_upsert_prefers_later_days_then_incoming(edges):
    stored = edges(("A", "B", 10, 2), ("C", "D", 10, 5), ("E", "F", 1, 1))
    incoming = edges(("A", "B", 1, 2), ("C", "D", 1, 4), ("G", "H", 1, 1), ("A", "B", 0.5, 2))
    assert flat(graph.upsert_edges(stored, incoming)) == {
        ("A", "B", 1.0, date(2026, 5, 2)), ("C", "D", 10.0, date(2026, 5, 5)),
        ("E", "F", 1.0, date(2026, 5, 1)), ("G", "H", 1.0, date(2026, 5, 1)),
    }


def test_upsert_twice_changes_nothing(edges):
    stored, incoming = edges(("A", "B", 10, 2)), edges(("A", "B", 1, 2), ("B", "A", 4, 1))
    once = graph.upsert_edges(stored, incoming)
    assert flat(graph.upsert_edges(once, incoming)) == flat(once)
