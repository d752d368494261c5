"""Rings against brute force: every closed trail of one to three edges, found by walking."""

import random
from collections import Counter, defaultdict
from datetime import date
from decimal import Decimal

import pytest
from conftest import plan_of

from suretygraph.operators import rings


def trails(edge_list):
    """All closed trails of one to three different edges, as tuples of edge positions."""
    leaving = defaultdict(list)
    for i, edge in enumerate(edge_list):
        leaving[edge[0]].append(i)
    found, open_trails = [], [(i,) for i in range(len(edge_list))]
    for _ in range(3):
        found += [t for t in open_trails if edge_list[t[-1]][1] == edge_list[t[0]][0]]
        open_trails = [t + (i,) for t in open_trails for i in leaving[edge_list[t[-1]][1]] if i not in t]
    return found


def newest(edge_list):
    best = {}
    for edge in edge_list:
        key = edge[:2]
        if key not in best or (edge[3], edge[2]) > (best[key][3], best[key][2]):
            best[key] = edge
    return list(best.values())


def expected(edge_list, mode, min_len, max_len):
    kept = newest(edge_list) if mode == "latest" else edge_list
    paths, amounts = Counter(), defaultdict(Decimal)
    for trail in trails(kept):
        if not min_len <= len(trail) <= max_len:
            continue
        nodes = [kept[i][0] for i in trail]
        paths[">".join(nodes + nodes[:1])] += 1
        for i in trail:
            amounts[nodes[0], date(2026, 5, kept[i][3])] += Decimal(kept[i][2])
    return paths, dict(amounts)


def random_graphs(seed, count=25):
    """Many small graphs side by side, told apart by the accounts' prefix."""
    pick, rows = random.Random(seed), []
    for g in range(count):
        accounts = [f"g{g}n{i}" for i in range(pick.randint(1, 5))]
        for _ in range(pick.randint(1, 11)):
            rows.append((pick.choice(accounts), pick.choice(accounts), pick.randint(1, 50), pick.randint(1, 4)))
    return rows


@pytest.mark.parametrize("mode", rings.MODES)
@pytest.mark.parametrize("lengths", [(1, 3), (2, 3), (3, 3), (1, 2)])
def test_paths_and_amounts_agree_with_brute_force(edges, mode, lengths):
    rows = random_graphs(seed=hash(lengths) % 1000)
    low, high = lengths
    paths, amounts = expected(rows, mode, low, high)
    frame = edges(*rows).cache()
    listed = rings.cycle_paths(frame, mode=mode, min_len=low, max_len=high).collect()
    assert len({r.path for r in listed}) == len(listed)
    assert {r.path: int(r.path_count) for r in listed} == paths
    assert all(r.account == r.path.split(">")[0] and r.cycle_length == r.path.count(">") for r in listed)
    total = rings.cycle_count(frame, mode=mode, min_len=low, max_len=high).first().cycle_count
    assert int(total) == sum(paths.values())
    by_day = rings.cycle_amounts_by_day(frame, mode=mode, min_len=low, max_len=high).collect()
    assert {(r.account, r.day): r.total_amount for r in by_day} == amounts
    assert [r.day for r in by_day] == sorted(r.day for r in by_day)


def test_dense_and_hub_graphs_agree_with_brute_force(edges):
    pick = random.Random(5)
    dense = [(f"d{a}", f"d{b}", 1, 1) for a in range(14) for b in range(14) if pick.random() < 0.5]
    hub = [("hub", f"s{i}", 1, 1) for i in range(60)] + [(f"s{i}", "hub", 1, 1) for i in range(0, 60, 2)]
    hub += [(f"s{i}", f"s{i + 1}", 1, 1) for i in range(59)] + [("hub", "hub", 1, 1)]
    rows = dense + hub
    paths, _ = expected(rows, "latest", 2, 3)
    listed = rings.cycle_paths(edges(*rows), min_len=2).collect()
    assert {r.path: int(r.path_count) for r in listed} == paths


def test_lists_above_an_account_stay_short(edges):
    """A hub with hundreds of neighbours: their pairs are held at the other ends."""
    pick = random.Random(3)
    rows = [("hub", f"s{i}", 1, 1) for i in range(300)] + [(f"s{i}", "hub", 1, 1) for i in range(300)]
    rows += [(f"s{pick.randrange(300)}", f"s{pick.randrange(300)}", 1, 1) for _ in range(600)]
    pairs = rings.account_pairs(edges(*rows)).cache()
    above = rings.neighbours_above(pairs)
    longest = above.selectExpr("max(size(to))", "max(size(from))").first()
    assert max(longest) <= (2 * pairs.count()) ** 0.5
    assert max(longest) < 20
    paths, _ = expected(rows, "latest", 3, 3)
    assert int(rings.cycle_count(edges(*rows), min_len=3).first().cycle_count) == sum(paths.values())


def test_parallel_edges_are_counted_not_listed(edges):
    rows = [("A", "B", 1, 1)] * 2000 + [("B", "A", 1, 1)] * 3000 + [("A", "A", 1, 1)] * 1000
    frame = edges(*rows)
    assert rings.rings(frame, mode="temporal", min_len=1).count() == 5
    count = int(rings.cycle_count(frame, mode="temporal").first().cycle_count)
    k, ab = 1000, 2000 * 3000
    assert count == 2 * ab + k * (k - 1) + 3 * k * ab + k * (k - 1) * (k - 2)


def test_counts_beyond_long(spark):
    pairs = spark.createDataFrame(
        [("A", "B", 10**12, 0, False), ("A", "C", 0, 10**12, False), ("B", "C", 10**12, 0, False)],
        "lo string, hi string, up long, down long, loop boolean",
    )
    counted = rings._with_counts(rings.directed_triangles(pairs), pairs)
    product = rings._product(*[counted[f"n{i}"] for i in range(3)])
    assert counted.select(product.alias("p")).first().p == Decimal(10) ** 36


def test_week_with_the_amount_change(edges):
    """A ring on days 3 to 7 whose amounts grow five-fold from day 5."""
    ring = [("A", "B"), ("B", "C"), ("C", "A")]
    rows = [(s, t, 100 * (5 if d >= 5 else 1), d) for d in range(3, 8) for s, t in ring]
    changes = {(r.account, r.day.day): r for r in rings.cycle_amount_change(edges(*rows), mode="temporal").collect()}
    assert len(changes) == 15
    # 5 edges per pair: a day's edge of a pair is on 25 of the 125 paths.
    assert changes["A", 3].total_amount == 3 * 25 * 100 and changes["A", 3].change is None
    assert changes["B", 4].change == 0 and changes["B", 4].change_ratio == 0.0
    assert changes["C", 5].change == 3 * 25 * 400 and changes["C", 5].change_ratio == 4.0
    assert changes["A", 7].change_ratio == 0.0
    # One edge per pair: only the last day is seen.
    latest = rings.cycle_amounts_by_day(edges(*rows)).collect()
    assert {(r.account, r.day.day, int(r.total_amount)) for r in latest} == {(a, 7, 1500) for a in "ABC"}


def test_path_edges_carry_day_and_amount(edges):
    frame = edges(("A", "B", 1, 1), ("A", "B", 2, 4), ("B", "A", 5, 2), ("A", "A", 7, 3))
    listed = {r.path: [(e.source_account_id, e.target_account_id, e.transaction_day.day, int(e.guarantee_amount_usd))
                       for e in r.edges] for r in rings.cycle_path_edges(frame).collect()}
    ab, ba, aa = ("A", "B", 4, 2), ("B", "A", 2, 5), ("A", "A", 3, 7)
    assert listed == {
        "A>A": [aa], "A>B>A": [ab, ba], "B>A>B": [ba, ab],
        "A>A>B>A": [aa, ab, ba], "A>B>A>A": [ab, ba, aa], "B>A>A>B": [ba, aa, ab],
    }


def test_null_ends_and_empty_edges(edges):
    frame = edges(("A", None, 1, 1), (None, "A", 1, 1))
    assert int(rings.cycle_count(frame, min_len=1).first().cycle_count) == 0
    assert rings.cycle_paths(frame).count() == 0
    assert rings.cycle_amounts_by_day(frame).count() == 0


def test_plan_has_no_cross_join(edges):
    plan = plan_of(rings.cycle_paths(edges(("A", "B", 1, 1)), mode="temporal"))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_arguments_are_checked(edges):
    with pytest.raises(ValueError):
        rings.cycle_count(edges(("A", "B", 1, 1)), mode="all")
    with pytest.raises(ValueError):
        rings.cycle_count(edges(("A", "B", 1, 1)), max_len=4)


@pytest.mark.parametrize("mode", rings.MODES)
def test_blocks_of_lists_give_the_same_rings(spark, edges, monkeypatch, mode):
    """A dense graph: whole lists are long, with blocks none is longer than a few times the aim."""
    draw = random.Random(11)
    frame = edges(*[(f"A{draw.randint(0, 60)}", f"A{draw.randint(0, 60)}", 1, 1) for _ in range(1500)])
    whole = sorted(rings.cycle_paths(frame, mode=mode).select("path", "path_count").collect())
    pairs = rings.account_pairs(frame, mode)
    longest = lambda n: rings.neighbours_above(pairs, n).selectExpr("max(greatest(size(to), size(`from`)))").first()[0]
    assert longest(1) >= 18
    monkeypatch.setattr(rings, "list_blocks", lambda pairs: 16)
    assert sorted(rings.cycle_paths(frame, mode=mode).select("path", "path_count").collect()) == whole and longest(16) <= 8
    plan = plan_of(rings.cycle_paths(frame, mode=mode))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_the_number_of_blocks_follows_from_that_of_pairs(spark):
    assert [rings.list_blocks(spark.range(n), 100) for n in (0, 1, 5000, 5200, 20_000, 500_000)] == [1, 1, 1, 2, 2, 16]


@pytest.mark.parametrize("blocks", [1, 4])
def test_triangles_carry_their_edges(spark, blocks):
    """The counts come with the lists: the pairs aren't looked up again."""
    pairs = spark.createDataFrame(
        [("A", "B", 2, 3, False), ("A", "C", 7, 5, False), ("B", "C", 11, 0, False), ("C", "D", 1, 1, False)],
        "lo string, hi string, up long, down long, loop boolean",
    )
    found = rings._with_counts(rings.directed_triangles(pairs, blocks)).collect()
    # A -> B -> C -> A, whichever account it starts at.
    edges = {("A", "B"): 2, ("B", "C"): 11, ("C", "A"): 5}
    assert [{(r.a, r.b): r.n0, (r.b, r.c): r.n1, (r.c, r.a): r.n2} for r in found] == [edges]


def found_once(monkeypatch) -> list:
    """Counts the searches for triangles from here on."""
    calls, search = [], rings.triangles
    monkeypatch.setattr(rings, "triangles", lambda *args, **options: calls.append(1) or search(*args, **options))
    return calls


def test_listings_share_their_triangles(edges, monkeypatch):
    """Paths and changes of amounts come from one search, and the amounts are those of the listed edges."""
    draw = random.Random(5)
    frame = edges(*[(f"A{draw.randint(0, 9)}", f"A{draw.randint(0, 9)}", k, draw.randint(1, 6)) for k in range(70)], ("A1", "A1", 5, 2), ("A1", "A2", 7, None))
    wanted = sorted(rings.cycle_paths(frame).select("path", "path_count").collect())
    days = {}
    for r in rings.cycle_path_edges(frame, min_len=2).collect():
        for e in r.edges:
            key = r.account, e.transaction_day
            days[key] = days.get(key, 0) + e.guarantee_amount_usd
    calls = found_once(monkeypatch)
    paths, changes = rings.latest_listings(frame)
    assert sorted(paths.select("path", "path_count").collect()) == wanted
    assert {(r.account, r.day): r.total_amount for r in changes.collect()} == days
    assert len(calls) == 1 and len(days) > 20


def test_counts_of_both_modes_share_their_triangles(edges, monkeypatch):
    draw = random.Random(6)
    frame = edges(*[(f"A{draw.randint(0, 7)}", f"A{draw.randint(0, 7)}", 1, 1) for _ in range(90)])
    wanted = {mode: rings.cycle_count(frame, mode=mode, min_len=1).first().cycle_count for mode in rings.MODES}
    calls = found_once(monkeypatch)
    assert {r.mode: r.cycle_count for r in rings.cycle_counts(frame, min_len=1).collect()} == wanted
    assert len(calls) == 1 and wanted["temporal"] > wanted["latest"] > 0


@pytest.mark.parametrize("low", [1, 2])
def test_amount_changes_of_both_modes_at_once(edges, low):
    """As each mode's own, with accounts and days missing."""
    frame = edges(*random_graphs(seed=13), (None, "g0n0", 5, 1), ("g1n0", None, 5, 1), ("A", "B", 3, None), ("B", "A", 4, 2), ("A", "A", 6, None))
    wanted = {(mode, *r) for mode in rings.MODES for r in rings.cycle_amount_change(frame, mode=mode, min_len=low).collect()}
    found = rings.cycle_amount_changes(frame, min_len=low)
    rows = found.select("mode", *[c for c in found.columns if c != "mode"]).collect()
    assert len(rows) == len(wanted) and {tuple(r) for r in rows} == wanted


def test_uses_of_a_pair_are_added_up_once_for_both_its_ends(edges):
    """Before there was a row for each account that a ring through the pair starts at."""
    frame = edges(*[(f"s{i}", f"s{j}", 1, 1) for i in range(8) for j in range(8) if i != j])
    by_day = rings.cycle_amounts_by_day(frame, mode="temporal", ordered=False)
    assert "explode" not in plan_of(by_day)
    paths, amounts = expected([(f"s{i}", f"s{j}", 1, 1) for i in range(8) for j in range(8) if i != j], "temporal", 2, 3)
    assert {(r.account, r.day): r.total_amount for r in by_day.collect()} == amounts
