"""Rings of guarantees: closed paths of one to three edges.

An edge may be used once in a path, an account more often, and a path is counted from each account it
can start at. ``mode="latest"`` holds one edge per ordered pair, ``mode="temporal"`` every edge. Paths
that differ only in which of a pair's parallel edges they use are never listed one by one: a row stands
for all of them and says how many they are in ``path_count``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from suretygraph.operators.graph import PAIR, connected
from suretygraph.operators.skew import split_key
from suretygraph.schemas import PATH_COUNT
from suretygraph.storage import written

MODES = ("latest", "temporal")
#: A list of neighbours is cut into blocks so that none is expected to hold more accounts.
MOST_LISTED = 10_000
#: Columns of a pair with its edges from ``lo`` to ``hi`` and back, and what they are called seen from its lower end by rank.
Way = tuple[str, str, str, str]
WAYS: tuple[Way, ...] = (("up", "down", "out", "into"),)
#: The latest edges of ``stored_pairs``, which the lists can carry along.
LAST: tuple[Way, ...] = (("up_last", "down_last", "out_last", "into_last"),)


def _check(mode: str, min_len: int, max_len: int) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if not 1 <= min_len <= max_len <= 3:
        raise ValueError("lengths must satisfy 1 <= min_len <= max_len <= 3")


def account_pairs(edges: DataFrame, mode: str = "latest") -> DataFrame:
    """One row per unordered pair with its number of edges each way (0 or 1 in ``latest`` mode).

    A hash aggregate on two keys, combined on the map side: parallel edges collapse before the shuffle.
    A self-loop has ``loop`` set and counts in ``up``. All readers of the pairs share one shuffle, as long as
    none has a filter of its own below it: so the flag is an aggregate, not ``lo = hi``, and the null tests
    that joins would add are stated here.
    """
    source, target = (F.col(c) for c in PAIR)
    upward, downward = F.when(source <= target, 1), F.when(source > target, 1)
    combine = F.sum if mode == "temporal" else F.max
    return (
        connected(edges)
        .select(
            F.least(source, target).alias("lo"),
            F.greatest(source, target).alias("hi"),
            upward.cast("long").alias("u"),
            downward.cast("long").alias("d"),
            (source == target).alias("l"),
        )
        .filter(F.col("lo").isNotNull() & F.col("hi").isNotNull())
        .groupBy("lo", "hi", split_key("lo"))
        .agg(
            F.coalesce(combine("u"), F.lit(0)).alias("up"),
            F.coalesce(combine("d"), F.lit(0)).alias("down"),
            F.max(F.col("l")).alias("loop"),
        )
        .drop("_split")
    )


def stored_pairs(edges: DataFrame, mode: str) -> tuple[DataFrame, DataFrame]:
    """``account_pairs``, and the amounts on each ordered pair (``source_account_id``, ``target_account_id``, ``transaction_day``,
    ``amount``): of the latest edge, or in ``temporal`` mode of every edge.

    Both come from one read of the edges, which runs at once. In ``latest`` mode it is one shuffle, whose aggregate is
    written; the pairs then carry their latest edges too, as ``up_last`` and ``down_last`` (``day`` and ``amount``, null without
    an edge). In ``temporal`` mode the edges' four columns are written as they are and the pairs counted from them: few pairs are
    on a ring, so amounts are only added up for those, once the rings are known.
    """
    source, target = (F.col(c) for c in PAIR)
    upward, downward = source <= target, source > target
    day, amount = F.col("transaction_day"), F.col("guarantee_amount_usd")
    if mode == "temporal":
        each = written(connected(edges).select(*PAIR, day, amount.alias("amount")))
        return written(account_pairs(each, mode)), each
    ends = connected(edges).withColumns({"lo": F.least(source, target), "hi": F.greatest(source, target)})
    last = F.struct(day.alias("day"), amount.alias("amount"))  # nulls are least, so they come last
    both = written(ends.groupBy("lo", "hi").agg(
        F.max(F.when(upward, last)).alias("up_last"), F.max(F.when(downward, last)).alias("down_last")))
    there, back = F.col("up_last"), F.col("down_last")
    pairs = both.select(
        "lo", "hi", there.isNotNull().cast("long").alias("up"), back.isNotNull().cast("long").alias("down"),
        (F.col("lo") == F.col("hi")).alias("loop"), "up_last", "down_last")
    ways = [F.struct(F.col(a).alias(PAIR[0]), F.col(b).alias(PAIR[1]), c.alias("x")) for a, b, c in (("lo", "hi", there), ("hi", "lo", back))]
    steps = both.select(F.inline(F.array(*ways))).filter("x is not null")
    return pairs, steps.select(*PAIR, F.col("x.day").alias("transaction_day"), F.col("x.amount").alias("amount"))


def counted_pairs(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``stored_pairs`` for both modes at once: the pairs have the numbers of all their edges, as in ``temporal`` mode, and carry
    the latest ones; the amounts are those of every edge."""
    source, target = (F.col(c) for c in PAIR)
    each = written(connected(edges).select(*PAIR, "transaction_day", F.col("guarantee_amount_usd").alias("amount")))
    ends = each.withColumns({"lo": F.least(source, target), "hi": F.greatest(source, target)})
    last = F.struct(F.col("transaction_day").alias("day"), "amount")
    ways = {"up": source <= target, "down": source > target}
    pairs = ends.groupBy("lo", "hi").agg(
        *[F.count_if(way).alias(name) for name, way in ways.items()], *[F.max(F.when(way, last)).alias(f"{name}_last") for name, way in ways.items()])
    return written(pairs.withColumn("loop", F.col("lo") == F.col("hi"))), each


def _latest(pairs: DataFrame) -> DataFrame:
    """Pairs with all their edges as ``latest`` mode sees them."""
    return pairs.withColumns({c: F.least(c, F.lit(1).cast("long")) for c in ("up", "down")})


def list_blocks(pairs: DataFrame, most: int = MOST_LISTED) -> int:
    """Into how many blocks the lists of ``neighbours_above`` are cut: by the bound of their length, which follows from the
    number of pairs alone. A stored table's rows are counted from its footers."""
    longest = math.isqrt(2 * pairs.count())
    return 1 if longest <= most else 1 << math.ceil(math.log2(longest / most))


def neighbours_above(pairs: DataFrame, blocks: int = 1, ways: Sequence[Way] = WAYS, carried: Sequence[Way] = ()) -> DataFrame:
    """Per account ``low``, its neighbours of higher rank: ``above``, sorted by ``id`` and with the edges each way, and as ``to``
    those it guarantees, as ``from`` its guarantors. Lists are cut into so many blocks by a hash of the neighbour, a row for each
    ``block`` that has any.

    Accounts are ranked by the number of their neighbours, and every pair is kept at its lower end. A list
    then holds at most sqrt(2 * pairs) accounts, however many neighbours its account has in all: a hub's
    pairs are held by its neighbours. ``carried`` names further columns of the pairs that the lists hold.
    """
    pairs = pairs.filter(F.col("lo") != F.col("hi"))
    most = lambda columns: F.greatest(*columns) if len(columns) > 1 else columns[0]
    upward, downward = most([F.col(up) for up, _, _, _ in ways]), most([F.col(down) for _, down, _, _ in ways])
    lower = F.struct(F.col("lo").alias("id"), upward.alias("outgoing"), downward.alias("incoming"))
    upper = F.struct(F.col("hi").alias("id"), downward.alias("outgoing"), upward.alias("incoming"))
    # An account that only gives or only takes guarantees is on no ring; its pairs drop out in the joins.
    ranks = (
        pairs.select(F.inline(F.array(lower, upper)))
        .groupBy("id", split_key("id"))
        .agg(
            F.count("*").alias("degree"),
            F.max("outgoing").alias("outgoing"),
            F.max("incoming").alias("incoming"),
        )
        .filter((F.col("outgoing") > 0) & (F.col("incoming") > 0))
        .select("id", "degree")
    )
    ranked = (
        pairs.join(ranks.select(F.col("id").alias("lo"), F.col("degree").alias("lo_degree")), "lo")
        .join(ranks.select(F.col("id").alias("hi"), F.col("degree").alias("hi_degree")), "hi")
    )
    lo_first = (F.col("lo_degree") < F.col("hi_degree")) | (
        (F.col("lo_degree") == F.col("hi_degree")) & (F.col("lo") < F.col("hi"))
    )
    seen = lambda yes, no: F.when(lo_first, F.col(yes)).otherwise(F.col(no))
    edges = [c for up, down, out, into in (*ways, *carried) for c in (seen(up, down).alias(out), seen(down, up).alias(into))]
    kept = ranked.select(seen("lo", "hi").alias("low"), seen("hi", "lo").alias("id"), *edges)
    kept = kept.filter(F.col("low").isNotNull())  # as a join on it would add: both readers share the shuffle
    block = F.lit(0) if blocks == 1 else F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    lists = kept.groupBy("low", block.alias("block"), split_key("low")).agg(
        F.array_sort(F.collect_list(F.struct(*kept.columns[1:]))).alias("above")).drop("_split")
    outs, ins = [out for _, _, out, _ in ways], [into for _, _, _, into in ways]
    some = lambda names: lambda x: reduce(Column.__or__, [x[n] > 0 for n in names])
    return lists.withColumns({"to": F.filter("above", some(outs))["id"], "from": F.filter("above", some(ins))["id"]})


def triangles(pairs: DataFrame, blocks: int = 1, ways: Sequence[Way] = WAYS, carried: Sequence[Way] = ()) -> DataFrame:
    """Three accounts that are neighbours of each other, once: ``low``, ``mid`` and ``top`` by rank, with the edges between them
    as ``low_mid``, ``low_top`` and ``mid_top``, each a struct with the fields that ``ways`` and ``carried`` name, seen from the lower account.

    They come from intersecting two lists of ``neighbours_above``, so no open two-edge path is emitted, and the lists carry the
    edges, so no pair is looked up afterwards. The lists are sorted: sorting their concatenation merges two runs, and an account
    of both then lies beside itself. With several blocks each neighbour meets each block of the closing list, and that the same
    block of its own list.
    """
    above = neighbours_above(pairs, blocks, ways, carried).select("low", "block", "above")
    closing = above.withColumnRenamed("above", "closing")
    if blocks == 1:
        steps = closing.filter(F.size("closing") > 1).withColumn("low_mid", F.explode("closing"))
    else:
        steps = above.select("low", F.explode("above").alias("low_mid")).join(closing, "low")
    onward = above.select(F.col("low").alias("mid"), "block", F.col("above").alias("onward"))
    met = steps.withColumn("mid", F.col("low_mid.id")).join(onward, "mid" if blocks == 1 else ["mid", "block"])
    edges = [name for _, _, out, into in (*ways, *carried) for name in (out, into)]
    side = lambda k: lambda x: F.struct(x["id"].alias("id"), F.lit(k).alias("side"), *[x[n].alias(n) for n in edges])
    merged = met.filter(F.arrays_overlap("closing.id", "onward.id")).select(
        "low", "mid", "low_mid", F.array_sort(F.concat(F.transform("closing", side(0)), F.transform("onward", side(1)))).alias("both"))
    beside = F.zip_with("both", F.slice("both", 2, F.size("both")), lambda x, y: F.when(
        x["id"] == y["id"], F.struct(x["id"].alias("top"), x.alias("low_top"), y.alias("mid_top"))))
    return merged.select("low", "mid", "low_mid", F.inline(F.filter(beside, lambda x: x.isNotNull())))


def directed_triangles(pairs: DataFrame, blocks: int = 1, carried: Sequence[Way] = ()) -> DataFrame:
    """Three-account rings ``a -> b -> c -> a``, each once, ``a`` being the account of lowest rank, with the number of edges on
    each step as ``counts``; with ``LAST`` carried also the latest edge on each step as ``lasts``."""
    low, mid, top = (F.col(c) for c in ("low", "mid", "top"))

    def ring(b: Column, c: Column, *steps: str) -> Column:
        lasts = [F.array(*[f"{step}_last" for step in steps]).alias("lasts")] if carried else []
        return F.struct(low.alias("a"), b.alias("b"), c.alias("c"), F.array(*steps).alias("counts"), *lasts)

    forward = ring(mid, top, "low_mid.out", "mid_top.out", "low_top.into")
    backward = ring(top, mid, "low_top.out", "mid_top.into", "low_mid.into")
    found = triangles(pairs, blocks, carried=carried).select(F.inline(F.array(forward, backward)))
    return found.filter(F.array_min("counts") > 0)


def _product(*counts: Column) -> Column:
    result = counts[0].cast(PATH_COUNT)
    for count in counts[1:]:
        result = (result * count.cast(PATH_COUNT)).cast(PATH_COUNT)
    return result


def _uses(nodes: list[Column], choices: list[Column]) -> list[Column]:
    """How many of a ring's paths from one start go through one given edge, for each step. By symmetry that is the product of the
    other steps' choices, and where the steps share one self-loop's edges, the product of the later, smaller ones."""
    shared = len(nodes) > 1 and all(node is nodes[0] for node in nodes)
    others = [choices[1:] if shared else choices[:i] + choices[i + 1:] for i in range(len(nodes))]
    return [_product(*(other or [F.lit(1)])) for other in others]


def _ring(nodes: list[Column], choices: list[Column], starts: int) -> list[Column]:
    """Columns of a ring.

    ``choices`` says how many edges each step can take, given those taken before it. ``nodes`` are the
    accounts in order, ``starts`` how many of them a different path can start at, ``path_count`` the
    paths from each start. ``steps`` are the accounts of each edge and how many of those paths go through
    one given edge of the step (``uses``).
    """
    size = len(nodes)
    return [
        F.array(*nodes).alias("nodes"),
        F.array(*[F.struct(node.alias("source"), nodes[(i + 1) % size].alias("target"), uses.alias("uses"))
                  for i, (node, uses) in enumerate(zip(nodes, _uses(nodes, choices)))]).alias("steps"),
        _product(*choices).alias("path_count"),
        F.lit(starts).alias("starts"),
    ]


def _with_counts(triangles: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """The number of parallel edges on each step of a triangle, as ``n0``, ``n1``, ``n2``. The triangles carry them from the
    lists they were found in: ``pairs`` isn't read."""
    return triangles.select("a", "b", "c", *[F.col("counts")[i].alias(f"n{i}") for i in range(3)])


def rings(edges: DataFrame, *, mode: str = "latest", min_len: int = 2, max_len: int = 3) -> DataFrame:
    """Each ring once, whatever account it starts at. The pairs are aggregated, and written, when this is called: the parts of
    the plan read them up to thirteen times, and the edges once."""
    _check(mode, min_len, max_len)
    pairs = written(account_pairs(edges, mode))
    return rings_of_pairs(pairs, mode, min_len, max_len, list_blocks(pairs))


#: Rings of one kind: a table, the accounts in order, how many edges each step can take, and how many starts differ.
Kind = tuple[DataFrame, list[Column], list[Column], int]


def _kinds(pairs: DataFrame, mode: str, min_len: int, max_len: int, closed: DataFrame | None) -> list[Kind]:
    """The kinds of rings by length and self-loops; ``closed`` are the ``directed_triangles``, needed for three edges. What else
    the pairs carry stays with the rings: ``up_last`` and ``down_last``, after a detour ``loop_last``, ``there_last`` and ``back_last``."""
    temporal = mode == "temporal"
    carried = {"up_last", "down_last"} <= set(pairs.columns)
    last = lambda name: [F.col("up_last").alias(name)] if carried else []
    loops = pairs.filter("loop").select(F.col("lo").alias("v"), (F.col("up") + F.col("down")).alias("n"), *last("loop_last"))
    mutual = pairs.filter(~F.col("loop") & (F.col("up") > 0) & (F.col("down") > 0))
    v, w, n = F.col("v"), F.col("w"), F.col("n")
    found: list[Kind] = []
    if min_len <= 1:
        found.append((loops, [v], [n], 1))
    if min_len <= 2 <= max_len:
        found.append((mutual, [F.col("lo"), F.col("hi")], [F.col("up"), F.col("down")], 2))
        if temporal:
            found.append((loops.filter(n > 1), [v, v], [n, n - 1], 1))
    if max_len == 3:
        if temporal:
            closed, counts = _with_counts(closed), [F.col(f"n{i}") for i in range(3)]
        else:
            counts = [F.lit(1)] * 3
        found.append((closed, [F.col("a"), F.col("b"), F.col("c")], counts, 3))
        # A self-loop taken on the way round a mutual pair.
        names = ("there", "back", *(("there_last", "back_last") if carried else ()))
        ends = [
            F.struct(F.col(one).alias("v"), F.col(other).alias("w"), *[F.col(c).alias(name) for c, name in zip(sides, names)])
            for one, other, *sides in (("lo", "hi", "up", "down", "up_last", "down_last"), ("hi", "lo", "down", "up", "down_last", "up_last"))
        ]
        detours = mutual.select(F.inline(F.array(*ends))).join(loops, "v")
        found.append((detours, [v, v, w], [n, F.col("there"), F.col("back")], 3))
        if temporal:
            found.append((loops.filter(n > 2), [v, v, v], [n, n - 1, n - 2], 1))
    return found


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def rings_of_pairs(pairs: DataFrame, mode: str, min_len: int, max_len: int, blocks: int = 1) -> DataFrame:
    closed = directed_triangles(pairs, blocks) if max_len == 3 else None
    return _rings(_kinds(pairs, mode, min_len, max_len, closed))


def _rings(kinds: list[Kind]) -> DataFrame:
    return _union([table.select(*_ring(nodes, choices, starts)) for table, nodes, choices, starts in kinds])


def cycle_count(edges: DataFrame, *, mode: str = "latest", min_len: int = 2, max_len: int = 3) -> DataFrame:
    """Number of closed paths, every start counted."""
    return _counted(rings(edges, mode=mode, min_len=min_len, max_len=max_len))


def _counted(found: DataFrame) -> DataFrame:
    total = F.sum((F.col("path_count") * F.col("starts")).cast(PATH_COUNT)).cast(PATH_COUNT)
    return found.agg(F.coalesce(total, F.lit(0).cast(PATH_COUNT)).alias("cycle_count"))


def cycle_counts(edges: DataFrame, *, min_len: int = 2, max_len: int = 3) -> DataFrame:
    """``cycle_count`` of each of ``MODES``, a row each with its ``mode``. The modes have the same pairs and triangles, with other
    numbers of edges: both are found once, and written, when this is called."""
    _check("temporal", min_len, max_len)
    pairs = written(account_pairs(edges, "temporal"))
    closed = written(directed_triangles(pairs, list_blocks(pairs))) if max_len == 3 else None
    seen = {"temporal": pairs, "latest": _latest(pairs)}
    return _union([_counted(_rings(_kinds(seen[mode], mode, min_len, max_len, closed))).withColumn("mode", F.lit(mode)) for mode in MODES])


def _from_each_start(values: Column) -> Column:
    """The rotations of a ring's array that differ in their start."""
    size = F.size(values)
    return F.transform(
        F.sequence(F.lit(0), F.col("starts") - 1),
        lambda shift: F.concat(F.slice(values, shift + 1, size), F.slice(values, F.lit(1), shift)),
    )


def cycle_paths(edges: DataFrame, *, mode: str = "latest", min_len: int = 1, max_len: int = 3) -> DataFrame:
    """The closed paths from every start: accounts in order, first one repeated at the end. The pairs are aggregated, and written,
    when this is called."""
    _check(mode, min_len, max_len)
    pairs = written(account_pairs(edges, mode))
    closed = directed_triangles(pairs, list_blocks(pairs)) if max_len == 3 else None
    return _paths(_kinds(pairs, mode, min_len, max_len, closed))


def _paths(kinds: list[Kind]) -> DataFrame:
    """Each kind has so many accounts and starts, so the turns are spelled out: plain columns, no functions over arrays."""
    listed = []
    for table, nodes, choices, starts in kinds:
        names = [f"x{i}" for i in range(len(nodes))]
        turns = [F.struct(*[node.alias(name) for node, name in zip(nodes[k:] + nodes[:k], names)]) for k in range(starts)]
        turned = table.select(F.inline(F.array(*turns)), _product(*choices).alias("path_count"))
        back = [*names, names[0]]
        listed.append(turned.select(
            F.col("x0").alias("account"), F.lit(len(nodes)).alias("cycle_length"), F.array(*back).alias("nodes"),
            F.concat_ws(">", *back).alias("path"), "path_count"))
    return _union(listed)


def cycle_path_edges(edges: DataFrame, *, min_len: int = 1, max_len: int = 3) -> DataFrame:
    """``cycle_paths`` of the latest edges, with each step's edge as a struct of ends, day and amount. The pairs are
    aggregated when this is called."""
    _check("latest", min_len, max_len)
    pairs, amounts = stored_pairs(edges, "latest")
    sides = rings_of_pairs(pairs, "latest", min_len, max_len, list_blocks(pairs)).select(
        "nodes", "starts", F.posexplode("steps").alias("step", "edge")
    ).select(
        "nodes", "starts", "step", F.col("edge.source").alias(PAIR[0]), F.col("edge.target").alias(PAIR[1])
    )
    # At most three edges meet per ring, so the lists are bounded.
    complete = (
        sides.join(amounts.withColumnRenamed("amount", "guarantee_amount_usd"), list(PAIR))
        .groupBy("nodes", "starts")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("step", *PAIR, "transaction_day", "guarantee_amount_usd"))
            ).alias("steps")
        )
    )
    turned = complete.select(F.explode(_from_each_start(F.col("steps"))).alias("steps"))
    first = F.col("steps")[0][PAIR[0]]
    return turned.select(
        first.alias("account"),
        F.size("steps").alias("cycle_length"),
        F.concat_ws(">", F.concat(F.col("steps")[PAIR[0]], F.array(first))).alias("path"),
        F.transform("steps", lambda step: step.dropFields("step")).alias("edges"),
    )


def cycle_amounts_by_day(
    edges: DataFrame, *, mode: str = "latest", min_len: int = 2, max_len: int = 3, ordered: bool = True
) -> DataFrame:
    """Amount on the closed paths of each start account, per day of the edge.

    An edge counts once for every path it is on. Instead of unrolling the paths, each edge's amount is multiplied by the
    number of paths that use one edge of its pair. Of latest edges a step has one, which the pairs and lists carry: the amounts
    are added up from the rings, without a join. The pairs are aggregated when this is called.
    """
    _check(mode, min_len, max_len)
    pairs, amounts = stored_pairs(edges, mode)
    if mode == "latest":
        closed = directed_triangles(pairs, list_blocks(pairs), LAST) if max_len == 3 else None
        result = _latest_amounts(pairs, closed, min_len, max_len)
    else:
        closed = written(directed_triangles(pairs, list_blocks(pairs))) if max_len == 3 else None
        result = _amounts_by_uses(_kinds(pairs, mode, min_len, max_len, closed), amounts)
    return result.orderBy("day", "account") if ordered else result


def _amounts_by_uses(kinds: list[Kind], amounts: DataFrame) -> DataFrame:
    """An edge counts for the accounts that rings through it start at. Most of them are its own ends: their uses are added up per
    pair, in one row for both. The third account of a triangle has a row of its own, which needs no adding up, as there is no
    other triangle with these steps. The triangles are read twice."""
    ends, thirds = [], []
    for table, nodes, choices, starts in kinds:
        times = lambda node: sum(other is node for other in nodes[:starts])  # noqa: B023, E731
        at_ends, at_others = [], []
        for i, (node, uses) in enumerate(zip(nodes, _uses(nodes, choices))):
            onward = nodes[(i + 1) % len(nodes)]
            step = [node.alias(PAIR[0]), onward.alias(PAIR[1])]
            share = lambda other: _product(F.lit(times(other)), uses)  # noqa: B023, E731
            at_ends.append(F.struct(*step, share(node).alias("at_source"), (F.lit(0).cast(PATH_COUNT) if onward is node else share(onward)).alias("at_target")))
            rest = [x for k, x in enumerate(nodes[:starts]) if x is not node and x is not onward and not any(x is y for y in nodes[:k])]
            at_others += [F.struct(*step, other.alias("third"), share(other).alias("at_third")) for other in rest]
        ends.append(table.select(F.inline(F.array(*at_ends))))
        if at_others:
            thirds.append(table.select(F.inline(F.array(*at_others))))
    names = ("at_source", "at_target")
    uses = _union(ends).groupBy(*PAIR).agg(*[F.sum(c).cast(PATH_COUNT).alias(c) for c in names])
    if thirds:
        uses = uses.unionByName(_union(thirds), allowMissingColumns=True)
    accounts = [*zip(PAIR, names), *([("third", "at_third")] if thirds else [])]
    shares = [F.struct(F.col(a).alias("account"), F.col(n).alias("uses")) for a, n in accounts]
    return (
        amounts.join(uses, list(PAIR))
        .select("transaction_day", "amount", F.inline(F.array(*shares))).filter("uses > 0")
        .groupBy("account", F.col("transaction_day").alias("day"))
        .agg(F.sum((F.col("amount") * F.col("uses")).cast("decimal(38,2)")).cast("decimal(38,2)").alias("total_amount"))
    )


def _latest_amounts(pairs: DataFrame, closed: DataFrame | None, min_len: int, max_len: int) -> DataFrame:
    """``pairs`` and ``closed`` carry the latest edge of each step, whose rings have one path from each start."""
    lasts = {1: [["loop_last"]], 2: [["up_last", "down_last"]], 3: [["lasts[0]", "lasts[1]", "lasts[2]"], ["loop_last", "there_last", "back_last"]]}
    used = []
    for table, nodes, _, starts in _kinds(pairs, "latest", min_len, max_len, closed):
        steps = lasts[len(nodes)].pop(0)
        # A detour starts twice at the account of its self-loop.
        accounts = [(node, sum(other is node for other in nodes[:starts])) for i, node in enumerate(nodes) if not any(node is x for x in nodes[:i])]
        rows = [F.struct(node.alias("account"), F.expr(step).alias("last"), F.lit(times).alias("times")) for node, times in accounts for step in steps]
        used.append(table.select(F.inline(F.array(*rows))))
    total = F.sum((F.col("last.amount") * F.col("times")).cast("decimal(38,2)")).cast("decimal(38,2)")
    return _union(used).groupBy("account", F.col("last.day").alias("day")).agg(total.alias("total_amount"))


def cycle_amount_change(
    edges: DataFrame, *, mode: str = "latest", min_len: int = 2, max_len: int = 3
) -> DataFrame:
    """Per start account, the change of its rings' amount against the day before it that has one."""
    return _change(cycle_amounts_by_day(edges, mode=mode, min_len=min_len, max_len=max_len, ordered=False))


def cycle_amount_changes(edges: DataFrame, *, min_len: int = 2, max_len: int = 3) -> DataFrame:
    """``cycle_amount_change`` of each of ``MODES``, a row's ``mode`` beside it. The modes have the same pairs and triangles: both
    are found once. They, and each mode's amounts by day, are written when this is called, so that no more lies on disk at a time
    than these tables and one step's shuffles."""
    _check("temporal", min_len, max_len)
    pairs, each = counted_pairs(edges)
    closed = written(directed_triangles(pairs, list_blocks(pairs), LAST)) if max_len == 3 else None
    daily = {
        "latest": _latest_amounts(_latest(pairs), closed, min_len, max_len),
        "temporal": _amounts_by_uses(_kinds(pairs, "temporal", min_len, max_len, closed), each),
    }
    return _union([_change(written(daily[mode])).withColumn("mode", F.lit(mode)) for mode in MODES])


def _change(daily: DataFrame) -> DataFrame:
    # One row per account and day: a window is as long as the calendar at most.
    by_day = Window.partitionBy("account").orderBy("day")
    total, previous = F.col("total_amount"), F.col("previous_amount")
    return daily.withColumn("previous_amount", F.lag("total_amount").over(by_day)).select(
        "account",
        "day",
        "total_amount",
        "previous_amount",
        (total - previous).cast("decimal(38,2)").alias("change"),
        F.try_divide((total - previous).cast("double"), previous.cast("double")).alias("change_ratio"),
    )


def latest_listings(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``cycle_paths`` and ``cycle_amount_change`` of the latest edges, with the defaults of each. Both come from the same pairs
    and triangles, which are written when this is called: found once, with the edges' days and amounts."""
    pairs, _ = stored_pairs(edges, "latest")
    closed = written(directed_triangles(pairs, list_blocks(pairs), LAST))
    return _paths(_kinds(pairs, "latest", 1, 3, closed)), _change(_latest_amounts(pairs, closed, 2, 3))
