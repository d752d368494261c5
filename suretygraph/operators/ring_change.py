"""The change of the number of rings when some pairs change, from those pairs and their neighbours alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from suretygraph.operators.rings import _check, _product, account_pairs, list_blocks, triangles
from suretygraph.operators.skew import split_key
from suretygraph.schemas import PATH_COUNT
from suretygraph.storage import written

#: Edges of a pair from its lower end to its upper one and back, before and after.
COUNTS = ("up0", "down0", "up1", "down1")
WAYS = tuple((f"up{k}", f"down{k}", f"out{k}", f"into{k}") for k in (0, 1))


def cycle_count_change(pairs: DataFrame, *, mode: str = "latest", min_len: int = 2, max_len: int = 3) -> DataFrame:
    """One row, ``cycle_count_change``: closed paths after less closed paths before, every start counted.

    ``pairs`` has a row for each unordered pair, ``lo`` <= ``hi``, with ``COUNTS`` (a self-loop's edges in ``up``). It needs the
    pairs that changed and all others at either end of one; more do no harm. Paths without a changed pair cancel out.

    The pairs are written when this is called, as several parts read them. Triangles come from lists of neighbours of higher
    rank, as those of ``rings`` do: a hub's pairs are held at their other ends, and no open two-edge path is emitted.
    """
    _check(mode, min_len, max_len)
    pairs = written(pairs.select("lo", "hi", *COUNTS))
    temporal = mode == "temporal"
    loop = F.col("lo") == F.col("hi")
    loops, sides = pairs.filter(loop), pairs.filter(~loop)

    def of_loop(n: int) -> DataFrame:
        """Paths of n edges, all of one self-loop, each of them another edge."""
        falling = lambda c: _product(*[F.greatest(F.col(c) - k, F.lit(0)) for k in range(n)])
        return loops.select((falling("up1") - falling("up0")).alias("x"))

    found = []
    if min_len <= 1:
        found.append(of_loop(1))
    if min_len <= 2 <= max_len:
        both = lambda k: _product(F.lit(2), F.col(f"up{k}"), F.col(f"down{k}"))
        found.append(sides.select((both(1) - both(0)).alias("x")))
        if temporal:
            found.append(of_loop(2))
    if max_len == 3:
        found += [_triangles(sides, list_blocks(pairs)), _detours(sides, loops)]
        if temporal:
            found.append(of_loop(3))
    change = F.coalesce(F.sum(F.col("x").cast(PATH_COUNT)).cast(PATH_COUNT), F.lit(0).cast(PATH_COUNT))
    return reduce(DataFrame.unionByName, found).agg(change.alias("cycle_count_change"))


def pair_changes(before: DataFrame, after: DataFrame, mode: str = "latest") -> DataFrame:
    """Every pair of two edge tables with its ``COUNTS``."""
    numbered = [account_pairs(edges, mode).select("lo", "hi", F.col("up").alias(f"up{k}"), F.col("down").alias(f"down{k}"))
                for k, edges in enumerate((before, after))]
    joined = numbered[0].join(numbered[1], ["lo", "hi"], "full")
    return joined.select("lo", "hi", *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS])


def near_changes(pairs: DataFrame) -> DataFrame:
    """The pairs that changed and those at either end of one. The pairs are written when this is called: they are read three times."""
    pairs = written(pairs)
    changed = pairs.filter((F.col("up0") != F.col("up1")) | (F.col("down0") != F.col("down1")))
    ends = changed.select(F.explode(F.array("lo", "hi")).alias("id"))
    ends = ends.groupBy("id", split_key("id")).agg(F.count("*").alias("_n")).select("id")
    at_lo = pairs.join(ends.withColumnRenamed("id", "lo"), "lo", "left_semi")
    return at_lo.unionByName(pairs.join(ends.withColumnRenamed("id", "hi"), "hi", "left_semi")).distinct()


def halves(sides: DataFrame) -> DataFrame:
    """Each pair from both its ends: ``a``, ``b``, the edges ``out0``, ``in0``, ``out1``, ``in1`` seen from ``a``, and ``changed``."""
    ends = [
        F.struct(F.col(a).alias("a"), F.col(b).alias("b"), *[F.col(f"{c}{k}").alias(f"{name}{k}") for k in (0, 1) for c, name in ((there, "out"), (back, "in"))],
                 ((F.col("up0") != F.col("up1")) | (F.col("down0") != F.col("down1"))).alias("changed"))
        for a, b, there, back in (("lo", "hi", "up", "down"), ("hi", "lo", "down", "up"))
    ]
    return sides.select(F.inline(F.array(*ends)))


def _triangles(sides: DataFrame, blocks: int) -> DataFrame:
    """Triangles with a changed pair, from the sorted lists of ``rings.triangles``: each once, with the edges of its three sides."""
    sides_of = ("low_mid", "low_top", "mid_top")
    differs = [F.col(f"{side}.{name}0") != F.col(f"{side}.{name}1") for side in sides_of for name in ("out", "into")]

    def rings(k: int) -> Column:
        count = lambda way, side: F.col(f"{side}.{way}{k}")
        forward = _product(count("out", "low_mid"), count("out", "mid_top"), count("into", "low_top"))
        backward = _product(count("out", "low_top"), count("into", "mid_top"), count("into", "low_mid"))
        return _product(F.lit(3), (forward + backward).cast(PATH_COUNT))

    found = triangles(sides, blocks, WAYS).filter(reduce(Column.__or__, differs))
    return found.select((rings(1) - rings(0)).alias("x"))


def _detours(sides: DataFrame, loops: DataFrame) -> DataFrame:
    """A self-loop taken on the way round a mutual pair."""
    there = loops.select(F.col("lo").alias("a"), F.col("up0").alias("n0"), F.col("up1").alias("n1"))
    paths = lambda k: _product(F.lit(3), F.col(f"n{k}"), F.col(f"out{k}"), F.col(f"in{k}"))
    return halves(sides).join(there, "a").select((paths(1) - paths(0)).alias("x"))
