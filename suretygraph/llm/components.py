"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suretygraph.llm.staging import session_of, stored


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Ties each node's larger neighbours (large star) or smaller ones (small star) to its least one."""
    a, b = F.col("a"), F.col("b")
    if both:
        edges = edges.select(a, b).union(edges.select(b.alias("a"), a.alias("b")))
    else:
        edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    # The second key follows from the first: it makes the join shuffle anew, so that a node with very many links is split there.
    least = edges.groupBy("a", F.hash("a").alias("_split")).agg(F.least(F.min("b"), a).alias("least")).drop("_split")
    joined = edges.join(least, "a")
    if both:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            joined.select("a", F.col("least").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) of all nodes in links (a, b): the component is the least node reachable.

    Each round halves the distance to the least node or better, so the rounds grow with the logarithm of the
    longest chain. The edges of a round are written to the shared folder.
    """
    edges = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    before = None
    while True:
        edges = stored(_star(_star(edges, both=True), both=False), "stars")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    # All stars now: every node points to its least one.
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stored(nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct(), "components")


def empty_components(df: DataFrame) -> DataFrame:
    return session_of(df).createDataFrame([], "node long, component long")
