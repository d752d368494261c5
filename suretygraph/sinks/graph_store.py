"""The graph as published tables in hash buckets, so that a merge rewrites only what it touches.

``edges``: the latest edge of each ordered pair, by a hash of the pair. ``nodes``: the accounts, by a hash of the id.
``neighbours``: each pair from both its ends (``account``, ``other``, edges ``outgoing`` and ``incoming``), by a hash of the
account, so that all pairs of an account are in one bucket. The number of rings is noted with the edges and kept up by the
difference a merge makes.

The number of buckets belongs to the store and is noted at its first writing. Choose it by size: a bucket is what the smallest
merge rewrites. A bucket with a hub is large; it is written by as many tasks as its size calls for.

Edges are published last, and with them the count: a run that dies before leaves them as they were, and the next run, which
offers the same edges, finds the neighbours and nodes it lacks, or has already.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suretygraph import schemas
from suretygraph.operators import rings
from suretygraph.operators.graph import PAIR, connected, graph_nodes, upsert_edges
from suretygraph.operators.ring_change import cycle_count_change
from suretygraph.published import Published
from suretygraph.sinks.parquet import BUCKET, BUCKETS
from suretygraph.storage import written

_BUCKET = T.StructField(BUCKET, T.IntegerType())


@dataclass(frozen=True)
class GraphStore:
    path: str
    buckets: int = BUCKETS

    @property
    def edge_table(self) -> Published:
        return Published(f"{self.path}/edges", T.StructType([*schemas.GRAPH_EDGES.fields, _BUCKET]), (BUCKET,))

    @property
    def node_table(self) -> Published:
        return Published(f"{self.path}/nodes", T.StructType([*schemas.GRAPH_NODES.fields, _BUCKET]), (BUCKET,))

    @property
    def neighbour_table(self) -> Published:
        return Published(f"{self.path}/neighbours", T.StructType([*schemas.GRAPH_NEIGHBOURS.fields, _BUCKET]), (BUCKET,))

    def exists(self, spark: SparkSession) -> bool:
        return self.edge_table.snapshot(spark).number > 0

    def edges(self, spark: SparkSession) -> DataFrame:
        return self.edge_table.scan(spark).drop(BUCKET)

    def nodes(self, spark: SparkSession) -> DataFrame:
        return self.node_table.scan(spark).drop(BUCKET)

    def info(self, spark: SparkSession) -> dict:
        return self.edge_table.snapshot(spark).info

    def build(self, edges: DataFrame, info: dict | None = None) -> None:
        """A new graph of these edges; what was stored goes."""
        spark = edges.sparkSession
        edges, build = connected(edges), uuid4().hex
        self._publish_sides(edges, build)
        # An earlier count is no longer true.
        noted = {"buckets": self.buckets, "build": build, "cycle_count": None} | (info or {})
        self._publish(self.edge_table, self._placed(upsert_edges(edges.limit(0), edges), *PAIR), True, noted)
        self.cycle_count(spark)

    def _publish_sides(self, edges: DataFrame, build: str) -> None:
        self._publish(self.node_table, self._placed(graph_nodes(edges), "id"), True)
        self._publish(self.neighbour_table, self._placed(_both_ways(edges), "account"), True, {"build": build})

    def merge(self, offered: DataFrame, info: dict | None = None) -> None:
        """Merges edges into the stored ones, as ``upsert_edges`` does; only the buckets they fall in are read and rewritten.

        ``offered`` is read several times, so it should be a stored table. Numbers of buckets come to the driver, no rows.
        """
        spark = offered.sparkSession
        stored = GraphStore(self.path, self.info(spark).get("buckets", self.buckets))
        stored._merge(spark, connected(offered), info)

    def _merge(self, spark: SparkSession, offered: DataFrame, info: dict | None) -> None:
        count, build = self.cycle_count(spark), self.info(spark).get("build")
        if build is not None and self.neighbour_table.snapshot(spark).info.get("build") != build:
            # A new graph was begun and not finished: its neighbours aren't those of the edges.
            self._publish_sides(self.edges(spark), build)
        incoming = self._placed(offered, *PAIR)
        touched = _numbers(incoming)
        existing = self.edge_table.scan(spark, _among(touched)).drop(BUCKET)
        fresh = incoming.select(*PAIR).distinct().join(existing.select(*PAIR), list(PAIR), "left_anti")
        # Which pairs are new, from both ends, is needed for the neighbours, the nodes and the rings: written, it is worked out once.
        ends = written(self._placed(_both_ways(fresh), "account"))
        near, change = _numbers(ends), 0
        if near:
            known, around = (table.scan(spark, _among(near)) for table in (self.node_table, self.neighbour_table))
            after = around.unionByName(ends).groupBy("account", "other", BUCKET).agg(
                F.max("outgoing").alias("outgoing"), F.max("incoming").alias("incoming"))
            added = self._placed(ends.select(F.col("account").alias("id")).distinct(), "id").join(known.select("id"), "id", "left_anti")
            self._publish(self.node_table, known.unionByName(added), _among(near))
            self._publish(self.neighbour_table, after, _among(near))
            # The new neighbours are read back where they were just written.
            change = cycle_count_change(_before_and_after(self.neighbour_table.scan(spark, _among(near)), ends)).first()[0]
        merged = self._placed(upsert_edges(existing, offered), *PAIR)
        self._publish(self.edge_table, merged, _among(touched), {"cycle_count": str(count + int(change))} | (info or {}))

    def cycle_count(self, spark: SparkSession) -> int:
        """The noted number of closed paths of two and three edges; counted, and noted, if it isn't there."""
        noted = self.info(spark).get("cycle_count")
        if noted is None:
            noted = str(int(rings.cycle_count(self.edges(spark)).first()[0]))
            if self.exists(spark):
                self.edge_table.note(spark, {"cycle_count": noted})
        return int(noted)

    def _placed(self, rows: DataFrame, *keys: str) -> DataFrame:
        return rows.withColumn(BUCKET, self.bucket_of(*keys))

    def bucket_of(self, *keys: str) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def _publish(self, table: Published, rows: DataFrame, replaced, info: dict | None = None) -> None:
        table.publish(rows.select(*table.schema.names).hint("rebalance", BUCKET), replaced, info)


def _among(numbers: set[int]):
    return lambda part: int(part[BUCKET]) in numbers


def _numbers(placed: DataFrame) -> set[int]:
    return {r[0] for r in placed.select(BUCKET).distinct().collect()}


def _both_ways(edges: DataFrame) -> DataFrame:
    """Each pair from both its ends, a self-loop once, with 1 for each way there is an edge."""
    source, target = (F.col(c) for c in PAIR)
    there = F.struct(source.alias("account"), target.alias("other"), F.lit(1).alias("outgoing"), F.when(source == target, 1).otherwise(0).alias("incoming"))
    back = F.struct(target.alias("account"), source.alias("other"), F.when(source == target, 1).otherwise(0).alias("outgoing"), F.lit(1).alias("incoming"))
    ends = connected(edges).select(F.inline(F.array(there, back)))
    return ends.groupBy("account", "other").agg(F.max("outgoing").alias("outgoing"), F.max("incoming").alias("incoming"))


def _before_and_after(after: DataFrame, new: DataFrame) -> DataFrame:
    """The pairs at an end of a new edge, as ``cycle_count_change`` takes them: after the merge, and without what is new.

    Both ends of such a pair may be in ``after``, with the same numbers seen from either side; one of them is enough.
    """
    touched = new.select("account").distinct()
    mine = after.join(touched, "account", "left_semi").join(
        new.select("account", "other", F.col("outgoing").alias("new_out"), F.col("incoming").alias("new_in")), ["account", "other"], "left")
    low = F.col("account") <= F.col("other")
    out0 = F.col("outgoing") - F.coalesce("new_out", F.lit(0))
    in0 = F.col("incoming") - F.coalesce("new_in", F.lit(0))
    loop = F.col("account") == F.col("other")

    def way(lower: Column, upper: Column) -> Column:
        return F.when(low, lower).otherwise(upper)

    return mine.groupBy(F.least("account", "other").alias("lo"), F.greatest("account", "other").alias("hi")).agg(
        F.max(way(out0, in0)).alias("up0"), F.max(F.when(loop, 0).otherwise(way(in0, out0))).alias("down0"),
        F.max(way(F.col("outgoing"), F.col("incoming"))).alias("up1"),
        F.max(F.when(loop, 0).otherwise(way(F.col("incoming"), F.col("outgoing")))).alias("down1"))
