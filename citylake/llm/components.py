"""Connected components of an edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import staged

EDGE = "u bigint, v bigint"


def _toward_minimum(edges: DataFrame) -> DataFrame:
    """Every edge (u, v) with the smallest neighbour of u, or u itself.

    The minimum is an aggregate that combines before the shuffle, and the join back is one that AQE splits
    where a node has very many edges; no node's neighbours are gathered.
    """
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _toward_minimum(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    linked = _toward_minimum(edges)
    moved = linked.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(linked.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and a mark of their set, to see whether a step changed anything."""
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u, 7L))")).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node that has an edge.

    ``edges`` holds ``u`` and ``v`` (long). Loops and repeated edges do no harm; no edges give no rows. The number
    of steps grows with the logarithm of the largest component. Each step's edges are a written table.
    """
    ordered = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = staged(ordered, "edges")
    mark = _mark(now)
    while mark[0]:
        now = staged(_small_star(_large_star(now)), "edges")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    to_root = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return to_root.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
