"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and a checksum: equal marks mean equal edge sets."""
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least node around it."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them. Here u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with a link; component is the least node reachable.

    edges: two columns of longs; order, repeats and self links don't matter. Each round
    is two aggregations on the map side and two joins, never a list of neighbours, and is
    written to the shared folder. The number of rounds grows with the logarithm of the
    largest distance in a component.
    """
    u, v = (F.col(c) for c in edges.columns[:2])
    edges = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u > v").distinct()
    edges = stored(edges, "links")
    before = _mark(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges).distinct()).distinct(), "stars")
        now = _mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
