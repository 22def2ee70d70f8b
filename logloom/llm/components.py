"""Connected components over an edge table, by alternating large-star and small-star rounds.

Every round is two aggregations and two joins on node ids; nothing but counts reaches the driver.
A node with very many neighbours only shows up as a hot join key, which adaptive execution splits,
and as a hot group of a ``min``, which combines before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.session import drop_path, stage_at


def _minima(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the smallest node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _minima(both).select("u", F.least("u", "m").alias("m"))
    joined = both.filter("v > u").join(low, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked with the smallest of them."""
    joined = edges.join(_minima(edges), "u")
    moved = joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(joined.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge table."""
    digest = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(digest)).first())


def connected_components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(node, component) of every node that has an edge to another; component is the smallest node.

    Nodes are bigints; null ends and loops are left out. Without edges the result is empty.
    """
    u, v = F.col(left).cast("bigint"), F.col(right).cast("bigint")
    start = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter(
        u.isNotNull() & v.isNotNull() & (u != v)
    )
    found, path = stage_at(start.select("u", "v").distinct(), "edges")
    mark = _mark(found)
    while mark[0]:
        # The round before goes as soon as its follower is written.
        found, written = stage_at(_small_star(_large_star(found)), "edges")
        drop_path(edges.sparkSession, path)
        path, before, mark = written, mark, _mark(found)
        if mark == before:
            break
    roots = found.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return found.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
