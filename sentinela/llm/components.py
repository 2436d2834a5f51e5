"""Connected components of an edge table by alternating large and small stars.

Every round is two joins of the edges with one minimum per node, so a node
with millions of neighbours costs one partial aggregate, and AQE can split its
edges in the join.  The number of rounds is logarithmic in practice.  Each
round is cut with a reliable checkpoint, so a lost executor never replays
earlier rounds.  No edge reaches the driver: only a count and a checksum do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.partitions import pin


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """``u > v`` in every edge: link the smaller neighbours of ``u``, and ``u``, to the smallest."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, root`` for every node of ``edges(u BIGINT, v BIGINT)``; the root is
    the smallest node of its component.  Self loops, repeated edges and both
    directions are allowed; nulls are dropped.  An empty table gives an empty one.
    Raises when ``max_rounds`` do not suffice (never a partial result)."""
    start = (edges.filter("u IS NOT NULL AND v IS NOT NULL AND u != v")
             .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state, current = None, pin(start)
    for _ in range(max_rounds):
        now = _state(current)
        if now == state or now[0] == 0:
            roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
            own = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return roots.unionByName(own)
        state, current = now, pin(_small_star(_large_star(current)))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
