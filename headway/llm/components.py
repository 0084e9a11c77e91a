"""Connected components of an undirected graph, by alternating large-star and small-star steps.

Each step is a grouping and a join on one key. A vertex of any degree is handled: its minimum is pre-aggregated in each task,
and joined back by a broadcast of the few vertices that hold much of all edges. The number of rounds grows with the logarithm of the graph, not with its diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import forget, stored


# A vertex with more than this share of all edges gets its minimum by a broadcast; there are at most twice as many of
# them as shares in the whole, as each edge has two ends.
HEAVY_SHARE = 1 / 64
LEAST_HEAVY = 100


def _with_least(edges: DataFrame, least: DataFrame, total: int) -> DataFrame:
    """``edges`` with the ``least`` of their vertex ``a``. Edges of the few heavy vertices stay in the tasks they are in."""
    bound = total * HEAVY_SHARE
    known, heavy = least.select("a", "least"), least.filter(F.col("degree") > max(bound, LEAST_HEAVY)).select("a", "least")
    if heavy.isEmpty():
        return edges.join(known, "a")
    marked = edges.join(F.broadcast(heavy), "a", "left")
    return marked.filter("least IS NOT NULL").unionByName(marked.filter("least IS NULL").drop("least").join(known, "a"))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Connect each vertex's larger neighbours with the smallest of the vertex and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"), F.count("*").alias("degree")), "minima")
    found = _with_least(both, least, total).filter("b > a")
    larger = stored(found.select(F.col("b").alias("a"), F.col("least").alias("b")), "edges")
    forget(least)
    return larger


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Connect each vertex and its smaller neighbours with the smallest of them. Edges run from larger to smaller."""
    least = stored(edges.groupBy("a").agg(F.min("b").alias("least"), F.count("*").alias("degree")), "minima")
    inner = _with_least(edges, least, total).filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    smaller = stored(inner.unionByName(least.select("a", F.col("least").alias("b"))).distinct(), "edges")
    forget(least)
    return smaller


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every vertex that is not the smallest of its component; ``edges`` has columns a and b.

    Loops, repeated edges and edges with a null end are of no effect; no edges give an empty table. The search ends when a
    step has left every edge as it was.
    """
    ordered = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stored(ordered.distinct(), "edges")
    total, moving = current.count(), True
    while total and moving:
        larger = _large_star(current, total)
        following = _small_star(larger, total)
        count = following.count()
        # Both are sets: of equal size, they are equal if none of the new edges is new.
        moving = count != total or not following.join(current, ["a", "b"], "left_anti").isEmpty()
        forget(larger)
        forget(current)
        current, total = following, count
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
