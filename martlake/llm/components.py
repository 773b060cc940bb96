"""Connected components over an edge list by alternating large-star and small-star steps.

Both steps are plain joins and aggregations; labels never leave Spark.  A round halves
tree depth, so the number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martlake.llm._common import staged


def _large_star(e: DataFrame) -> DataFrame:
    # every neighbour larger than u is linked to the smallest of u and its neighbours
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    # u (the larger end) and its smaller neighbours are linked to the smallest of them
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``edges(a, b)`` (longs, any direction, repeats and loops allowed) to
    ``(node, component)``: one row per node that has an edge, with the smallest node
    reachable.  Empty edges give an empty table; null ends are dropped."""
    e = staged(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
               .filter("a is not null and b is not null and a <> b").distinct(), "cc-edges")
    if e.isEmpty():
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(max_rounds):
        nxt = staged(_small_star(_large_star(e)), "cc-step")
        # a fixed point is a forest of stars: no centre hangs below another node, and every
        # node has one centre (a node of two centres still joins their stars)
        hung = nxt.join(nxt.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        e = nxt
        if hung.isEmpty() and nxt.groupBy("a").count().filter("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("components did not converge")
    stars = e.groupBy("a").agg(F.min("b").alias("component"))
    return (stars.select(F.col("a").alias("node"), "component")
            .union(stars.select(F.col("component").alias("node"), "component").distinct()))
