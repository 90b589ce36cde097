"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cxpulse.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to the smallest node around u."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    return both.join(least, both["u"] == least["c"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
    linked = down.join(least, down["u"] == least["c"])
    near = linked.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("c", "m")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v; long, not null): root is
    the smallest node reachable, itself included. No edges, no rows.

    Each round is written to the shared folder. Minima are partial
    aggregates and the joins are plain equi-joins that AQE can split, so a
    node with very many links is no bottleneck. Ends when a round changes nothing.
    """
    edges = materialise(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        n, s = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, s) == state or n == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        state = (n, s)
        edges = materialise(_small_star(_large_star(edges)), "stars")
