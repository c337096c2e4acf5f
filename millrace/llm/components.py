"""Connected components of an edge list by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.session import materialise


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One contraction: neighbours of a node are tied to the least node among them and itself.

    The large star moves the neighbours above the node, the small star those below it and
    the node. Least neighbours are found with a combined aggregate, so a hub of any degree
    is one row per task, and the join that follows is one that Spark can split.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    seen = both.filter("b < a") if small else both
    least = seen.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    tied = seen.join(least, "a")
    moved = tied.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if small:
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    else:
        moved = tied.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) for every node of the edges (a, b).

    Every round is written to the shared folder, so a lost executor costs no more than
    the round. Rounds grow with the logarithm of the longest path.
    """
    edges = materialise(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges"
    )
    mark = None
    while True:
        edges = materialise(_stars(_stars(edges, small=False), small=True), "stars")
        # one row: equal sums of 64-bit hashes mean that nothing moved
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
