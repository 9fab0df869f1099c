"""Connected components by alternating star operations (Kiveris et al., 2014), as DataFrame jobs.

Each round hangs every node under its smallest neighbour. Rounds are written to the shared checkpoint folder; only two
numbers per round come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from otelier.llm.staging import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Edges (a, b) in any direction: every larger neighbour of a node is linked with the node's least neighbour."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges from larger to smaller: a node and its smaller neighbours are linked with the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    hung = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return hung.unionAll(least.select("a", F.col("least").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the least node of its component. No edges, no rows."""
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.hash("a", "b")).alias("s")).first()
        if now == state or not now.n:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        state = now
        edges = staged(_small_star(_large_star(edges)).distinct(), "edges")
