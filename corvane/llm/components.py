"""Connected components by alternating large-star and small-star steps on DataFrames.

Neighbourhood minima are aggregates (combined before the shuffle) and reach the edges by equi-joins that
adaptive execution can split, so a node with very many neighbours never meets in one task. Every round is
checkpointed in the shared folder. Nothing but two numbers per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import cut


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
    return row[0], row[1]


def connected_components(links: DataFrame, left: str, right: str, most: int | None = None) -> DataFrame:
    """(node, root) for every node of a link other than a root; root is its component's smallest node.

    ``links``: two columns of one orderable type; direction, repeats, self-links and nulls do not matter.
    ``most``: a bound on their number, if one is known; it only sets how many files the first checkpoint takes.
    """
    pairs = links.select(F.col(left).alias("x"), F.col(right).alias("y")).filter("x <> y")
    edges = cut(pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), most)
    before = _digest(edges)
    while before[0]:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large-star: every larger neighbour of a node is linked to the node's smallest neighbour
        up = edges.select(F.col("b").alias("a"), F.col("a").alias("v")).join(low, "a")
        star = up.select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # small-star: a node and its smaller neighbours are linked to the smallest of them
        least = star.groupBy("a").agg(F.min("b").alias("m"))
        down = star.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(down.union(least.select("a", F.col("m").alias("b"))).distinct(), before[0])  # no step adds edges
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
