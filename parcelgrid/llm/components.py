"""Connected components of a graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelgrid.llm.common import materialize


def _hang(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """Edges (v, m) for every pair (u, v), m being the least of u and all its ``edges``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    moved = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the least node reachable.

    Each round hangs larger neighbours, then smaller ones, on a node's least neighbour
    (large-star, small-star), until nothing moves: about log2 of the longest path in rounds,
    never more edges than before. Every round is written to the scratch folder. An empty
    graph gives an empty result; loops and repeated edges do not matter.
    """
    down = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    edges = materialize(edges.where("u != v").select(*down).distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        large = _hang(both, both.where("v > u"))
        # large holds (larger, least); each node with its smaller neighbours and itself
        large = large.select(*down).distinct()
        small = _hang(large, large.select("u", "v").union(large.select("u", F.col("u").alias("v"))))
        edges = materialize(small.select(*down).distinct(), "edges")
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == state:
            break
        state = mark
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select("root", "root")).distinct()
