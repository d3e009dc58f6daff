"""Connected components by repeated joins; the graph never leaves the executors.

Alternates the two steps of the published large-star / small-star method: every node links its
larger neighbours to the smallest node it knows, then its smaller neighbours. The number of
edges never grows, rounds grow with the logarithm of the longest path, and each round is
written to the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segrec.llm.common import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b) in both directions -> edges from neighbours to the smallest node known."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:  # each node with its smaller neighbours only
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    out = both.join(least, "a")
    if large:
        out = out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.where("a != b").distinct()


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` (node long) and ``edges`` (a, b) -> node, component (smallest node reached)."""
    edges = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where("a != b").distinct(), "edges")
    seen = None
    while True:
        edges = materialise(_star(_star(edges, large=True), large=False), "edges")
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    return nodes.join(edges.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"))


__all__ = ["connected_components"]
