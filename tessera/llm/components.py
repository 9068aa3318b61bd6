"""Connected components by distributed union-find (alternating star
contractions), used by the near-duplicate operators.

A *large star* step hangs every larger neighbour of a node on the node's
smallest neighbour; a *small star* step does so for the smaller neighbours.
Alternated until nothing changes, they leave one edge from each node to the
smallest node of its component. Each step is one aggregation and one join on
the node, so a hub is one row on the aggregated side and its many edges can
be split over tasks; no component is ever collected anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.llm.util import deleted, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of canonical edges ``(a, b)`` with ``a < b``."""
    if large:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        near = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    out = near.join(least, "u")
    if large:
        moved = out.where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        moved = out.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
            least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return moved.where("a < b").distinct()


def _is_forest(edges: DataFrame) -> bool:
    """Whether every node hangs on one root and no root hangs on anything."""
    nodes = edges.select(F.col("a").alias("n"), F.lit(1).alias("root"), F.lit(0).alias("hung")) \
        .unionByName(edges.select(F.col("b").alias("n"), F.lit(0).alias("root"), F.lit(1).alias("hung")))
    nodes = nodes.groupBy("n").agg(F.max("root").alias("root"), F.sum("hung").alias("hung"))
    return not nodes.where("hung > 1 or root = 1 and hung > 0").take(1)


def components(edges: DataFrame) -> DataFrame:
    """Rows ``(node, root)`` for every node of the undirected ``edges(a, b)``;
    ``root`` is the smallest node of the component. Any ordered type works.

    Nulls and self-loops are ignored, repeated edges collapse, no edges give
    an empty result. The loop ends when the edges are stars; the number of
    rounds is logarithmic in the size of a component. Of the rounds, only the
    last one's edges stay on disk, until the result is released.
    """
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")) \
        .where("a < b").distinct()
    e = stored(e, "edges")
    while not _is_forest(e):
        last, e = e, stored(_star(_star(e, True), False), "edges")
        deleted(last)
    out = e.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        e.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()
    out.stored_at = e.stored_at
    return out
