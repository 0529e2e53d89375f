"""Connected components of an undirected graph by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.base import stored


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """The smallest of each node's smaller neighbours; ``b`` is the smaller end of an edge."""
    return edges.groupBy("a").agg(F.min("b").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours point to the smallest of the node and its neighbours."""
    low = _least_neighbour(edges).withColumnRenamed("a", "b")
    return edges.join(low, "b", "left").select("a", F.coalesce("low", "b").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the smallest of them."""
    low = F.col("low").alias("b")
    moved = F.array(F.struct("a", low), F.struct(F.col("b").alias("a"), low))
    return edges.join(_least_neighbour(edges), "a").select(F.inline(moved)).where("a <> b").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, which has none; then nothing moves any more."""
    ends = F.array(*(F.struct(F.col(end).alias("node"), F.lit(int(up)).alias("up"), F.lit(int(not up)).alias("down")) for end, up in (("a", True), ("b", False))))
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 OR up = 1 AND down = 1").isEmpty()


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it reaches) for every node of ``edges`` (a, b).

    Nodes may be of any ordered type. Loops, repeated and reversed edges are allowed, edges with a
    null end are left out, and an empty frame gives an empty one. Either half of a round is written to the
    shared folder, as is the result: lineage and plans stay short, which the driver's memory needs. A hub's rows
    are joined, not gathered, so it can be split.
    """
    edges = (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges = stored(edges, "components")
    while not _are_stars(edges):
        large = stored(_large_star(edges), "components-large")
        edges = stored(_small_star(large), "components")
    named = F.array(*(F.struct(F.col(end).alias("node"), F.col("b").alias("root")) for end in ("a", "b")))
    return stored(edges.select(F.inline(named)).distinct(), "components-nodes")
