"""Connected components of an undirected graph by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import cut


def _symmetric(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour (itself included)."""
    both = _symmetric(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
    return linked.select("e.a", "e.b").where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges(a, b); a component is named by its least node.

    Each round is two shuffles of the edges with partial aggregation; the edges are checkpointed between rounds, and
    nothing but one count and one checksum comes to the driver. Self links are ignored: a node without another one
    doesn't appear. Ends when a round changes nothing, after a number of rounds logarithmic in the diameter.
    """
    current = cut(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct())
    seen = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == seen:
            break
        seen = state
        current = cut(_small_star(_large_star(current)))
    least = current.groupBy("b").agg(F.first("b").alias("component"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(least.select(F.col("b").alias("node"), "component")).distinct()
