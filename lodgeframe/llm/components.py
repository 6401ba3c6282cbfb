"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.session import checkpointed


def _state(edges: DataFrame) -> tuple:
    """Equal for equal edge sets, whatever their order; sums wrap."""
    mixed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(mixed), F.bit_xor(F.xxhash64("b", mixed))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every linked node, root being the smallest node that can be reached.

    Links have no direction; loops and nulls are ignored, repeats are harmless. Every round is a
    minimum per node (combined before the shuffle) and a join on it. Minima and rounds are written to the
    checkpoint folder: that cuts the lineage, and a join of written tables can split a hub's links.
    An empty table gives no rows.
    """
    left, right = F.least(a, b), F.greatest(a, b)
    pairs = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = checkpointed(pairs.select(left.alias("a"), right.alias("b")).distinct())
    before = None
    while (now := _state(edges)) != before:
        before = now
        edges = checkpointed(_small_star(_large_star(edges)))
    roots = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    tops = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return roots.unionByName(tops)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    smaller = checkpointed(edges.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m")))
    tied = edges.join(smaller, edges["a"] == smaller["u"], "left")
    return tied.select(F.coalesce("m", "a").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    smallest = edges.groupBy("b").agg(F.min("a").alias("m"))
    tied = edges.join(smallest, "b")
    pairs = tied.select(F.col("m").alias("a"), "b").unionByName(
        tied.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    )
    return pairs.distinct()
