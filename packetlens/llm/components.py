"""Connected components of a graph given by its edges, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetlens.llm.common import stored


def _stars(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link the neighbours of each node to the least of them and the node itself: with
    ``larger_only`` the larger neighbours (large star), else the smaller ones (small star)."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if larger_only:
        both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u")
    if larger_only:
        pairs = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        pairs = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return pairs.where(F.col("a") > F.col("b")).distinct()


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root): every node of ``edges`` (columns a, b) and the least node it is connected
    with. Alternates large and small stars until nothing changes; each round is written to
    the shared folder, and only sums of hashes reach the driver."""
    ordered = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = stored(ordered, label), None
    while True:
        size = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 32))).first()
        if size == before:
            break
        before = size
        now = stored(_stars(_stars(now, True), False), label)
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root")))
