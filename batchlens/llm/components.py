"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of the links (a, b); the root is the smallest node of its component.

    Each round hangs the larger neighbours of a node on its smallest neighbour (large star), then its smaller ones
    (small star), until nothing moves. Neighbours are never gathered: a node's smallest is an aggregate that combines
    before the shuffle, and joins bring it to the links. Each round is written out, so lineage stays short.
    """

    def smallest(edges: DataFrame) -> DataFrame:
        return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))

    def tidy(edges: DataFrame) -> DataFrame:
        """Each link once, larger node first."""
        return (
            edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .filter(F.col("u") != F.col("v"))
            .distinct()
        )

    edges = stage(tidy(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(smallest(both), "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = stage(tidy(large), "large-star")
        low = smallest(down)
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        edges = stage(tidy(small), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
