"""Connected components by alternating star contraction: joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from folioweave.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, from undirected edges (a, b).

    Large stars hang every larger neighbour on a node's smallest neighbour, small stars every
    smaller one; both are one partially aggregated minimum and one join on the node, whose
    hot partitions adaptive execution splits. Rounds end when the edge set no longer changes,
    which the sums of its hashes tell.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(
            F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
            .where("a <> b").distinct())
        edges = stored(small)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
