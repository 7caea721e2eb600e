"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fireledger.llm.scratch import forget, stored


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of the ``a, b`` links; root is the smallest node reached.

    A node with many links is only ever joined and aggregated, never gathered. Each
    round is stored, so a lost executor costs one round at most.
    """
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        # Two sums of 64-bit hashes tell whether the edges changed.
        sums = [F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0)) for h in (F.xxhash64("a", "b"), F.xxhash64(F.lit(1), "a", "b"))]
        size = edges.agg(F.count("*").alias("n"), sums[0].alias("s"), sums[1].alias("t")).first()
        if size == state or size["n"] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = size
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, edges = edges, stored(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct())
        forget(links.sparkSession, before)
