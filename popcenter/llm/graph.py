"""Connected components of an edge list by alternating large-star and small-star steps
(Kiveris et al., "Connected Components in MapReduce and Beyond")."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcenter.session import checkpoint


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root (the smallest node of its component) for every node of an edge; a node with
    edges to itself only is left out. Each round is pre-aggregated sums and equi-joins over the
    edges, written to the checkpoint folder; the driver gets two numbers."""
    e = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e, state = checkpoint(e), None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
        # large star: every larger neighbour goes to the smallest one
        large = e.select(F.col("u").alias("big"), F.col("v").alias("u")).join(low, "u").select(
            F.col("big").alias("u"), F.col("low").alias("v")).distinct()
        # small star: the node and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).where(F.col("u") != F.col("v")) \
            .unionByName(least.select("u", F.col("low").alias("v"))).distinct()
        e = checkpoint(small)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
