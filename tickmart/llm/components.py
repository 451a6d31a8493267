"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import written
from .skew import threshold


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges (a, b): component is the smallest node that its links reach.

    Each step ties a node's neighbours to its smallest one, so the rounds grow with the log of the longest path. Every
    round is a table in the shared folder; only a count and a checksum reach the driver. The smallest neighbours of nodes
    with very many neighbours are broadcast (their number has a bound, see skew), so a hub is no task's work. No edges give an
    empty result; loops and repeated edges change nothing.
    """

    def with_least(edges: DataFrame, least: DataFrame, n: int) -> DataFrame:
        """edges (u, v) with m of their u."""
        if n <= threshold(n, thin=True):
            return edges.join(least.drop("degree"), "u")
        hub = F.col("degree") > threshold(n, thin=True)
        hubs, others = F.broadcast(least.where(hub).drop("degree")), least.where(~hub).drop("degree")
        return edges.join(hubs, "u").unionByName(edges.join(hubs, "u", "left_anti").join(others, "u"))

    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark, n = None, now.count()
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree")).withColumn("m", F.least("m", "u"))
        large = with_least(both.where("v > u"), least, n).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree"))
        small = with_least(large, low, n).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        now = written(small.where("u <> v").distinct())
        row = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (row["n"], row["s"]) == mark:
            break
        mark, n = (row["n"], row["s"]), row["n"]
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
