"""Connected components of links, by alternating star contractions in Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.session import stored


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """Hang neighbours on the smallest member of each neighbourhood: the larger ones, or those not larger."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not larger:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hung = both.join(least, "a")
    if larger:
        return hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    return (hung.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))).distinct()


def components(links: DataFrame, left: Column, right: Column) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node that has a link to another.

    Each round is written to shared storage, so a lost executor costs one round at most. A round
    moves at most as many rows as there are links; a neighbourhood is only ever aggregated, never
    gathered. Rounds grow with the logarithm of the longest chain.
    """
    at = stored(links.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b")).where("a > b").distinct(),
                "links")
    while not at.isEmpty():
        smaller = stored(_stars(_stars(at, True), False), "links")
        # Settled once all links lead from a node to a root that hangs on nothing.
        hanging = smaller.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        roots = smaller.select(F.col("b").alias("a")).distinct()
        unsettled = hanging.where("n > 1").select("a").unionByName(roots.join(hanging, "a", "left_semi"))
        at = smaller
        if unsettled.isEmpty():
            break
    stars = at.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
