"""Connected components of a table of links, by alternating large-star and small-star rounds.

A large-star round ties every larger neighbour of a node to the smallest neighbour, a
small-star round every smaller one; both keep the components and shrink their depth, so a
few rounds (logarithmic in practice) leave stars around each component's smallest node. Every
round is written to the shared folder, which cuts the plan and survives a lost executor.
Hubs: minima are aggregated before the shuffle, and the joins back are left to the adaptive
splitting of skewed partitions. Nothing but a row count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewise.session import scratch_path


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """``pairs`` (a, b) seen from a: ties the chosen neighbours b to the smallest of a and its neighbours."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    tied = pairs.join(least, "a")
    chosen = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if larger else (
        tied.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b"))))
    return chosen.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node reachable."""
    spark = links.sparkSession

    def stored(df: DataFrame) -> tuple[DataFrame, tuple]:
        path = scratch_path(spark, "links")
        df.write.parquet(path)
        back = spark.read.parquet(path)
        mark = back.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return back, tuple(mark)

    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, mark = stored(ordered)
    while mark[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        after, new_mark = stored(_star(_star(both, larger=True), larger=False))
        if new_mark == mark:
            break
        now, mark = after, new_mark
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b"), F.col("b")).distinct())
