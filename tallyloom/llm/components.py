"""Connected components of a table of links, by rounds of joins and grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.durable import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node named in links (a, b); root is the smallest node it can reach.

    Large-star and small-star rounds: each node links its larger neighbours, then its smaller ones, to
    the smallest node it sees. Every round is written, so a lost executor costs no more than one round;
    rounds grow with the logarithm of the longest chain. A hot node's links meet only in aggregates with
    map-side combine and in inner joins that can be split.
    """
    edges = scratch.write(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.write(large, "large-star")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(down, "a")
        small = moved.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = scratch.write(small.union(down.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        if _same(edges, after):
            break
        edges = after
    return after.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        after.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _same(x: DataFrame, y: DataFrame) -> bool:
    """Whether two sets of links are equal, by count and an order-free sum of hashes."""
    sums = [df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() for df in (x, y)]
    return sums[0] == sums[1]
