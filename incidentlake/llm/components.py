"""Connected components of a link table, by alternating stars; nothing but sums reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(v, label) of every vertex with a link: the smallest vertex of its component.

    Each round hangs the larger neighbours of a vertex, then its smaller ones, on the smallest of all. A vertex with a
    third of all links meets the minimum in a join, so no group is gathered. Rounds grow with the logarithm of the vertices. Null ends and loops are ignored.
    """
    edges = cut(links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("w")).filter("u > w").distinct())
    state = None
    while True:
        around = edges.union(edges.select(F.col("w").alias("u"), F.col("u").alias("w")))
        low = around.groupBy("u").agg(F.min("w").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = around.filter("w > u").join(low, "u").select(F.col("w").alias("u"), F.col("m").alias("w")).filter("u > w").distinct()
        low = large.groupBy("u").agg(F.min("w").alias("m"))
        small = large.join(low, "u").select(F.greatest("w", "m").alias("u"), F.col("m").alias("w")).filter("u > w").union(low.select("u", F.col("m").alias("w")))
        edges = cut(small.distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "w").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("w").alias("v")).distinct().select("v", F.col("v").alias("label"))
    return edges.select(F.col("u").alias("v"), F.col("w").alias("label")).union(roots)
