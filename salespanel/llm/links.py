"""Connected components of links between keys, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """key, root (the least key that can be reached) of every key in links (a, b) of comparable
    keys; neither may be null. A round sends every key's larger neighbours to the least key
    around it, then its smaller ones. Rounds grow with the logarithm of the longest path. A hub
    is one row after the sums; joins on it can be split."""
    edges = cut_lineage(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.select(F.col("u").alias("a"), F.col("v").alias("b")).union(
            edges.select(F.col("v").alias("a"), F.col("u").alias("b"))
        )
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = cut_lineage(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("u").alias("key"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("key"), F.col("v").alias("root")).distinct())
