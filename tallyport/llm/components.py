"""Connected components of a table of links, by joins and sums only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (smallest id that links reach) of every id in ``links`` (columns ``a`` and ``b``).

    Alternates two steps until nothing changes: every id points its larger neighbours at the smallest id it
    sees, then its smaller ones. Both keep what is connected connected; what remains are stars around
    the smallest id of each component. The number of rounds grows with the logarithm of the longest path. A
    step needs the smallest neighbour per id, which is summed before the shuffle; no neighbour list is gathered.
    """
    edges = cut_lineage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        )
        edges = cut_lineage(small)
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.countDistinct("u")).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
