"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capsieve.llm.store import written


def _stars(both: DataFrame, keep_larger: bool) -> DataFrame:
    """both: (u, v). Links of u to the smallest node around it; the minimum is a map-side combined aggregate."""
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u")
    if keep_larger:
        return joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    down = joined.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return down.unionByName(least.where("u != m").select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """links (a, b) of long -> (id, component): every linked node with the smallest node that it reaches.

    Each round writes its links, at most as many as there were, to the shared folder. Rounds go on until nothing changes,
    which takes about the logarithm of the longest chain.
    """
    links = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = None
    while True:
        both = links.selectExpr("a u", "b v").unionByName(links.selectExpr("b u", "a v"))
        large = _stars(both, True).where("a != b").distinct()
        small = _stars(large.selectExpr("greatest(a, b) u", "least(a, b) v"), False)
        links = written(small.where("a != b").selectExpr("greatest(a, b) a", "least(a, b) b").distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    ends = links.selectExpr("a id", "b component")
    return ends.unionByName(ends.selectExpr("component id", "component").distinct())
