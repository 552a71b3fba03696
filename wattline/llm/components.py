"""Connected components of a distributed edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import stored


def _sign(edges: DataFrame) -> tuple:
    """Tells edge tables apart without their rows."""
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def stars(edges: DataFrame) -> DataFrame:
    """(u, v) links to (u, v) where v is the least id of u's component; the least ids have no row.

    Large-star and small-star steps in turn: each links ids to the least of their neighbours by a minimum
    that is combined before the shuffle, so no neighbourhood meets in one task. Each round is written,
    which cuts the lineage. Rounds grow with the logarithm of the longest chain.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()
    edges = stored(edges, "links")
    sign = _sign(edges)
    while sign[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "links-least")
        large = edges.select(F.col("u").alias("w"), F.col("v").alias("u")).join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u != v").distinct(), "links-large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "links-least")
        small = large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        small = small.filter("u != v").unionByName(least.select("u", F.col("m").alias("v")))
        edges = stored(small.distinct(), "links")
        now = _sign(edges)
        if now == sign:
            break
        sign = now
    return edges
