"""Connected components of large link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lambi.llm.shared import cut


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the data: never broadcast, as that takes it through the driver."""
    return df.hint("merge")


def components(links: DataFrame, large: bool = False) -> DataFrame:
    """(node, component) of every node with a link, component being the smallest node reachable.
    For `large` tables no join broadcasts.

    Alternates large-star and small-star steps (Kiveris et al. 2014) until the links stop to
    change (after about log^2 n rounds at most). Each step is a grouped minimum and a join; minima are written before they are joined,
    so that Spark can split the rows of a node with very many links over several tasks.
    """
    a, b = links.columns
    side = shuffled if large else lambda df: df
    at = cut(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    state = None
    while True:
        both = at.select(F.col("a").alias("u"), F.col("b").alias("v")).union(at.select("b", "a"))
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        upper = cut(both.join(side(least), "u").where((F.col("v") > F.col("u")) & (F.col("v") != F.col("m"))).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        lower = cut(upper.groupBy("a").agg(F.min("b").alias("m")))
        small = upper.join(side(lower), "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        at = cut(small.union(lower.select("a", F.col("m").alias("b"))).distinct())
        now = at.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return at.select(F.col("a").alias("node"), F.col("b").alias("component")).union(at.select(F.col("b"), F.col("b")).distinct())
