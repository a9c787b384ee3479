"""Keep-first deduplication and duplicate corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mark_duplicates(df: DataFrame, key: str, order: list[str], into: str = "is_duplicate") -> DataFrame:
    """True for rows that are not the first of their key in the order.

    The first is a grouped minimum (combined before the shuffle) joined back, not a window, so that
    one key with very many rows is neither sorted nor held in one task.
    """
    first = df.groupBy(key).agg(F.min(F.struct(*order)).alias("_first"))
    joined = df.join(first, df[key].eqNullSafe(first[key])).drop(first[key])
    return joined.withColumn(into, F.struct(*order) != F.col("_first")).drop("_first")


def duplicate_corpora(df: DataFrame, source: str, key: str) -> DataFrame:
    """Shared keys of each pair of sources and their share of either side."""
    sets = df.select(F.col(source).alias("s"), F.col(key).alias("k")).where("k is not null").distinct()
    sizes = sets.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    both = sets.alias("a").join(sets.alias("b"), F.expr("a.k = b.k and a.s < b.s")).groupBy(F.col("a.s").alias("a"), F.col("b.s").alias("b")).agg(F.count(F.lit(1)).alias("overlap"))
    out = both.join(sizes.select(F.col("s").alias("a"), F.col("n").alias("n_a")), "a").join(sizes.select(F.col("s").alias("b"), F.col("n").alias("n_b")), "b")
    return out.select("a", "b", "overlap", (F.col("overlap") / F.col("n_a")).alias("share_a"), (F.col("overlap") / F.col("n_b")).alias("share_b"))
