"""Length-conditioned vector tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def length_table(refs: DataFrame, targets: int, least: int = 5, spread: float = 0.2, floor: int = 3) -> DataFrame:
    """(target, dim, value): mean vector of the references near each target length.

    `refs` has id, length and vec. Near is |length - target| <= max(floor, spread * target); a
    target with fewer than `least` takes the `least` nearest (ties by id).

    References are summed per length first. Lengths lie in unit bins, and a target is joined by
    equality to each bin of its range. The nearest few come from the `least` shortest and longest
    references of each bin, as a target lies in no bin's interior.
    """
    spark = refs.sparkSession
    goal = spark.range(1, targets + 1).select(F.col("id").cast("int").alias("target"))
    flat = refs.select("id", "length", F.posexplode("vec").alias("dim", "x"))
    sums = flat.groupBy("length", "dim").agg(F.sum(F.col("x").cast("double")).alias("s"), F.count(F.lit(1)).alias("n"))
    sizes = refs.groupBy("length").agg(F.count(F.lit(1)).alias("refs")).withColumn("bin", F.floor("length"))
    width = F.greatest(F.lit(float(floor)), F.lit(spread) * F.col("target"))
    bins = goal.select("target", width.alias("width"), F.explode(F.sequence(F.floor(F.col("target") - width), F.floor(F.col("target") + width))).alias("bin"))
    near = bins.join(sizes, "bin").where(F.abs(F.col("length") - F.col("target")) <= F.col("width")).select("target", "length", "refs")
    enough = near.groupBy("target").agg(F.sum("refs").alias("hits")).where(F.col("hits") >= least).select("target")
    wide = near.join(enough, "target", "left_semi").join(sums, "length").groupBy("target", "dim").agg((F.sum("s") / F.sum("n")).alias("value"))
    short = goal.join(enough, "target", "left_anti")
    placed = refs.select("id", "length", F.floor("length").alias("bin"))
    edge = lambda order: placed.withColumn("rank", F.row_number().over(Window.partitionBy("bin").orderBy(order, "id"))).where(F.col("rank") <= least).drop("rank")
    ends = edge(F.asc("length")).union(edge(F.desc("length"))).distinct()
    pairs = ends.withColumn("target", F.explode(F.sequence(F.lit(1), F.lit(targets)))).join(F.broadcast(short), "target")
    apart = F.abs(F.col("length") - F.col("target"))
    close = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("target").orderBy(apart, "id"))).where(F.col("rank") <= least)
    few = close.select("target", "id").join(flat, "id").groupBy("target", "dim").agg(F.avg(F.col("x").cast("double")).alias("value"))
    return wide.unionByName(few)


def smooth_table(table: DataFrame, width: int = 15) -> DataFrame:
    """Centred moving average over targets, per dimension; the ends repeat the first and last row."""
    half = width // 2
    w = Window.partitionBy("dim").orderBy("target")
    inside = w.rowsBetween(-half, half)
    every = Window.partitionBy("dim").orderBy("target").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place, n = F.row_number().over(w), F.count(F.lit(1)).over(every)
    before, after = F.greatest(F.lit(0), half - (place - 1)), F.greatest(F.lit(0), place + half - n)
    total = F.sum("value").over(inside) + before * F.first("value").over(every) + after * F.last("value").over(every)
    return table.withColumn("smooth", total / width).select("target", "dim", F.col("smooth").alias("value"))


def check_table(table: DataFrame, decays: tuple[float, float] = (1.8, 8.0), cosines: tuple[float, float] = (0.05, 0.9)) -> DataFrame:
    """One row: norms of the first and last row, their ratio and cosine, warnings and a verdict."""
    ends = table.agg(F.min(F.struct("target")).alias("lo"), F.max(F.struct("target")).alias("hi"))
    of = lambda end: table.join(F.broadcast(ends.select(F.col(f"{end}.target").alias("target"))), "target").select("dim", F.col("value").alias(end))
    x = of("lo").join(of("hi"), "dim", "full")
    out = x.agg(F.sqrt(F.sum(F.col("lo") ** 2)).alias("first_norm"), F.sqrt(F.sum(F.col("hi") ** 2)).alias("last_norm"), F.sum(F.col("lo") * F.col("hi")).alias("dot"))
    wrong = table.agg(F.coalesce(F.sum((F.isnan("value") | F.col("value").isNull() | (F.abs("value") == float("inf"))).cast("long")), F.lit(0)).alias("bad"))
    out = out.join(F.broadcast(wrong)).withColumn("decay", F.col("first_norm") / F.greatest("last_norm", F.lit(1e-9))).withColumn("cosine", F.col("dot") / F.greatest(F.col("first_norm") * F.col("last_norm"), F.lit(1e-9)))
    outside = lambda c, span: ~F.coalesce(F.col(c).between(*span), F.lit(False))
    notes = F.array_compact(F.array(F.when(F.col("bad") > 0, "values are not finite"), F.when(outside("decay", decays), f"norm decay is outside {decays}"), F.when(outside("cosine", cosines), f"cosine of the ends is outside {cosines}")))
    return out.select(*(F.round(c, 5).alias(c) for c in ("first_norm", "last_norm", "decay", "cosine")), notes.alias("warnings"), F.when(F.size(notes) == 0, "PASS").otherwise("SUSPECT").alias("verdict"))
