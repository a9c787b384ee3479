"""Exact quantiles of groups of any size, without a group in memory."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lambi.sources.shared import kept

#: Low bits that a round leaves aside: each looks at 12 to 14 more bits of the value.
SHIFTS = [50, 38, 26, 13, 0]
#: A bucket of at most so many values is sorted whole.
GATHER = 4096


def ordered_bits(x: Column) -> Column:
    """A long that orders as the double does (its bits; negative values negated; NaN last)."""
    size = F.abs(x)
    rough = F.greatest(F.floor(F.log2(size)), F.lit(-1022)).cast("int")
    ratio = size / F.pow(F.lit(2.0), rough)
    e = F.when(ratio >= 2, rough + 1).when((ratio < 1) & (rough > -1022), rough - 1).otherwise(rough)
    scaled = size / F.pow(F.lit(2.0), e)
    unit = F.lit(1 << 52).cast("long")
    bits = F.when(scaled >= 1, (e + 1023).cast("long") * unit + ((scaled - 1) * float(1 << 52)).cast("long")).otherwise((scaled * float(1 << 52)).cast("long"))
    beyond = F.lit(2047).cast("long") * unit
    finite = F.when(size == 0, F.lit(0).cast("long")).when(size == float("inf"), beyond).otherwise(bits)
    return F.when(F.isnan(x), beyond + 1).when(x < 0, -finite).otherwise(finite)


def quantiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str], q: float = 0.5) -> DataFrame:
    """The q-quantile of each column in each group of `keys`, interpolated between neighbours as
    `percentile` does.

    A round counts the values of a group by the leading bits of their ordered form, first of all, then
    of those in the one bucket that holds the place looked for; a bucket of one distinct value, or of
    few rows, ends the search. Only counts are shuffled (16,384 a group, column and task at most), so
    a group may hold nearly all rows. Nulls are left out, a group of nulls has null; a null in `keys`
    is a group. An empty table gives an empty result.
    """
    parts = [*keys, "column"]
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("column"), F.col(c).cast("double").alias("x")) for i, c in enumerate(columns))))
    values = df.select(*keys, each.alias("_v")).select(*keys, "_v.column", "_v.x").where("x is not null").withColumn("code", ordered_bits(F.col("x")))
    found = [F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")]
    place = lambda names: Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bucket = lambda shift: F.shiftright("code", shift).alias("bucket")

    def pick(counts: DataFrame, names: list[str]) -> DataFrame:
        """Of the buckets of each place looked for, the one that holds it."""
        at = counts.withColumn("before", F.coalesce(F.sum("n").over(place(names)), F.lit(0)))
        return at.where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("n")))

    def within(rows: DataFrame, targets: DataFrame, shift: int) -> DataFrame:
        """Values in the bucket of a target, with the target's end and place."""
        names = {c: f"_t_{c}" for c in (*parts, "bucket")}
        t = targets.select(*parts, "bucket", "end", "rest").withColumnsRenamed(names)
        on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in parts] + [F.shiftright("code", shift) == F.col("_t_bucket")])
        return rows.join(t, on).select(*parts, "end", "rest", "x", "code")

    counts = values.groupBy(*parts, bucket(SHIFTS[0])).agg(*found)
    position = (F.sum("n").over(Window.partitionBy(*parts)) - 1) * F.lit(float(q))
    ends = F.explode(F.array(F.struct(F.lit(0).alias("end"), F.floor("position").alias("rest")), F.struct(F.lit(1).alias("end"), F.ceil("position").alias("rest")))).alias("_e")
    placed = counts.withColumn("position", position).select("*", ends).select(*parts, "bucket", "n", "low", "high", "position", "_e.*")
    state = ["bucket", "n", "low", "high", "end", "rest"]
    chosen = kept(pick(placed, [*parts, "end"]).select(*parts, "position", *state[:-1], (F.col("rest") - F.col("before")).alias("rest")))
    positions = chosen.where("end = 0").select(*parts, "position")
    done = [chosen.where("low = high").select(*parts, "end", F.col("low").alias("value"))]
    open_ = chosen.where("low < high").select(*parts, *state)
    for before, shift in zip(SHIFTS, SHIFTS[1:]):
        few = open_.where(F.col("n") <= GATHER)
        sorted_ = within(values, few, before).groupBy(*parts, "end", "rest").agg(F.sort_array(F.collect_list("x")).alias("all"))
        done.append(sorted_.select(*parts, "end", F.get("all", F.col("rest").cast("int")).alias("value")))
        open_ = open_.where(F.col("n") > GATHER)
        if open_.isEmpty():
            break
        counts = within(values, open_, before).groupBy(*parts, "end", "rest", bucket(shift)).agg(*found)
        chosen = kept(pick(counts, [*parts, "end"]).select(*parts, *state[:-1], (F.col("rest") - F.col("before")).alias("rest")))
        done.append(chosen.where("low = high").select(*parts, "end", F.col("low").alias("value")))
        open_ = chosen.where("low < high")
    every = reduce(DataFrame.unionByName, done)
    renamed = positions.withColumnsRenamed({c: f"_p_{c}" for c in parts})
    pairs = every.groupBy(*parts).agg(F.max(F.when(F.col("end") == 0, F.col("value"))).alias("a"), F.max(F.when(F.col("end") == 1, F.col("value"))).alias("b"))
    pairs = pairs.join(renamed, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in parts]))
    value = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise((F.ceil("position") - F.col("position")) * F.col("a") + (F.col("position") - F.floor("position")) * F.col("b"))
    out = pairs.select(*parts, value.alias("value")).groupBy(*keys).agg(*(F.max(F.when(F.col("column") == i, F.col("value"))).alias(c) for i, c in enumerate(columns)))
    return out


def with_quantiles(groups: DataFrame, df: DataFrame, keys: Sequence[str], columns: dict[str, str], q: float = 0.5) -> DataFrame:
    """Groups (one row for each value of `keys`) with the quantiles of columns of `df`, each under the
    name that `columns` gives it; null where a group has no value."""
    found = quantiles(df, keys, list(columns), q).withColumnsRenamed({**{k: f"_q_{k}" for k in keys}, **{c: f"_q_{n}" for c, n in columns.items()}})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_q_{k}")) for k in keys])
    return groups.join(found, on, "left").withColumns({n: F.col(f"_q_{n}") for n in columns.values()}).drop(*(f"_q_{c}" for c in (*keys, *columns.values())))
