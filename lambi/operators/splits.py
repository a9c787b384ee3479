"""Splits, samples and oversampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lambi.functions.textnorm import hash_bucket
from lambi.operators.running import running
from lambi.sources.shared import kept


def hash_split(key: Column, val: float, test: float) -> Column:
    u = hash_bucket(key)
    return F.when(u < test, "test").when(u < test + val, "val").otherwise("train")


def seeded(key: Column, seed: int | str) -> Column:
    """Order that stands for a seeded shuffle."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def group_split(df: DataFrame, group: str, duration: str, val: float, test: float, seed: int = 1804) -> DataFrame:
    """Whole groups to test, then val, up to 1.15 of the target hours; the rest to train.

    Groups come in seeded order; one goes to a split that has not reached its target if it stays
    within 1.15 of it. A group of at most 0.15 of a target always fits there, so only the few larger
    ones (at most total / (0.15 target) of them) come to the driver, each with the running sum of the
    small ones before it. The small ones fill test up to one place of the order and val up to another;
    both places are minima over the running sums.
    """
    order = seeded(F.col(group), seed)
    sums = df.groupBy(group).agg(F.sum(duration).cast("double").alias("d")).select(F.col(group), "d", order.alias("o"))
    total = sums.agg(F.sum("d")).first()[0] or 0.0
    goal = {"test": test * total, "val": val * total}
    large = 0.15 * min((g for g in goal.values() if g > 0), default=float("inf"))
    is_small = F.col("d") <= large
    ranked = kept(running(sums.withColumn("_small", F.when(is_small, F.col("d")).otherwise(0.0)), ["o"], value="_small"))
    own = {"test": 0.0, "val": 0.0}  # hours of large groups
    full: dict[str, tuple[int, float]] = {}  # number from which on a split takes no small group, and their sum before
    given: list[tuple[int, str]] = []

    def room(name: str, before: float) -> float:
        """What a split lacks, if all small groups summed in `before` have found their place."""
        start = 0.0 if name == "test" else full["test"][1] if "test" in full else before
        return goal[name] - own[name] - (before - start)

    def settle(before: float, number: int) -> None:
        """Find where splits fill up among the small groups before `number`."""
        for name in ("test", "val"):
            if name in full or (name == "val" and "test" not in full):
                continue
            start = (0, 0.0) if name == "test" else full["test"]
            if goal[name] <= own[name]:
                full[name] = start
            elif room(name, before) <= 0:
                ends = F.col("before") + F.col("_small")
                at = ranked.where(is_small & (F.col("number") >= start[0]) & (F.col("number") < number) & (ends >= goal[name] - own[name] + start[1]))
                found = at.agg(F.min(F.struct("number", ends.alias("ends"))).alias("m")).first()["m"]
                if found is not None:
                    full[name] = (found["number"] + 1, found["ends"])

    for r in ranked.where(~is_small).select("number", "d", "before").orderBy("number").collect():
        settle(r["before"], r["number"])
        fits = (n for n in ("test", "val") if n not in full and room(n, r["before"]) > 0 and r["d"] <= room(n, r["before"]) + 0.15 * goal[n])
        name = next(fits, None)
        if name is not None:
            given.append((r["number"], name))
            own[name] += r["d"]
            if room(name, r["before"]) <= 0 and (name == "test" or "test" in full):
                full[name] = (r["number"], r["before"])
    settle(ranked.agg(F.sum("_small")).first()[0] or 0.0, 1 << 62)
    to_test = full["test"][0] if "test" in full else 1 << 62
    to_val = full["val"][0] if "val" in full else 1 << 62
    split = F.when(F.col("number") < to_test, "test").when(F.col("number") < to_val, "val").otherwise("train")
    chosen = F.lit("train")
    for number, name in given:
        chosen = F.when(F.col("number") == number, name).otherwise(chosen)
    return df.join(ranked.select(group, F.when(is_small, split).otherwise(chosen).alias("split")), group)


def split_corpus(df: DataFrame, path: str, group: str, duration: str, synthetic: str, val: float = 0.1, test: float = 0.1, by_group: bool = True, seed: int = 1804) -> DataFrame:
    """Split real rows (by group if every row has one and both splits get rows, else by hash of the
    path), keep synthetic rows in train. A corpus without real rows is an error. The column
    `split_mode` says how: ``group`` or ``hash``."""
    real = df.where(~F.col(synthetic))
    counts = real.agg(F.count(F.lit(1)).alias("n"), F.count(group).alias("g")).first()
    if not counts["n"]:
        raise ValueError("all rows are synthetic: nothing can be held out")
    done, mode = None, "hash"
    if by_group and counts["n"] == counts["g"]:
        done, mode = group_split(real, group, duration, val, test, seed), "group"
        if done.where("split <> 'train'").select("split").distinct().count() < 2:
            done, mode = None, "hash"
    if done is None:
        done = real.withColumn("split", hash_split(F.col(path), val, test))
    rest = df.where(F.col(synthetic)).withColumn("split", F.lit("train"))
    return done.unionByName(rest.select(done.columns)).withColumn("split_mode", F.lit(mode))


def oversample(df: DataFrame, weight: Column, split: str = "split") -> DataFrame:
    """Repeat rows of train max(1, weight rounded half to even) times."""
    times = F.when(F.col(split) == "train", F.greatest(F.lit(1), F.bround(weight).cast("int"))).otherwise(1)
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), times)))


def holdout(df: DataFrame, path: str, synthetic: str, most: int = 400, seed: int = 1804) -> DataFrame:
    """Paths held out of the real rows: min(most, max(1, rows // 10)) of them in seeded order."""
    real = df.where(~F.col(synthetic))
    n = min(most, max(1, real.count() // 10))
    return real.orderBy(seeded(F.col(path), seed), path).limit(n).select(path)


def capped_groups(df: DataFrame, group: str, path: str, cap: int = 900, least_val: int = 10, ready_from: int = 300, seed: int = 1804) -> DataFrame:
    """At most `cap` rows a group in seeded order; the first max(least_val, n // 20) are val."""
    w = Window.partitionBy(group)
    ranked = df.withColumn("rank", F.row_number().over(w.orderBy(seeded(F.col(path), seed), path))).where(F.col("rank") <= cap)
    sized = ranked.withColumn("n", F.count(F.lit(1)).over(w))
    return sized.withColumn("split", F.when(F.col("rank") <= F.greatest(F.lit(least_val), F.floor(F.col("n") / 20)), "val").otherwise("train")).withColumn("ready", F.col("n") >= ready_from)


def dense_index(df: DataFrame, column: str) -> DataFrame:
    """0-based rank of each distinct value that is not null."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    return running(values, [column]).select(column, F.col("number").alias("index"))
