"""Character, token and phoneme coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lambi.functions.phonemes import PHONEMES


def counts(df: DataFrame, items: Column, name: str = "item", top: int | None = None, keys: tuple[str, ...] = (), weight: str | None = None) -> DataFrame:
    """How often each item of an array column occurs (in rows that stand for `weight` rows each); the
    most common `top`, ties by value. Null arrays hold nothing."""
    n = F.count(F.lit(1)) if weight is None else F.sum("_times")
    times = [] if weight is None else [F.col(weight).alias("_times")]
    out = df.select(*keys, *times, F.explode(items).alias(name)).groupBy(*keys, name).agg(n.alias("n"))
    return out if top is None else out.orderBy(F.desc("n"), name).limit(top)


def token_report(df: DataFrame, text: str, tokens: str, unknown: int, weight: str | None = None) -> DataFrame:
    """One row: tokens, words, tokens per word, unknown tokens and their rate, and a verdict; ratios
    of nothing are 0. A null text has neither words nor tokens, as has an empty table.

    `tokens` is an array column of any tokenizer: of structs with id, start and end in characters.
    Rows stand for `weight` rows each.
    """
    words = F.size(F.filter(F.split(F.trim(F.col(text)), r"\s+"), lambda w: w != ""))
    total = lambda c: F.coalesce(F.sum(F.when(F.col(text).isNotNull(), c if weight is None else c * F.col(weight))), F.lit(0).cast("long"))
    out = df.agg(total(F.size(tokens)).alias("tokens"), total(words).alias("words"), total(F.size(F.filter(tokens, lambda t: t["id"] == unknown))).alias("unknown"))
    ratio = lambda a, b, digits: F.when(F.col(b) > 0, F.round(F.col(a) / F.col(b), digits)).otherwise(0.0)
    out = out.withColumn("tokens_per_word", ratio("tokens", "words", 3)).withColumn("unknown_rate", ratio("unknown", "tokens", 6))
    return out.withColumn("verdict", F.when((F.col("unknown_rate") > 0.001) | (F.col("tokens_per_word") > 4), "REVIEW").otherwise("OK"))


def unknown_pieces(df: DataFrame, text: str, tokens: str, unknown: int, top: int = 20, weight: str | None = None) -> DataFrame:
    """Most common pieces of the text under unknown tokens (``<empty-span>`` without characters)."""
    span = lambda t: F.when(t["end"] > t["start"], F.substring(F.col(text), t["start"] + 1, t["end"] - t["start"])).otherwise("<empty-span>")
    return counts(df, F.transform(F.filter(tokens, lambda t: t["id"] == unknown), span), "piece", top, weight=weight)


def inventory(df: DataFrame) -> DataFrame:
    """The phoneme characters and marks that a model knows, as a table."""
    known = sorted(set("".join(PHONEMES.values()) + ".,!?;:"))
    return df.sparkSession.createDataFrame([(c,) for c in known], "phoneme string")


def phoneme_report(df: DataFrame, said: str, rare_below: int = 50, keys: tuple[str, ...] = (), weight: str | None = None, known: DataFrame | None = None) -> DataFrame:
    """Count of each phoneme character (by group of `keys`), whether the inventory holds it and whether
    it is rare. `known` is an inventory (a column `phoneme`) other than the whole one; rows stand for
    `weight` rows each."""
    seen = counts(df, F.filter(F.split(said, ""), lambda c: ~c.isin("", " ")), "phoneme", keys=keys, weight=weight)
    held = (inventory(df) if known is None else known).select("phoneme").distinct().withColumn("_known", F.lit(True))
    out = seen.join(held, "phoneme", "left").withColumn("known", F.coalesce("_known", F.lit(False))).drop("_known")
    return out.withColumn("rare", F.col("known") & (F.col("n") < rare_below) & ~F.col("phoneme").rlike("[.,!?;:]"))


def unknown_phonemes(report: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Produced phonemes that the inventory lacks, most common first."""
    held = inventory(report) if known is None else known
    return report.select("phoneme", "n").join(held.select("phoneme"), "phoneme", "left_anti").orderBy(F.desc("n"), "phoneme")


def rare_phonemes(report: DataFrame, top: int = 20) -> DataFrame:
    """The rarest known phonemes, with the report's groups."""
    out = report.where("rare").drop("known", "rare")
    return out.orderBy("n", "phoneme", *(c for c in out.columns if c not in ("n", "phoneme"))).limit(top)


def phoneme_verdict(report: DataFrame) -> DataFrame:
    """One row: distinct phonemes, those outside the inventory, rare ones, and PASS or FAIL."""
    missing = F.coalesce(F.sum((~F.col("known")).cast("long")), F.lit(0))
    out = report.agg(F.count(F.lit(1)).alias("distinct_phonemes"), missing.alias("unknown"), F.coalesce(F.sum(F.col("rare").cast("long")), F.lit(0)).alias("rare"))
    return out.withColumn("verdict", F.when(F.col("unknown") == 0, "PASS").otherwise("FAIL"))
