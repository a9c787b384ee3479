"""Corpus profiles: sources, speakers, voices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lambi.operators.quantiles import quantiles, with_quantiles
from lambi.operators.rules import tier

REFERENCE_E8K = 1.66e-2


def _most_common(column: str):
    """The most common value; of equally common ones the smallest."""
    return F.expr(f"mode() WITHIN GROUP (ORDER BY {column})")


def profile(df: DataFrame, *keys: str) -> DataFrame:
    """Clips, dominant rate and format, medians, seconds, share of clipped clips, largest offset and
    bandwidth tier of each group. Measures that the table lacks are left out. Null measures are left
    out of their aggregates; a null key is a group; an empty table gives an empty result."""
    optional = {"fmt": _most_common("fmt").alias("fmt"), "clip_ratio": F.avg((F.col("clip_ratio") > 0.005).cast("double")).alias("clipped_share"), "dc_offset": F.max("dc_offset").alias("max_dc")}
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("clips"), _most_common("native_sr").alias("native_sr"), F.round(F.sum("duration"), 6).alias("total_s"), *(agg for c, agg in optional.items() if c in df.columns)
    )
    out = with_quantiles(out, df, keys, {c: n for c, n in {"e8k": "median_e8k", "duration": "median_s", "f999": "median_f999"}.items() if c in df.columns})
    return out.withColumn("tier", tier(F.col("native_sr"), F.col("median_e8k"))).withColumn("gap", F.lit(REFERENCE_E8K) / F.greatest("median_e8k", F.lit(1e-12)))


def profile_sets(df: DataFrame, sets: list[tuple[str, ...]]) -> DataFrame:
    """Profiles by several sets of keys in the same jobs, as grouping sets do: `set` is the number of
    the set, and keys that it lacks are null."""
    names = list(dict.fromkeys(c for keys in sets for c in keys))
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("set"), *((F.col(c) if c in keys else F.lit(None).cast(df.schema[c].dataType)).alias(c) for c in names)) for i, keys in enumerate(sets))))
    rows = df.select(each.alias("_set"), *(c for c in df.columns if c not in names))
    return profile(rows.select("_set.*", *rows.columns[1:]), "set", *names)


def synthesis_stats(df: DataFrame) -> DataFrame:
    """Clips, hours, median energy, most common rate and tier (of the median rate) of each source."""
    out = df.groupBy("source").agg(F.count(F.lit(1)).alias("clips"), F.round(F.sum("duration") / 3600, 6).alias("hours"), _most_common("native_sr").alias("native_sr"))
    out = with_quantiles(out, df, ["source"], {"e8k": "median_e8k", "native_sr": "median_sr"})
    return out.withColumn("tier", tier(F.col("median_sr"), F.col("median_e8k"))).drop("median_sr")


def rate_histogram(df: DataFrame) -> DataFrame:
    return df.groupBy("source", "native_sr").agg(F.count(F.lit(1)).alias("clips"))


def speaker_tiers(df: DataFrame) -> DataFrame:
    """Best tier of each speaker over its sources (median rate, median energy)."""
    per = quantiles(df, ["speaker", "source"], ["native_sr", "e8k"]).withColumnsRenamed({"native_sr": "sr", "e8k": "e"})
    return per.groupBy("speaker").agg(F.min(tier(F.col("sr"), F.col("e"))).alias("tier"))


def with_voice(df: DataFrame, voices: DataFrame) -> DataFrame:
    """Adds `voice`: the name whose id equals the row's speaker, else the one whose lower-cased id
    equals the speaker in lower case; null without either. `voices` is a small dimension."""
    spelled = voices.select("name", F.explode(F.array(F.struct(F.col("speaker_id").alias("id"), F.lit(0).alias("lower")), F.struct(F.lower("speaker_id").alias("id"), F.lit(1).alias("lower")))).alias("x"))
    ids = spelled.groupBy(F.col("x.id").alias("id")).agg(F.max_by("name", F.struct("x.lower", "name")).alias("voice"))
    exact = ids.select(F.col("id").alias("_exact"), F.col("voice").alias("_a"))
    folded = ids.select(F.col("id").alias("_folded"), F.col("voice").alias("_b"))
    found = df.join(exact, F.col("speaker") == F.col("_exact"), "left").join(folded, F.lower("speaker") == F.col("_folded"), "left")
    return found.withColumn("voice", F.coalesce("_a", "_b")).drop("_exact", "_folded", "_a", "_b")


def first_stage(tier_of_speaker: Column, tiers: tuple[str, ...] = ("A", "B", "C")) -> Column:
    """Whether a speaker's tier is eligible for the first stage: one of `tiers`, or D."""
    return tier_of_speaker.isin(*tiers, "D")


def second_stage(tier_of_clip: Column, source: Column, allowed: Column) -> Column:
    """Whether a clip is eligible for the second stage: tier A or B, and a source that its voice
    allows (an empty list allows all)."""
    return tier_of_clip.isin("A", "B") & ((F.size(allowed) == 0) | F.array_contains(allowed, source))


def style_verdict(cased: Column, punctuated: Column, least: float = 0.2) -> Column:
    return F.when((cased < least) | (punctuated < least), "MISMATCH").otherwise("OK")


def speaker_report(clips: DataFrame, voices: DataFrame) -> DataFrame:
    """Voice, clips, best tier and eligibility for both stages of each speaker (null: ``<none>``),
    in report order: named voices first, then by speaker."""
    named = clips.withColumn("speaker", F.coalesce("speaker", F.lit("<none>")))
    counts = named.groupBy("speaker").agg(F.count(F.lit(1)).alias("clips"))
    out = with_voice(counts.join(speaker_tiers(named), "speaker"), voices)
    out = out.select("speaker", "voice", "clips", F.col("tier").alias("best_tier"), first_stage(F.col("tier")).alias("stage1"), F.col("tier").isin("A", "B").alias("stage2"))
    return report_order(out, "voice", "speaker")


def report_order(df: DataFrame, named: str, key: str) -> DataFrame:
    """Rows with a name before rows without one, then by key."""
    return df.orderBy(F.col(named).isNull(), key)


def voice_stats(clips: DataFrame, voices: DataFrame, cap: int = 900, ready_from: int = 300) -> DataFrame:
    """Clips and hours of each voice, those eligible for the second stage (`cap` at most are used),
    and its status; voices without clips stay."""
    known = with_voice(clips, voices).where("voice is not null").join(voices.select(F.col("name").alias("voice"), "stage2_sources"), "voice")
    known = known.withColumn("tier", tier(F.col("native_sr"), F.col("e8k")))
    second = second_stage(F.col("tier"), F.col("source"), F.col("stage2_sources"))
    stats = known.groupBy(F.col("voice").alias("name")).agg(F.count(F.lit(1)).alias("clips"), F.sum("duration").alias("s"), F.sum(second.cast("long")).alias("n2"), F.min("tier").alias("tier"))
    capped = F.least(F.coalesce("n2", F.lit(0)), F.lit(cap))
    ready = F.col("stage2") & (capped >= ready_from)
    return voices.join(stats, "name", "left").select(
        "name", F.coalesce("clips", F.lit(0)).alias("clips"), F.round(F.coalesce("s", F.lit(0.0)) / 3600, 6).alias("hours"), capped.alias("stage2_clips"), "tier", ready.alias("ready"),
        F.when(ready, "PASS").when(F.col("stage2"), "THIN").otherwise("BLOCKED").alias("status"),
    )
