"""Curation of synthesis clips, and the blocks of the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lambi.functions.phonemes import phoneme_count
from lambi.operators import dedup, profile, rules, signal, splits
from lambi.operators.coverage import counts


def classify_synthesis(clips: DataFrame, key: str, wave: str, rate: str, said: str, order: list[str]) -> DataFrame:
    """(key, measures, n_phonemes, drop_reason): the first rule that each clip fails.

    Level, clipping, offset and noise are measured from the samples. Of the clips that pass, all but
    the first (in `order`) with the same samples and phonemes are duplicates. Samples are read once
    and only a digest and measures of them are shuffled. Keys must be distinct. A clip of no or null
    samples is undecodable; null phonemes are none.
    """
    spoken = F.coalesce(F.col(said), F.lit(""))
    content = F.md5(F.concat_ws("|", F.md5(F.array_join(F.transform(wave, lambda v: v.cast("string")), ",")), F.replace(spoken, F.lit(" "), F.lit(""))))
    facts = clips.select(key, *order, phoneme_count(spoken).alias("n_phonemes"), content.alias("_content"))
    df = facts.join(signal.measure(clips, key, wave, rate), key)
    reason = rules.first_failing(rules.synthesis_rules({c: F.col(c) for c in ("duration", "clip_ratio", "dc_offset", "snr", "n_phonemes")}))
    df = df.withColumn("drop_reason", reason)
    df = df.withColumn("_content", F.when(F.col("drop_reason").isNull(), F.col("_content")).otherwise(F.concat(F.lit("dropped "), F.col(key).cast("string"))))
    marked = dedup.mark_duplicates(df, "_content", order)
    return marked.withColumn("drop_reason", F.when(F.col("is_duplicate") & F.col("drop_reason").isNull(), "duplicate").otherwise(F.col("drop_reason"))).drop("is_duplicate", "_content")


def _hours(seconds: Column) -> Column:
    return F.round(F.coalesce(F.sum(seconds), F.lit(0.0)) / 3600, 6)


def prepare_report(rows: DataFrame, text: str = "text") -> dict[str, DataFrame]:
    """Blocks of a speech corpus: rows with source, duration, synthetic, drop_reason, split and the text,
    or, in its place, whether it is `cased` and `punctuated`.

    `drops`: clips by reason; `sources`: clips and hours kept; `splits`: the same by split; `totals`:
    clips, hours, real and synthetic hours; `style`: shares of cased and punctuated texts kept.
    """
    from lambi.functions.textnorm import is_cased, is_punctuated

    cased, punctuated = (F.col("cased"), F.col("punctuated")) if "cased" in rows.columns else (is_cased(F.col(text)), is_punctuated(F.col(text)))
    left = rows.where("drop_reason is null")
    clips, part = F.count(F.lit(1)).alias("clips"), lambda c: _hours(F.when(c, F.col("duration")))
    share = lambda c: F.round(F.coalesce(F.avg(c.cast("double")), F.lit(0.0)), 6)
    return {
        "drops": rows.where("drop_reason is not null").groupBy("drop_reason").agg(clips),
        "sources": left.groupBy("source").agg(clips, _hours(F.col("duration")).alias("hours")),
        "splits": left.groupBy("split").agg(clips, _hours(F.col("duration")).alias("hours")),
        "totals": left.agg(clips, _hours(F.col("duration")).alias("hours"), part(~F.col("synthetic")).alias("real_hours"), part(F.col("synthetic")).alias("synthetic_hours")),
        "style": left.agg(share(cased).alias("cased"), share(punctuated).alias("punctuated")),
    }


def audit_report(clips: DataFrame, voices: DataFrame, content: str = "audio_md5") -> dict[str, DataFrame]:
    """Blocks of an audit: `sources` (profiles), `rates` (clips by rate), `speakers` (with voices) and
    `duplicates` (contents that two sources share)."""
    return {"sources": profile.profile(clips, "source"), "rates": profile.rate_histogram(clips), "speakers": profile.speaker_report(clips, voices), "duplicates": dedup.duplicate_corpora(clips, "source", content)}


def synthesis_report(clips: DataFrame, voices: DataFrame, said: str = "phonemes") -> dict[str, DataFrame]:
    """Blocks of a synthesis corpus: `drops`, `sources` and `voices`, `speakers` with their index, and
    `phonemes` (counts over all that is kept)."""
    left = clips.where("drop_reason is null")
    return {
        "drops": clips.where("drop_reason is not null").groupBy("drop_reason").agg(F.count(F.lit(1)).alias("clips")),
        "sources": profile.synthesis_stats(left),
        "voices": profile.voice_stats(left, voices),
        "speakers": splits.dense_index(left, "speaker"),
        "phonemes": counts(left, F.filter(F.split(said, ""), lambda c: ~c.isin("", " ")), "phoneme"),
    }


def results_report(rates: DataFrame, tags: DataFrame, baseline: str, tuned: str) -> dict[str, DataFrame]:
    """Blocks of a benchmark: `results` (rates of each system and latency), `tags` and `comparison`."""
    from lambi.operators.scoring import compare_systems

    return {"results": rates, "tags": tags, "comparison": compare_systems(rates, baseline, tuned)}
