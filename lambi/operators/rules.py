"""First-failing-rule filters, tiers, verdicts and record checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bandwidth energy limits and lowest native rate of a tier.
TIER_A, TIER_B, TIER_RATE = 5e-3, 5e-4, 22050
LATENCY_FRAMES = {80: 0, 320: 3, 560: 6, 1120: 13}


def first_failing(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule whose condition is true, null for rows that pass."""
    out = F.lit(None).cast("string")
    for name, fails in reversed(rules):
        out = F.when(fails, name).otherwise(out)
    return out


def speech_rules(text: Column, duration: Column, min_s: float = 0.5, max_s: float = 18.0, max_rate: float = 25.0, foreign: Column | None = None, keep_empty: bool = False) -> list[tuple[str, Column]]:
    """Rules of a speech-to-text corpus, in their order; bounds themselves pass."""
    rate = F.when(duration > 0, F.length(text) / duration).otherwise(F.lit(float("inf")))
    rules = [("undecodable_audio", duration.isNull())]
    rules += [] if keep_empty else [("empty_text", text == "")]
    rules += [] if foreign is None else [("out_of_charset", F.size(foreign) > 0)]
    return [*rules, ("too_short", duration < min_s), ("too_long", duration > max_s), ("implausible_chars_per_second", rate > max_rate)]


def synthesis_rules(m: dict[str, Column], min_s: float = 1.0, max_s: float = 12.0) -> list[tuple[str, Column]]:
    """Rules of a synthesis corpus over clip_ratio, dc_offset, duration, snr and n_phonemes."""
    rate = F.when(m["duration"] > 0, m["n_phonemes"] / m["duration"]).otherwise(F.lit(float("inf")))
    return [
        ("undecodable_audio", m["duration"].isNull()), ("clipped", m["clip_ratio"] > 0.005), ("dc_offset", m["dc_offset"] > 0.005), ("too_short", m["duration"] < min_s), ("too_long", m["duration"] > max_s),
        ("low_snr", m["snr"] < 15), ("too_few_phonemes", m["n_phonemes"] < 5), ("too_many_phonemes", m["n_phonemes"] > 400), ("implausible_phoneme_rate", rate > 22),
    ]


def tier(native_sr: Column, e8k: Column) -> Column:
    return F.when(native_sr < TIER_RATE, "D").when(e8k >= TIER_A, "A").when(e8k >= TIER_B, "B").otherwise("C")


def truncated(text: Column, duration: Column, limit: float = 16.0) -> Column:
    return F.when(duration > 0, F.length(text) / duration > limit).otherwise(True)


def clamp(value: Column, low: float, high: float, default: float) -> tuple[Column, Column]:
    """(value, error): null becomes the default, a non-number or NaN an error."""
    number = value.try_cast("double")
    bad = value.isNotNull() & (number.isNull() | F.isnan(number))
    return F.when(~bad, F.least(F.lit(high), F.greatest(F.lit(low), F.coalesce(number, F.lit(default))))), F.when(bad, "must be a number")


def context_frames(latency_ms: Column) -> tuple[Column, Column]:
    table = F.create_map(*[F.lit(v) for kv in LATENCY_FRAMES.items() for v in kv])
    out = F.try_element_at(table, latency_ms.cast("int"))
    return out, F.when(out.isNull(), "unknown latency")


def decode_payload(payload: Column) -> tuple[Column, Column]:
    """(bytes, error) of a base64 payload, with or without a data: prefix."""
    raw = F.try_to_binary(F.regexp_replace(payload, "^data:[^,]*,", ""), F.lit("base64"))
    return raw, F.when(raw.isNull(), "invalid base64")


EMAIL = r"^[^\s@]+@[^\s@]+\.[^\s@]+$"


def signup(df: DataFrame) -> DataFrame:
    """Trimmed and cut sign-up fields (email, note, use_case) and whether the address is valid."""
    cut = lambda c, n: F.substring(F.trim(F.coalesce(F.col(c), F.lit(""))), 1, n)
    email = F.trim(F.coalesce("email", F.lit("")))
    return df.withColumn("email", email).withColumn("note", cut("note", 1000)).withColumn("use_case", cut("use_case", 80)).withColumn("valid", F.col("email").rlike(EMAIL))
