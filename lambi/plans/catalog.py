"""Queries over the given tables, and SQL for those that DuckDB can express."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lambi.functions import phonemes as ph
from lambi.functions import textnorm as tn
from lambi.functions.pieces import UNKNOWN, tokenizer, word_counts
from lambi.operators import coverage, dedup, profile, rules, scoring, signal, splits, vectors
from lambi.operators.running import running
from lambi.plans.fixtures import CLIPS_SQL, LONG_WAVES_SQL, NOISY_SQL, NORM_SQL, PAIRS_SQL, SENTENCE_PAIRS_SQL, clips, deletion_pairs, every_latency, long_waves, noisy, pairs, refs, sentence_pairs, table, waves
from lambi.sources import tables as src
from lambi.sources.shared import kept
from lambi.streaming.quota import quota_batch

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
MIN_S, MAX_S = 0.5, 600.0
VOICES = [("one", "spk1", True, ["src1", "src2", "src4"]), ("two", "spk2", True, ["src2"]), ("three", "Spk3", True, []), ("four", "SPK4", True, ["src7"]), ("five", "spk5", False, []), ("six", "absent", False, [])]
WEIGHTS = {"src1": 2.5, "src2": 1.5}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


@query("normalize_text", f"SELECT doc_id, {NORM_SQL.format('text')} AS norm FROM documents")
def normalize_text(spark, sf):
    return _docs(spark, sf).select("doc_id", tn.normalize(F.col("text")).alias("norm"))


@query("normalize_noisy", f"SELECT doc_id, {NORM_SQL.format('text')} AS norm FROM ({NOISY_SQL})")
def normalize_noisy(spark, sf):
    return noisy(spark, sf).select("doc_id", tn.normalize(F.col("text")).alias("norm"))


_OUTSIDE = r"regexp_replace(text, '[a-zA-ZàèéòùÀÈÉÒÙ0-9 .,?!''\-:;\"()%&/]', '', 'g')"


@query("charset_audit", f"SELECT ch, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(string_split({_OUTSIDE}, '')) AS ch FROM documents WHERE {_OUTSIDE} <> '') GROUP BY ch ORDER BY n DESC, ch LIMIT 30")
def charset_audit(spark, sf):
    return coverage.counts(_docs(spark, sf), tn.out_of_charset(F.col("text")), "ch", 30)


@query("style_stats", r"SELECT round(avg(CASE WHEN regexp_matches(text, '\p{Lu}') THEN 1.0 ELSE 0.0 END::DOUBLE), 9) AS cased_ratio, round(avg(CASE WHEN regexp_matches(text, '[.!?,]') THEN 1.0 ELSE 0.0 END::DOUBLE), 9) AS punctuated_ratio FROM documents")
def style_stats(spark, sf):
    return _docs(spark, sf).agg(F.round(F.avg(tn.is_cased(F.col("text")).cast("double")), 9).alias("cased_ratio"), F.round(F.avg(tn.is_punctuated(F.col("text")).cast("double")), 9).alias("punctuated_ratio"))


ENCODABLE = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789éèòàù.,?!'-"


@query("vocab_sanitize", r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate(text, ':;', ',,'), '…', '...', 'g'), '[/\\|_]', ' ', 'g'), '[^a-zA-Z0-9éèòàù.,?!''\-\s]', '', 'g'), '\s+', ' ', 'g')) AS clean FROM documents""")
def vocab_sanitize(spark, sf):
    return _docs(spark, sf).select("doc_id", tn.sanitize(F.col("text"), ENCODABLE).alias("clean"))


@query("vocab_losses", r"SELECT ch, count(*) AS n FROM (SELECT unnest(string_split(regexp_replace(text, '[a-zA-Z0-9éèòàù.,?!''\-\s]', '', 'g'), '')) AS ch FROM documents) WHERE ch <> '' GROUP BY ch ORDER BY n DESC, ch LIMIT 30")
def vocab_losses(spark, sf):
    return coverage.counts(_docs(spark, sf), tn.unencodable(F.col("text"), ENCODABLE), "ch", 30)


def classified(spark: SparkSession, sf: str) -> DataFrame:
    """Clips with the first rule they fail, their split and style; later copies fail `duplicate`. Texts
    end in a hash. Duplicates are looked for in what is kept of the one pass over the texts."""
    df = clips(spark, sf).withColumn("text", tn.normalize(F.col("raw_text")))
    df = df.withColumn("drop_reason", rules.first_failing(rules.speech_rules(F.col("text"), F.col("duration"), MIN_S, MAX_S)))
    content = F.md5(F.concat_ws("|", "audio_md5", F.lower("text")))
    alone = F.concat(F.lit("dropped "), F.col("idx").cast("string"))
    facts = [splits.hash_split(F.col("path"), 0.1, 0.1).alias("split"), tn.is_cased(F.col("text")).alias("cased"), tn.is_punctuated(F.col("text")).alias("punctuated")]
    df = df.select("idx", "source", "source_ord", "duration", "synthetic", "drop_reason", *facts, F.when(F.col("drop_reason").isNull(), content).otherwise(alone).alias("content_key"))
    marked = dedup.mark_duplicates(kept(df), "content_key", ["source_ord", "idx"])
    return marked.withColumn("drop_reason", F.when(F.col("is_duplicate") & F.col("drop_reason").isNull(), "duplicate").otherwise(F.col("drop_reason"))).drop("is_duplicate", "content_key")


_CLASS = f"""c AS ({CLIPS_SQL}), n AS (SELECT *, {NORM_SQL.format('raw_text')} AS text FROM c),
r AS (SELECT *, CASE WHEN duration IS NULL THEN 'undecodable_audio' WHEN text = '' THEN 'empty_text' WHEN duration < {MIN_S} THEN 'too_short' WHEN duration > {MAX_S} THEN 'too_long'
      WHEN duration <= 0 OR length(text) / duration > 25.0 THEN 'implausible_chars_per_second' END AS reason FROM n),
k AS (SELECT *, CASE WHEN reason IS NULL AND row_number() OVER (PARTITION BY reason, audio_md5, lower(text) ORDER BY source_ord, idx) > 1 THEN 'duplicate' ELSE reason END AS drop_reason FROM r)"""


@query("drop_report", f"WITH {_CLASS} SELECT drop_reason, count(*) AS clips, round(sum(duration) / 3600, 6) AS hours FROM k GROUP BY drop_reason")
def drop_report(spark, sf):
    return classified(spark, sf).groupBy("drop_reason").agg(F.count(F.lit(1)).alias("clips"), F.round(F.sum("duration") / 3600, 6).alias("hours"))


@query("dedup_keep_first", f"WITH {_CLASS} SELECT idx, source, drop_reason FROM k")
def dedup_keep_first(spark, sf):
    return classified(spark, sf).select("idx", "source", "drop_reason")


@query("hours_per_source", f"WITH {_CLASS} SELECT source, count(*) AS clips, round(sum(duration) / 3600, 6) AS hours FROM k WHERE drop_reason IS NULL GROUP BY source")
def hours_per_source(spark, sf):
    return classified(spark, sf).where("drop_reason is null").groupBy("source").agg(F.count(F.lit(1)).alias("clips"), F.round(F.sum("duration") / 3600, 6).alias("hours"))


@query("corpus_totals", f"WITH {_CLASS} SELECT count(*) AS clips, round(sum(duration) / 3600, 6) AS hours, round(sum(duration) FILTER (NOT synthetic) / 3600, 6) AS real_hours, round(sum(duration) FILTER (synthetic) / 3600, 6) AS synthetic_hours FROM k WHERE drop_reason IS NULL")
def corpus_totals(spark, sf):
    part = lambda c: F.round(F.sum(F.when(c, F.col("duration"))) / 3600, 6)
    return classified(spark, sf).where("drop_reason is null").agg(F.count(F.lit(1)).alias("clips"), part(F.lit(True)).alias("hours"), part(~F.col("synthetic")).alias("real_hours"), part(F.col("synthetic")).alias("synthetic_hours"))


_BUCKET = "('0x' || substr(md5(path), 1, 8))::BIGINT / 4294967295.0::DOUBLE"
_SPLIT = f"CASE WHEN {_BUCKET} < 0.1 THEN 'test' WHEN {_BUCKET} < 0.2 THEN 'val' ELSE 'train' END"


@query("hash_split", f"WITH c AS ({CLIPS_SQL}) SELECT idx, {_SPLIT} AS split FROM c")
def hash_split(spark, sf):
    return clips(spark, sf).select("idx", splits.hash_split(F.col("path"), 0.1, 0.1).alias("split"))


_ORDER = "md5('1804|' || speaker)"
_GROUP = f"""d AS (SELECT speaker, sum(duration) AS d FROM c WHERE speaker IS NOT NULL AND NOT synthetic GROUP BY speaker), o AS (SELECT *, row_number() OVER (ORDER BY {_ORDER}) AS i, sum(d) OVER () AS total FROM d),
g AS (SELECT i, speaker, CASE WHEN d <= 1.15 * 0.1 * total THEN 'test' WHEN d <= 1.15 * 0.1 * total THEN 'val' ELSE 'train' END AS split, CASE WHEN d <= 1.15 * 0.1 * total THEN d ELSE 0 END AS t, 0::DOUBLE AS v FROM o WHERE i = 1
      UNION ALL SELECT o.i, o.speaker,
        CASE WHEN g.t + d <= 1.15 * 0.1 * total AND g.t < 0.1 * total THEN 'test' WHEN g.v + d <= 1.15 * 0.1 * total AND g.v < 0.1 * total THEN 'val' ELSE 'train' END,
        g.t + CASE WHEN g.t + d <= 1.15 * 0.1 * total AND g.t < 0.1 * total THEN d ELSE 0 END,
        g.v + CASE WHEN NOT (g.t + d <= 1.15 * 0.1 * total AND g.t < 0.1 * total) AND g.v + d <= 1.15 * 0.1 * total AND g.v < 0.1 * total THEN d ELSE 0 END
      FROM g JOIN o ON o.i = g.i + 1)"""


def _split_voiced(spark, sf):
    return splits.split_corpus(clips(spark, sf).where("speaker is not null"), "path", "speaker", "duration", "synthetic")


@query("group_split", f"WITH RECURSIVE c AS ({CLIPS_SQL}), {_GROUP} SELECT idx, speaker, CASE WHEN synthetic THEN 'train' ELSE split END AS split FROM c LEFT JOIN g USING (speaker) WHERE speaker IS NOT NULL")
def group_split(spark, sf):
    return _split_voiced(spark, sf).select("idx", "speaker", "split")


@query("synthetic_isolation", f"WITH c AS ({CLIPS_SQL}) SELECT CASE WHEN synthetic THEN 'train' ELSE {_SPLIT} END AS split, synthetic, count(*) AS clips FROM c GROUP BY ALL")
def synthetic_isolation(spark, sf):
    return splits.split_corpus(clips(spark, sf), "path", "speaker", "duration", "synthetic").groupBy("split", "synthetic").agg(F.count(F.lit(1)).alias("clips"))


@query("oversample", f"WITH c AS ({CLIPS_SQL}), s AS (SELECT *, CASE WHEN synthetic THEN 'train' ELSE {_SPLIT} END AS split FROM c) SELECT split, count(*) AS clips, round(sum(duration) / 3600, 6) AS hours FROM s, (VALUES (1), (2)) x(i) WHERE i = 1 OR (split = 'train' AND source IN ('src1', 'src2')) GROUP BY split")
def oversample(spark, sf):
    done = splits.split_corpus(clips(spark, sf), "path", "speaker", "duration", "synthetic")
    weights = spark.createDataFrame(list(WEIGHTS.items()), "source string, weight double")
    rows = splits.oversample(done.join(F.broadcast(weights), "source", "left"), F.coalesce("weight", F.lit(1.0)))
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("clips"), F.round(F.sum("duration") / 3600, 6).alias("hours"))


_HELD = f"c AS ({CLIPS_SQL}), h AS (SELECT path FROM c WHERE NOT synthetic ORDER BY md5('1804|' || path), path LIMIT (SELECT least(400, greatest(1, count(*) // 10)) FROM c WHERE NOT synthetic))"


@query("utterance_holdout", f"WITH {_HELD} SELECT idx, CASE WHEN path IN (FROM h) THEN 'val' ELSE 'train' END AS split FROM c")
def utterance_holdout(spark, sf):
    df = clips(spark, sf)
    held = splits.holdout(df, "path", "synthetic")
    train = df.join(held, "path", "left_anti").withColumn("split", F.lit("train"))
    return train.select("idx", "split").unionByName(df.join(held, "path", "left_semi").select("idx", F.lit("val").alias("split")))


@query("capped_group_sample", f"""WITH c AS ({CLIPS_SQL}), r AS (SELECT *, row_number() OVER (PARTITION BY speaker ORDER BY md5('1804|' || path), path) AS rank FROM c WHERE speaker IS NOT NULL), n AS (SELECT *, count(*) OVER (PARTITION BY speaker) AS n FROM r WHERE rank <= 20)
SELECT speaker, idx, CASE WHEN rank <= greatest(3, n // 20) THEN 'val' ELSE 'train' END AS split, n >= 10 AS ready FROM n""")
def capped_group_sample(spark, sf):
    return splits.capped_groups(clips(spark, sf).where("speaker is not null"), "speaker", "path", cap=20, least_val=3, ready_from=10).select("speaker", "idx", "split", "ready")


@query("train_sample", f"WITH {_HELD} SELECT path FROM c WHERE path NOT IN (FROM h) ORDER BY md5('7|' || path), path LIMIT 2000")
def train_sample(spark, sf):
    df = clips(spark, sf)
    train = df.join(splits.holdout(df, "path", "synthetic"), "path", "left_anti")
    return train.orderBy(splits.seeded(F.col("path"), 7), "path").limit(2000).select("path")


@query("speaker_index", f"WITH c AS ({CLIPS_SQL}) SELECT speaker, dense_rank() OVER (ORDER BY speaker) - 1 AS index FROM (SELECT DISTINCT speaker FROM c WHERE speaker IS NOT NULL)")
def speaker_index(spark, sf):
    return splits.dense_index(clips(spark, sf), "speaker").select("speaker", F.col("index").cast("long").alias("index"))


def _distance_sql(a: str, b: str, both: str) -> str:
    """Edit distance of two lists. DuckDB's takes single bytes, so it serves where the symbols of both fit
    into those of ASCII; beyond, the matrix is folded, a column for each symbol of the second list."""
    coded = lambda x: f"array_to_string(list_transform({x}, lambda x: chr(33 + list_position({both}, x)::INT)), '')"
    cell = f"list_append(c, least(c[len(c)] + 1, p.col[i[1] + 1] + 1, p.col[i[1]] + CASE WHEN {a}[i[1]] = q.sym THEN 0 ELSE 1 END))"
    column = f"list_reduce(list_transform(range(1, len({a}) + 1), lambda k: [k]), lambda c, i: {cell}, [p.col[1] + 1])"
    folded = f"list_reduce(list_transform({b}, lambda x: {{'col': []::BIGINT[], 'sym': x}}), lambda p, q: {{'col': {column}, 'sym': q.sym}}, {{'col': range(len({a}) + 1), 'sym': ''}})"
    return f"CASE WHEN len({both}) <= 94 THEN levenshtein({coded(a)}, {coded(b)}) ELSE ({folded}).col[len({a}) + 1] END"


_FORM = r"trim(regexp_replace(translate(lower(regexp_replace(nfc_normalize({0}), '<[a-z]{{2,3}}(-[A-Za-z]{{2,4}})?>', ' ', 'g')), '!\"#$%&''()*+,-./:;<=>?@[\]^_`{{|}}~«»…', ''), '\s+', ' ', 'g'))"
_SCORED = f"""p AS ({SENTENCE_PAIRS_SQL}), n AS (SELECT *, {_FORM.format('reference')} AS r, {_FORM.format('hypothesis')} AS h FROM p),
w AS (SELECT *, string_split(r, ' ') AS rw, list_filter(string_split(h, ' '), lambda x: x <> '') AS hw FROM n WHERE r <> ''), a AS (SELECT *, list_distinct(list_concat(rw, hw)) AS ab FROM w),
cc AS (SELECT *, list_distinct(list_concat(rc, hc)) AS cb FROM (SELECT *, string_split(r, '') AS rc, list_filter(string_split(h, ''), lambda x: x <> '') AS hc FROM a)),
s AS (SELECT *, {_distance_sql('rw', 'hw', 'ab')} AS word_edits, len(rw) AS words,
      {_distance_sql('rc', 'hc', 'cb')} AS char_edits, length(r) AS chars FROM cc)"""


@query("wer_cer", f"WITH {_SCORED} SELECT model, latency_ms, round(sum(word_edits) / sum(words), 5) AS wer, round(sum(char_edits) / sum(chars), 5) AS cer, count(*) AS clips FROM s GROUP BY ALL")
def wer_cer(spark, sf):
    return scoring.rates(every_latency(scoring.measured(sentence_pairs(spark, sf))), "model", "latency_ms")


@query("worst_clips", f"WITH {_SCORED} SELECT doc_id, round(word_edits / words, 4) AS wer FROM s WHERE model = 'baseline' AND latency_ms = 80 ORDER BY wer DESC, doc_id LIMIT 20")
def worst_clips(spark, sf):
    return scoring.worst(sentence_pairs(spark, sf).where("model = 'baseline'"), "doc_id").select("doc_id", "wer")


@query("document_error_rates")
def document_error_rates(spark, sf):
    return scoring.rates(every_latency(scoring.measured(pairs(spark, sf))), "model", "latency_ms")


_KEPT = "list_filter(list_transform(ws, lambda w, i: CASE WHEN i % k <> 0 THEN w END), lambda w: w IS NOT NULL)"


@query("document_deletions", f"""WITH d AS (SELECT string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ') AS ws FROM documents), p AS (SELECT model, ws, {_KEPT} AS kept FROM d, (VALUES ('baseline', 3), ('tuned', 7)) m(model, k)),
e AS (SELECT model, len(ws) AS words, length(array_to_string(ws, ' ')) AS chars, len(ws) - len(kept) AS word_edits, length(array_to_string(ws, ' ')) - length(array_to_string(kept, ' ')) AS char_edits FROM p WHERE len(ws) > 1 OR ws[1] <> '')
SELECT model, round(sum(word_edits) / sum(words), 5) AS wer, round(sum(char_edits) / sum(chars), 5) AS cer, count(*) AS clips FROM e GROUP BY model""")
def document_deletions(spark, sf):
    """Whole documents of which words are only lost, so that the distance is what the lengths differ by."""
    return scoring.rates(scoring.measured(deletion_pairs(spark, sf), aggressive=False, compose=False), "model")


@query("tags_emitted", f"WITH p AS ({PAIRS_SQL}) SELECT model, latency_ms, tag, count(*) AS n, lower(tag) <> '<ht-ht>' AS stray FROM (SELECT model, latency_ms, unnest(regexp_extract_all(hypothesis, '<[a-z]{{2,3}}(?:-[A-Za-z]{{2,4}})?>')) AS tag FROM p) GROUP BY ALL")
def tags_emitted(spark, sf):
    return scoring.tag_counts(every_latency(pairs(spark, sf)), "model", "latency_ms").withColumn("stray", F.lower("tag") != "<ht-ht>")


@query("system_compare", f"WITH {_SCORED}, e AS (SELECT model, latency_ms, round(sum(word_edits) / sum(words), 5) AS wer FROM s GROUP BY ALL) SELECT latency_ms, max(wer) FILTER (model = 'baseline') AS baseline_wer, max(wer) FILTER (model = 'tuned') AS tuned_wer, round(max(wer) FILTER (model = 'tuned') - max(wer) FILTER (model = 'baseline'), 5) AS delta FROM e GROUP BY latency_ms")
def system_compare(spark, sf):
    return scoring.compare_systems(wer_cer(spark, sf), "baseline", "tuned")


_TIER = "CASE WHEN {0} < 22050 THEN 'D' WHEN {1} >= 5e-3 THEN 'A' WHEN {1} >= 5e-4 THEN 'B' ELSE 'C' END"


def _mode_sql(keys: str, column: str) -> str:
    return f"SELECT {keys}, arg_min({column}, (-n, {column})) AS {column} FROM (SELECT {keys}, {column}, count(*) AS n FROM c GROUP BY ALL) GROUP BY {keys}"


def _profile_sql(*keys: str) -> str:
    k = ", ".join(keys)
    return f"""WITH c AS ({CLIPS_SQL}), m AS ({_mode_sql(k, 'native_sr')}), o AS ({_mode_sql(k, 'fmt')}),
    a AS (SELECT {k}, count(*) AS clips, median(e8k) AS median_e8k, median(duration) AS median_s, round(sum(duration), 6) AS total_s, median(f999) AS median_f999,
          round(avg((clip_ratio > 0.005)::INT), 9) AS clipped_share, max(dc_offset) AS max_dc FROM c GROUP BY {k})
    SELECT {k}, clips, native_sr, fmt, median_e8k, median_s, total_s, median_f999, clipped_share, max_dc, {_TIER.format('native_sr', 'median_e8k')} AS tier, round(1.66e-2 / greatest(median_e8k, 1e-12), 3) AS gap FROM a JOIN m USING ({k}) JOIN o USING ({k})"""


@query("source_profile", _profile_sql("source"))
def source_profile(spark, sf):
    return profile.profile(clips(spark, sf), "source").withColumn("gap", F.round("gap", 3)).withColumn("clipped_share", F.round("clipped_share", 9))


@query("speaker_source_profile", f"SELECT speaker, source, clips, native_sr, fmt, median_f999, tier FROM ({_profile_sql('speaker', 'source')})")
def speaker_source_profile(spark, sf):
    return profile.profile(clips(spark, sf).where("speaker is not null"), "speaker", "source").select("speaker", "source", "clips", "native_sr", "fmt", "median_f999", "tier")


def _set_sql(i: int, *keys: str) -> str:
    lacking = {"source", "speaker"} - set(keys)
    return f"SELECT {i} AS set, {', '.join(f'NULL::VARCHAR AS {k}' for k in lacking)}{', ' * bool(lacking)}{', '.join(keys)}, clips, native_sr, fmt, median_e8k, median_s, total_s, median_f999, tier FROM ({_profile_sql(*keys)})"


@query("profile_sets", f"FROM ({_set_sql(0, 'source')}) UNION ALL BY NAME FROM ({_set_sql(1, 'speaker', 'source')})".replace("FROM documents)", "FROM documents WHERE doc_id % 97 <> 0)"))
def profile_sets(spark, sf):
    out = profile.profile_sets(clips(spark, sf).where("speaker is not null"), [("source",), ("speaker", "source")])
    return out.select("set", "source", "speaker", "clips", "native_sr", "fmt", "median_e8k", "median_s", "total_s", "median_f999", "tier")


@query("synthesis_stats", f"""WITH c AS ({CLIPS_SQL}), m AS ({_mode_sql('source', 'native_sr')}), a AS (SELECT source, count(*) AS clips, round(sum(duration) / 3600, 6) AS hours, median(e8k) AS median_e8k, median(native_sr) AS sr FROM c GROUP BY source)
SELECT source, clips, hours, median_e8k, native_sr, {_TIER.format('sr', 'median_e8k')} AS tier FROM a JOIN m USING (source)""")
def synthesis_stats(spark, sf):
    return profile.synthesis_stats(clips(spark, sf))


@query("rate_histogram", f"WITH c AS ({CLIPS_SQL}) SELECT source, native_sr, count(*) AS clips FROM c GROUP BY ALL")
def rate_histogram(spark, sf):
    return profile.rate_histogram(clips(spark, sf))


@query("speaker_tier", f"WITH c AS ({CLIPS_SQL}), m AS (SELECT coalesce(speaker, '<none>') AS speaker, source, median(native_sr) AS sr, median(e8k) AS e FROM c GROUP BY ALL) SELECT speaker, min({_TIER.format('sr', 'e')}) AS tier FROM m GROUP BY speaker")
def speaker_tier(spark, sf):
    return profile.speaker_tiers(clips(spark, sf).withColumn("speaker", F.coalesce("speaker", F.lit("<none>"))))


@query("duplicate_corpora", f"WITH c AS ({CLIPS_SQL}), s AS (SELECT DISTINCT source, audio_md5 FROM c), z AS (SELECT source, count(*) AS n FROM s GROUP BY source) SELECT x.a, x.b, overlap, round(overlap / za.n, 9) AS share_a, round(overlap / zb.n, 9) AS share_b FROM (SELECT p.source AS a, q.source AS b, count(*) AS overlap FROM s p JOIN s q ON p.audio_md5 = q.audio_md5 AND p.source < q.source GROUP BY ALL) x JOIN z za ON za.source = x.a JOIN z zb ON zb.source = x.b")
def duplicate_corpora(spark, sf):
    out = dedup.duplicate_corpora(clips(spark, sf), "source", "audio_md5")
    return out.withColumn("share_a", F.round("share_a", 9)).withColumn("share_b", F.round("share_b", 9))


_VOICES = ", ".join(f"('{n}', '{s}', {str(b).lower()}, {x}::VARCHAR[])" for n, s, b, x in VOICES)
_SPOKEN_BY = "CASE WHEN idx % 2 = 1 THEN upper(speaker) ELSE speaker END"
_SPEAKERS = f"c AS (SELECT * REPLACE ({_SPOKEN_BY} AS speaker) FROM ({CLIPS_SQL})), v(name, speaker_id, stage2, sources) AS (VALUES {_VOICES})"


def _voiced(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Clips whose speaker is in upper case half of the time, and the voices."""
    voices = spark.createDataFrame(VOICES, "name string, speaker_id string, stage2 boolean, stage2_sources array<string>")
    return clips(spark, sf).withColumn("speaker", F.expr(_SPOKEN_BY)), voices


@query("voice_stats", f"""WITH {_SPEAKERS},
m AS (SELECT v.name, duration, {_TIER.format('native_sr', 'e8k')} AS tier, ({_TIER.format('native_sr', 'e8k')} IN ('A', 'B') AND (len(sources) = 0 OR list_contains(sources, source)))::INT AS two FROM c JOIN v ON lower(c.speaker) = lower(v.speaker_id)),
a AS (SELECT name, count(*) AS clips, sum(duration) AS s, sum(two) AS n2, min(tier) AS tier FROM m GROUP BY name)
SELECT v.name, coalesce(clips, 0) AS clips, round(coalesce(s, 0) / 3600, 6) AS hours, least(coalesce(n2, 0), 900)::BIGINT AS stage2_clips, tier, stage2 AND least(coalesce(n2, 0), 900) >= 2 AS ready, CASE WHEN NOT stage2 THEN 'BLOCKED' WHEN coalesce(n2, 0) >= 2 THEN 'PASS' ELSE 'THIN' END AS status FROM v LEFT JOIN a USING (name)""")
def voice_stats(spark, sf):
    return profile.voice_stats(*_voiced(spark, sf), ready_from=2)


@query("speaker_report", f"""WITH {_SPEAKERS}, m AS (SELECT coalesce(speaker, '<none>') AS speaker, source, count(*) AS n, median(native_sr) AS sr, median(e8k) AS e FROM c GROUP BY ALL),
t AS (SELECT speaker, sum(n)::BIGINT AS clips, min({_TIER.format('sr', 'e')}) AS best_tier FROM m GROUP BY speaker)
SELECT speaker, name AS voice, clips, best_tier, best_tier IN ('A', 'B', 'C', 'D') AS stage1, best_tier IN ('A', 'B') AS stage2 FROM t LEFT JOIN v ON lower(speaker) = lower(speaker_id) ORDER BY name IS NULL, speaker""")
def speaker_report(spark, sf):
    return profile.speaker_report(*_voiced(spark, sf))


@query("style_check", r"SELECT CASE WHEN avg(regexp_matches(text, '\p{Lu}')::INT) < 0.2 OR avg(regexp_matches(text, '[.!?,]')::INT) < 0.2 THEN 'MISMATCH' ELSE 'OK' END AS verdict FROM documents")
def style_check(spark, sf):
    ratios = style_stats(spark, sf)
    return ratios.select(profile.style_verdict(F.col("cased_ratio"), F.col("punctuated_ratio")).alias("verdict"))


@query("row_counts", "SELECT 'events' AS name, count(*) AS n FROM events UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'absent', NULL")
def row_counts(spark, sf):
    return src.footer_counts(spark, {t: f"{sf}/{t}.parquet" for t in ("events", "documents", "absent")})


@query("stratified_sample", """WITH b AS (SELECT event_id // 500 AS block, count(*) AS rows FROM events GROUP BY 1), n AS (SELECT *, row_number() OVER (ORDER BY block) - 1 AS b, count(*) OVER () AS total FROM b),
k AS (SELECT DISTINCT round_even(i * (total - 1) / greatest(least(5, total) - 1, 1), 0)::BIGINT AS b FROM (SELECT max(total) AS total FROM n), range(5) r(i) WHERE i < least(5, total)),
c AS (SELECT block, n.b, greatest(1, rows // (200 // least(5, total))) AS step FROM n JOIN k ON n.b = k.b),
r AS (SELECT event_id, b, step, row_number() OVER (PARTITION BY block ORDER BY event_id) AS rn FROM events JOIN c ON event_id // 500 = block)
SELECT event_id FROM r WHERE (rn - 1) % step = 0 ORDER BY b, rn LIMIT 200""")
def stratified_sample(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.expr("event_id div 500").alias("block"))
    return src.block_sample(e, "block", "event_id", 200).select("event_id")


#: Words of 0 to 999 spelled out by joins of literal tables.
_WORDS_SQL = """u(i, w) AS (VALUES (0, 'zewo'), (1, 'en'), (2, 'de'), (3, 'twa'), (4, 'kat'), (5, 'senk'), (6, 'sis'), (7, 'sèt'), (8, 'uit'), (9, 'nèf'), (10, 'dis'), (11, 'onz'), (12, 'douz'), (13, 'trèz'), (14, 'katòz'), (15, 'kenz'), (16, 'sèz'), (17, 'disèt'), (18, 'dizuit'), (19, 'diznèf')),
tw(ten, alone, linked, eyen) AS (VALUES (2, 'ven', 'venn', 'vent'), (3, 'trant', 'trann', 'trant'), (4, 'karant', 'karann', 'karant'), (5, 'senkant', 'senkann', 'senkant'), (6, 'swasant', 'swasann', 'swasant')),
hundred AS (SELECT i, w FROM u UNION ALL SELECT ten * 10 + i, CASE i WHEN 0 THEN alone WHEN 1 THEN eyen || 'eyen' ELSE linked || w END FROM tw, u WHERE i < 10
    UNION ALL SELECT 60 + i, 'swasann' || w FROM u WHERE i >= 10 UNION ALL SELECT 80 + i, 'katreven' || CASE i WHEN 0 THEN '' WHEN 1 THEN ' en' ELSE w END FROM u),
words(i, w) AS (SELECT i, w FROM hundred UNION ALL SELECT h.i * 100 + r.i, CASE h.i WHEN 1 THEN '' ELSE h.w END || 'san' || CASE r.i WHEN 0 THEN '' ELSE ' ' || r.w END FROM u h, hundred r WHERE h.i BETWEEN 1 AND 9)"""
_SPELL = "CASE WHEN {0} < 1000 THEN {1} ELSE (CASE WHEN {0} // 1000 = 1 THEN 'mil' ELSE {2} || ' mil' END) || (CASE WHEN {0} % 1000 = 0 THEN '' ELSE ' ' || {1} END) END"


@query("number_words", f"WITH {_WORDS_SQL}, n AS (SELECT DISTINCT p_partkey AS n FROM part UNION SELECT DISTINCT l_orderkey FROM lineitem) SELECT n, CASE WHEN n < 1000000 THEN {_SPELL.format('n', 'b.w', 'a.w')} END AS words FROM n LEFT JOIN words a ON a.i = n // 1000 JOIN words b ON b.i = n % 1000")
def number_words(spark, sf):
    n = table(spark, sf, "part").select(F.col("p_partkey").alias("n")).union(table(spark, sf, "lineitem").select("l_orderkey")).distinct()
    return n.select("n", ph.number_words(F.col("n")).alias("words"))


def _phonemes_sql(text: str) -> str:
    """Steps from documents to phonemes. RE2 has no look-around: runs of letters become single
    private characters one after the other, and those phonemes at the end."""
    letters, vowels = "a-zàèéòù", "aeiouàèéòù"
    mark = [chr(0xE000 + i) for i in range(13)]
    digits = lambda x: f"array_to_string(list_transform(list_filter(string_split({x}, ''), lambda c: c BETWEEN '0' AND '9'), lambda c: words[c::INT + 1]), ' ')"
    plain, whole = r"regexp_replace(run, '[,\s]', '', 'g')", r"regexp_extract(regexp_replace(run, '[,\s]', '', 'g'), '^([0-9]*)', 1)"
    frac = rf"regexp_extract({plain}, '\.(.*)$', 1)"
    value = f"CASE WHEN {whole} = '' THEN 0 ELSE try_cast({whole} AS BIGINT) END"
    spelled = _SPELL.format(f"({value})", f"words[({value}) % 1000 + 1]", f"words[({value}) // 1000 + 1]")
    spoken = f"CASE WHEN length({whole}) > 6 AND (contains({plain}, '.') OR coalesce(({value}) >= 1000000, true)) THEN {digits(whole)} ELSE {spelled} END || CASE WHEN contains({plain}, '.') THEN ' vigil' || CASE WHEN {frac} = '' THEN '' ELSE ' ' || {digits(frac)} END ELSE '' END"
    x = "said"
    x = f"regexp_replace({x}, 'oun([^{vowels}]|$)', '{mark[1]}\\1', 'g')"
    for i, run in ((2, "ann"), (3, "enn"), (4, "onn")):
        x = f"replace({x}, '{run}', '{mark[i]}')"
    for i, c in ((5, "a"), (6, "e"), (7, "o")):
        x = f"regexp_replace({x}, '{c}n([^{vowels}ny{mark[1]}-{mark[7]}]|$)', '{mark[i]}\\1', 'g')"
    for i, run in ((8, "ou"), (9, "ui"), (10, "ch"), (11, "ny"), (12, "x")):
        x = f"replace({x}, '{run}', '{mark[i]}')"
    x = f"translate({x}, 'àéèòùjrycqg', 'aeɛɔuʒɣjkkɡ')"
    sounds = ["", "u\u0303", "an", "ɛn", "ɔn", "ɑ\u0303", "ɛ\u0303", "ɔ\u0303", "u", "ɥi", "ʃ", "ɲ", "ks"]
    for m, sound in zip(mark, sounds):
        x = f"replace({x}, '{m}', '{sound}')"
    elided = "runs"
    for _ in range(2):
        elided = f"regexp_replace({elided}, '([{letters}])''([{letters}])', '\\1\\2', 'g')"
    return f"""{_WORDS_SQL}, w1000 AS (SELECT list(w ORDER BY i) AS words FROM words),
    t1 AS (SELECT doc_id, replace(replace(lower({NORM_SQL.format('text')}), '$', ' dola '), '€', ' ero ') AS x, words FROM ({text}), w1000),
    t2 AS (SELECT doc_id, array_to_string(list_transform(regexp_extract_all(x, '[0-9][0-9\\s.,]*[0-9]|[0-9]|[^0-9]+'), lambda run: CASE WHEN regexp_matches(run, '^[0-9]') THEN {spoken} ELSE run END), '') AS runs FROM t1),
    t3 AS (SELECT doc_id, regexp_replace({elided}, '[^{letters}.,!?;:\\s]', '{mark[0]}', 'g') AS said FROM t2),
    ph AS (SELECT doc_id, trim(regexp_replace(regexp_replace({x}, '\\s', ' ', 'g'), ' +', ' ', 'g')) AS phonemes FROM t3)"""


_PHONEMES = _phonemes_sql("SELECT doc_id, text FROM documents").replace("\\\\", "\\")


@query("phonemize", f"WITH {_PHONEMES} SELECT doc_id, phonemes, length(replace(phonemes, ' ', '')) AS n_phonemes FROM ph")
def phonemize(spark, sf):
    said = ph.phonemes(F.col("text"))
    return _docs(spark, sf).select("doc_id", said.alias("phonemes")).withColumn("n_phonemes", ph.phoneme_count(F.col("phonemes")))


_REPORT = f"{_PHONEMES}, k AS (SELECT phoneme, count(*) AS n FROM (SELECT unnest(string_split(phonemes, '')) AS phoneme FROM ph) WHERE phoneme NOT IN ('', ' ') GROUP BY phoneme), rep AS (SELECT *, contains('anɛɔɑueiɥʃɲpbtdkɡfvszhmlʒɣwjo\u0303.,!?;:', phoneme) AS known FROM k)"


@query("phoneme_coverage", f"WITH {_REPORT} SELECT phoneme, n, known, known AND n < 50 AND NOT regexp_matches(phoneme, '[.,!?;:]') AS rare FROM rep")
def phoneme_coverage(spark, sf):
    said = ph.spoken_words(_docs(spark, sf), "text")
    return coverage.phoneme_report(said, "phonemes", weight="n")


@query("phoneme_check", f"WITH {_REPORT} SELECT count(*) AS distinct_phonemes, count(*) FILTER (NOT known) AS unknown, count(*) FILTER (known AND n < 50 AND NOT regexp_matches(phoneme, '[.,!?;:]')) AS rare, CASE WHEN count(*) FILTER (NOT known) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM rep")
def phoneme_check(spark, sf):
    return coverage.phoneme_verdict(phoneme_coverage(spark, sf))


_BY_SOURCE = f"{_PHONEMES}, rs AS (SELECT source, phoneme, count(*) AS n FROM (SELECT source, unnest(string_split(phonemes, '')) AS phoneme FROM ph JOIN documents USING (doc_id)) WHERE phoneme NOT IN ('', ' ') GROUP BY ALL)"


@query("rare_phonemes", f"WITH {_BY_SOURCE} SELECT source, phoneme, n FROM rs WHERE n < 2000 AND contains('anɛɔɑueiɥʃɲpbtdkɡfvszhmlʒɣwjo\u0303', phoneme) ORDER BY n, phoneme, source LIMIT 20")
def rare_phonemes(spark, sf):
    """Phonemes below 2000 occurrences in a source."""
    said = ph.spoken_words(_docs(spark, sf), "text", "source")
    return coverage.rare_phonemes(coverage.phoneme_report(said, "phonemes", 2000, ("source",), "n")).select("source", "phoneme", "n")


@query("unknown_phonemes", f"WITH {_REPORT} SELECT phoneme, n FROM rep WHERE phoneme IN ('ɥ', 'ɲ', '\u0303', 'ɣ', ';')")
def unknown_phonemes(spark, sf):
    """What a model without nasal vowels and a few sounds lacks."""
    report = phoneme_coverage(spark, sf)
    return coverage.unknown_phonemes(report, coverage.inventory(report).where(~F.col("phoneme").isin("ɥ", "ɲ", "\u0303", "ɣ", ";")))


_PIECE_WORDS = r"[a-zA-Z]{2,8}"


def _vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces: the words and word parts of two to eight letters in `benchmark`, ASCII letters, digits and marks;
    ids in order."""
    said = table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit(_PIECE_WORDS), F.lit(0))).alias("piece"))
    signs = spark.range(33, 127).select(F.char("id").alias("piece"))
    ordered = said.union(signs).distinct()
    return running(ordered, ["piece"]).select("piece", (F.col("number") + 1).cast("int").alias("id"))


#: Tokens by SQL: every word once; from its start the longest piece, or one letter, again and again.
_TOKENS_SQL = rf"""v AS (SELECT piece, row_number() OVER (ORDER BY encode(piece)) AS id, length(piece) AS k FROM (SELECT unnest(regexp_extract_all(text, '{_PIECE_WORDS}')) AS piece FROM benchmark UNION SELECT chr(i::INT) FROM range(33, 127) r(i))),
w AS (SELECT word, count(*) AS times FROM (SELECT unnest(regexp_extract_all(text, '[^ 	-
]+')) AS word FROM documents) GROUP BY word),
m AS MATERIALIZED (SELECT word, pos, max(k) AS k FROM (SELECT word, unnest(range(1, length(word) + 1)) AS pos FROM w) JOIN v ON substring(word, pos, k) = piece GROUP BY ALL),
t AS (SELECT word, 1::BIGINT AS pos FROM w UNION ALL SELECT t.word, t.pos + coalesce(m.k, 1) FROM t LEFT JOIN m ON m.word = t.word AND m.pos = t.pos WHERE t.pos + coalesce(m.k, 1) <= length(t.word)),
s AS (SELECT t.word, t.pos, m.k IS NULL AS odd, coalesce(m.k, 1) AS k FROM t LEFT JOIN m ON m.word = t.word AND m.pos = t.pos),
o AS (SELECT word, min(pos) AS pos, count(*) AS k FROM (SELECT word, pos, pos - row_number() OVER (PARTITION BY word ORDER BY pos) AS run FROM s WHERE odd) GROUP BY word, run)"""


def _tokens(spark: SparkSession, sf: str, vocabulary: DataFrame | None = None) -> DataFrame:
    """Distinct words of all documents, how often each occurs (n), and its tokens."""
    words = word_counts(_docs(spark, sf), "text", "word")
    return words.withColumn("tokens", tokenizer(_vocabulary(spark, sf) if vocabulary is None else vocabulary)(F.col("word")))


@query("token_coverage", rf"""WITH RECURSIVE {_TOKENS_SQL}, c AS (SELECT (SELECT sum(times) FROM w) AS words, (SELECT sum(times) FROM s JOIN w USING (word) WHERE NOT odd) AS known, (SELECT coalesce(sum(times), 0) FROM o JOIN w USING (word)) AS unknown)
SELECT (known + unknown)::BIGINT AS tokens, words::BIGINT AS words, unknown::BIGINT AS unknown, round((known + unknown) / words, 3) AS tokens_per_word, round(unknown / (known + unknown), 6) AS unknown_rate, CASE WHEN round(unknown / (known + unknown), 6) > 0.001 OR round((known + unknown) / words, 3) > 4 THEN 'REVIEW' ELSE 'OK' END AS verdict FROM c""")
def token_coverage(spark, sf):
    return coverage.token_report(_tokens(spark, sf), "word", "tokens", UNKNOWN, weight="n")


@query("unknown_pieces", rf"WITH RECURSIVE {_TOKENS_SQL} SELECT substring(word, pos, k) AS piece, sum(times)::BIGINT AS n FROM o JOIN w USING (word) GROUP BY piece ORDER BY n DESC, piece LIMIT 20")
def unknown_pieces(spark, sf):
    return coverage.unknown_pieces(_tokens(spark, sf), "word", "tokens", UNKNOWN, weight="n")


@query("piece_counts", rf"WITH RECURSIVE {_TOKENS_SQL} SELECT v.id::INT AS id, v.piece, sum(times)::BIGINT AS n FROM s JOIN w USING (word) JOIN v ON v.piece = substring(s.word, s.pos, s.k) WHERE NOT odd GROUP BY ALL")
def piece_counts(spark, sf):
    """How often each piece of the vocabulary occurs as a token."""
    vocabulary = _vocabulary(spark, sf)
    ids = coverage.counts(_tokens(spark, sf, vocabulary), F.col("tokens.id"), "id", weight="n")
    return ids.join(vocabulary, "id").select("id", "piece", "n")


#: The same levels in SQL: an element is what a unit breaks into, or stays open to be joined.
_LIMIT = 200
_ELEMENT = "CASE WHEN length({0}) > {1} THEN {{'done': {2}, 'open': ''}} ELSE {{'done': []::VARCHAR[], 'open': {0}}} END"
_STEP = """lambda a, b: CASE WHEN len(b.done) > 0 THEN {{'done': list_concat(CASE WHEN a.open = '' THEN a.done ELSE list_append(a.done, a.open) END, b.done), 'open': ''}}
WHEN a.open = '' THEN {{'done': a.done, 'open': b.open}} WHEN length(a.open) + 1 + length(b.open) <= {0} THEN {{'done': a.done, 'open': a.open || ' ' || b.open}} ELSE {{'done': list_append(a.done, a.open), 'open': b.open}} END"""


def _filled(units: str, name: str, broken: str | None) -> str:
    element = _ELEMENT.format(name, _LIMIT, broken) if broken else f"{{'done': []::VARCHAR[], 'open': {name}}}"
    folded = f"list_reduce(list_transform({units}, lambda {name}: {element}), {_STEP.format(_LIMIT)})"
    return f"list_transform([{folded}], lambda f: CASE WHEN f.open = '' THEN f.done ELSE list_append(f.done, f.open) END)[1]"


def _chunks_sql() -> str:
    cut = lambda x, marks: f"string_split(regexp_replace({x}, '([{marks}])\\s+', '\\1' || chr(1), 'g'), chr(1))"
    wrapped = _filled("string_split(clause, ' ')", "word", f"regexp_extract_all(word, '(?s).{{1,{_LIMIT}}}')")
    broken = _filled(cut("sentence", ",;:"), "clause", wrapped)
    parts = f"flatten(list_transform({cut('one', '.!?…')}, lambda sentence: CASE WHEN length(sentence) > {_LIMIT} THEN {broken} ELSE [sentence] END))"
    pieces = _filled("list_filter(parts, lambda p: p <> '')", "p", None)
    return rf"""WITH o AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS one FROM documents), q AS (SELECT doc_id, {parts} AS parts FROM o WHERE one <> ''), f AS (SELECT doc_id, {pieces} AS pieces FROM q)
    SELECT doc_id, (unnest(range(len(pieces))))::INT AS segment, unnest(pieces) AS piece FROM f""".replace("\\\\", "\\")


@query("chunk_text", _chunks_sql())
def chunk_text(spark, sf):
    return _docs(spark, sf).select("doc_id", F.posexplode(tn.chunks(F.col("text"), _LIMIT)).alias("segment", "piece"))


_ABS = "list_transform(embedding, lambda x: abs(x::DOUBLE))"


@query("level_stats", f"SELECT vec_id, round(list_max({_ABS}), 6) AS peak, round(len(list_filter({_ABS}, lambda x: x >= 0.999)) / len(embedding), 6) AS clip_ratio, round(abs(list_sum(list_transform(embedding, lambda x: x::DOUBLE)) / len(embedding)), 6) AS dc_offset, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) / len(embedding)), 6) AS rms, len(embedding) / 16000 AS duration FROM embeddings")
def level_stats(spark, sf):
    out = signal.level_stats(waves(spark, sf), "wave", "sr")
    return out.select("vec_id", *(F.round(c, 6).alias(c) for c in ("peak", "clip_ratio", "dc_offset", "rms")), "duration")


@query("peak_gain", f"SELECT vec_id, round(CASE WHEN p > pow(10, -0.05) THEN pow(10, -0.05) / p ELSE 1 END, 6) AS ceiling, round(CASE WHEN p > 1e-4 AND p < 0.5 THEN 0.95 / p ELSE 1 END, 6) AS quiet FROM (SELECT vec_id, list_max({_ABS}) AS p FROM embeddings)")
def peak_gain(spark, sf):
    w = F.col("wave")
    return waves(spark, sf).select("vec_id", F.round(signal.ceiling_gain(w), 6).alias("ceiling"), F.round(signal.quiet_gain(w), 6).alias("quiet"))


@query("fixed_padding", "SELECT vec_id, 64 + 800 + 2400 AS n, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 5) AS total FROM embeddings")
def fixed_padding(spark, sf):
    x = waves(spark, sf).select("vec_id", signal.padded(F.col("wave"), 16000).alias("x"))
    return x.select("vec_id", F.size("x").alias("n"), F.round(F.aggregate("x", F.lit(0.0), lambda a, v: a + v), 5).alias("total"))


@query("level_match", """WITH r AS (SELECT vec_id, label, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) / len(embedding)) AS rms FROM embeddings), m AS (SELECT label, median(rms) FILTER (rms > 1e-5) AS lv, count(*) FILTER (rms > 1e-5) AS k FROM r GROUP BY label)
SELECT vec_id, round(CASE WHEN k >= 2 AND rms >= 1e-5 AND abs(least(2, greatest(0.5, lv / rms)) - 1) >= 0.02 THEN least(2, greatest(0.5, lv / rms)) ELSE 1 END, 6) AS gain FROM r JOIN m USING (label)""")
def level_match(spark, sf):
    out = signal.match_levels(signal.level_stats(waves(spark, sf), "wave", "sr"), "passage")
    return out.select("vec_id", F.round("gain", 6).alias("gain"))


@query("signal_measures")
def signal_measures(spark, sf):
    return signal.measure(long_waves(spark, sf).withColumn("key", F.col("passage") * 1000000 + F.col("segment")), "key", "wave", "sr")


_FRAMES = f"SELECT passage, segment, wave, unnest(range(1, len(wave) - 398, 160)) AS pos FROM ({LONG_WAVES_SQL}) WHERE len(wave) >= 1840"


@query("frame_snr", f"""SELECT passage, segment, round(quantile_cont(db, 0.95) - quantile_cont(db, 0.05), 5) AS snr, count(*) AS frames FROM
(SELECT passage, segment, 20 * log10(greatest(sqrt(list_sum(list_transform(list_slice(wave, pos, pos + 399), lambda v: v * v)) / 400), 1e-10)) AS db FROM ({_FRAMES})) GROUP BY ALL""")
def frame_snr(spark, sf):
    long = long_waves(spark, sf).where(F.size("wave") >= 1840).withColumn("key", F.col("passage") * 1000000 + F.col("segment"))
    out = signal.measure(long, "key", "wave", "sr")
    frames = F.floor((F.round(F.col("duration") * F.col("native_sr")) - 400) / 160) + 1
    return out.select(F.floor(F.col("key") / 1000000).alias("passage"), (F.col("key") % 1000000).alias("segment"), F.round("snr", 5).alias("snr"), frames.alias("frames"))


_WAVE256 = "SELECT vec_id // 4 AS id, flatten(list(list_transform(embedding, lambda v: v::DOUBLE) ORDER BY vec_id)) AS wave FROM embeddings GROUP BY 1"


def _waves256(spark: SparkSession, sf: str) -> DataFrame:
    """Four embeddings each as one wave of 256 samples."""
    e = table(spark, sf, "embeddings").groupBy(F.expr("vec_id div 4").alias("id")).agg(F.sort_array(F.collect_list(F.struct("vec_id", "embedding"))).alias("all"))
    return e.select("id", F.flatten(F.transform("all", lambda x: F.transform(x["embedding"], lambda v: v.cast("double")))).alias("wave"), F.lit(24000).alias("sr"))


@query("spectral_stats", f"""WITH w AS ({_WAVE256}), x AS (SELECT id, unnest(wave) AS v, unnest(range(len(wave))) AS i FROM w WHERE len(wave) = 256), h AS (SELECT id, i, v * (0.5 - 0.5 * cos(2 * pi() * i / 255)) AS v FROM x),
p AS (SELECT id, k, pow(sum(v * cos(2 * pi() * (k * i % 256) / 256)), 2) + pow(sum(v * sin(2 * pi() * (k * i % 256) / 256)), 2) AS power FROM h, range(129) r(k) GROUP BY ALL),
c AS (SELECT id, k, sum(power) OVER (PARTITION BY id ORDER BY k) AS below, sum(power) OVER (PARTITION BY id) AS total FROM p),
s AS (SELECT id, 1 - max(below) FILTER (k = 85) / max(total) AS e8k, least(count(*) FILTER (below < 0.999 * total), 128) * 93.75 AS f999 FROM c GROUP BY id)
SELECT w.id, round(coalesce(greatest(e8k, 0), 0), 6) AS e8k, coalesce(f999, 0)::DOUBLE AS f999 FROM w LEFT JOIN s USING (id)""")
def spectral_stats(spark, sf):
    out = signal.measure(_waves256(spark, sf), "id", "wave", "sr")
    return out.select("id", F.round("e8k", 6).alias("e8k"), "f999")


_QUIET_ENDS = "CASE WHEN {0} * 5 < {1} OR {0} * 4 >= {1} * 3 THEN 1e-4 ELSE 1.0 END"


@query("trim_bounds", f"""WITH w AS (SELECT passage, segment, list_transform(wave, lambda v, i: v * {_QUIET_ENDS.format('(i - 1)', 'len(wave)')}) AS wave FROM ({LONG_WAVES_SQL}) WHERE len(wave) >= 400),
f AS (SELECT passage, segment, len(wave) AS n, wave, unnest(range(0, len(wave) - 399, 160)) AS pos FROM w),
d AS (SELECT passage, segment, n, pos, 20 * log10(greatest(sqrt(list_sum(list_transform(list_slice(wave, pos + 1, pos + 400), lambda v: v * v)) / 400), 1e-10)) AS db FROM f),
m AS (SELECT *, max(db) OVER (PARTITION BY passage, segment) AS top FROM d)
SELECT passage, segment, min(pos)::INT AS trim_start, least(max(pos) + 400, any_value(n))::INT AS trim_end FROM m WHERE db > top - 35 GROUP BY ALL""")
def trim_bounds(spark, sf):
    quiet = F.expr(f"transform(wave, (v, i) -> v * {_QUIET_ENDS.format('i', 'size(wave)')})")
    long = long_waves(spark, sf).where(F.size("wave") >= 400).withColumn("wave", quiet).withColumn("key", F.col("passage") * 1000000 + F.col("segment"))
    return signal.measure(long, "key", "wave", "sr").select(F.floor(F.col("key") / 1000000).alias("passage"), (F.col("key") % 1000000).alias("segment"), "trim_start", "trim_end")


_INT16 = "trunc(greatest(-1.0, least(1.0, {0}::DOUBLE)) * 32767)"


@query("wav_decode", f"""WITH e AS (SELECT vec_id, CASE vec_id % 5 WHEN 1 THEN list_transform(embedding, lambda v: v::DOUBLE) WHEN 2 THEN list_transform(embedding, lambda v: ({_INT16.format('v')} + {_INT16.format('v / -4')}) / 2 / 32768)
    WHEN 3 THEN list_transform(embedding[:len(embedding) - 2], lambda v: {_INT16.format('v')} / 32768) WHEN 4 THEN NULL ELSE list_transform(embedding, lambda v: {_INT16.format('v')} / 32768) END AS x FROM embeddings)
SELECT vec_id, CASE WHEN x IS NOT NULL THEN (8000 + vec_id % 3)::INT END AS native_sr, len(x)::INT AS n, round(list_sum(x), 6) AS total, round(list_sum(list_transform(x, lambda v, i: v * i)), 5) AS weighted FROM e""")
def wav_decode(spark, sf):
    """Q01, Q02: embeddings written as WAV bytes (16 bit, float, two channels with an odd chunk before the
    data, data cut short, a cut header), decoded again."""

    def write(batches):
        for pdf in batches:
            out = []
            for i, x in zip(pdf["vec_id"], pdf["embedding"]):
                x = np.asarray(x, dtype=np.float64)
                raw = signal.encode_wav([x, (x.astype(np.float32) / -4).astype(np.float64)] if i % 5 == 2 else [x], 8000 + i % 3, i % 5 == 1, b"three" if i % 5 == 2 else b"")
                out.append(raw[:-3] if i % 5 == 3 else raw[:40] if i % 5 == 4 else raw)
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "audio": out})

    files = table(spark, sf, "embeddings").select("vec_id", "embedding").mapInPandas(write, "vec_id long, audio binary")
    x = signal.decode(files, "vec_id", "audio")
    weighted = F.aggregate(F.transform("samples", lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    return x.select("vec_id", "native_sr", F.size("samples").alias("n"), F.round(F.aggregate("samples", F.lit(0.0), lambda a, v: a + v), 6).alias("total"), F.round(weighted, 5).alias("weighted"))


@query("segment_join")
def segment_join(spark, sf):
    out = signal.join_segments(long_waves(spark, sf, 50), "passage", "segment", "wave", "sr")
    return out.select("passage", "segment", "start", F.size("samples").alias("n"), F.round(F.aggregate("samples", F.lit(0.0), lambda a, v: a + F.abs(v)), 6).alias("total"))


_TABLE = """r AS (SELECT vec_id AS id, (10 + vec_id % 390)::INT AS length, embedding FROM embeddings), t AS (SELECT i::INT AS target FROM range(1, 511) x(i)), p AS (SELECT target, id, length, abs(length - target) AS d FROM r, t),
h AS (SELECT target, count(*) FILTER (d <= greatest(3, 0.2 * target)) AS hits FROM p GROUP BY target), k AS (SELECT p.*, hits, row_number() OVER (PARTITION BY p.target ORDER BY d, id) AS rn FROM p JOIN h USING (target)),
u AS (SELECT target, id FROM k WHERE CASE WHEN hits >= 5 THEN d <= greatest(3, 0.2 * target) ELSE rn <= 5 END),
f AS (SELECT id, unnest(embedding) AS x, unnest(range(len(embedding)))::INT AS dim FROM r), v AS (SELECT target, dim, avg(x::DOUBLE) AS value FROM u JOIN f USING (id) GROUP BY ALL)"""
_SMOOTH = "s AS (SELECT a.target, a.dim, sum(b.value) / 15 AS value FROM v a, range(-7, 8) o(k), v b WHERE b.dim = a.dim AND b.target = least(510, greatest(1, a.target + k)) GROUP BY ALL)"


@query("length_table", f"WITH {_TABLE} SELECT target, dim, round(value, 6) + 0.0 AS value FROM v")
def length_table(spark, sf):
    return vectors.length_table(refs(spark, sf), 510).select("target", "dim", (F.round("value", 6) + F.lit(0.0)).alias("value"))


@query("smooth_table", f"WITH {_TABLE}, {_SMOOTH} SELECT target, dim, round(value, 6) + 0.0 AS value FROM s")
def smooth_table(spark, sf):
    return vectors.smooth_table(vectors.length_table(refs(spark, sf), 510)).select("target", "dim", (F.round("value", 6) + F.lit(0.0)).alias("value"))


@query("table_check", f"""WITH {_TABLE}, {_SMOOTH}, e AS (SELECT dim, max(value) FILTER (target = 1) AS a, max(value) FILTER (target = 510) AS b FROM s GROUP BY dim), q AS (SELECT sqrt(sum(a * a)) AS n0, sqrt(sum(b * b)) AS n1, sum(a * b) AS dot FROM e)
SELECT round(n0, 5) AS first_norm, round(n1, 5) AS last_norm, round(n0 / greatest(n1, 1e-9), 5) AS decay, round(dot / greatest(n0 * n1, 1e-9), 5) AS cosine, array_to_string(list_filter([CASE WHEN NOT (n0 / greatest(n1, 1e-9) BETWEEN 1.8 AND 8) THEN 'norm decay is outside (1.8, 8.0)' END, CASE WHEN NOT (dot / greatest(n0 * n1, 1e-9) BETWEEN 0.05 AND 0.9) THEN 'cosine of the ends is outside (0.05, 0.9)' END], lambda x: x IS NOT NULL), '; ') AS warnings, CASE WHEN n0 / greatest(n1, 1e-9) BETWEEN 1.8 AND 8 AND dot / greatest(n0 * n1, 1e-9) BETWEEN 0.05 AND 0.9 THEN 'PASS' ELSE 'SUSPECT' END AS verdict FROM q""")
def table_check(spark, sf):
    out = vectors.check_table(vectors.smooth_table(vectors.length_table(refs(spark, sf), 510)))
    return out.withColumn("warnings", F.array_join("warnings", "; "))


@query("truncation_flag", f"WITH c AS ({CLIPS_SQL}) SELECT idx, duration <= 0 OR length(raw_text) / duration > 16.0 AS truncated FROM c")
def truncation_flag(spark, sf):
    return clips(spark, sf).select("idx", rules.truncated(F.col("raw_text"), F.col("duration")).alias("truncated"))


_KNOB = "CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'hot' WHEN 2 THEN 'NaN' ELSE CAST(value AS {0}) END"


@query("clamp_params", f"SELECT event_id, CASE WHEN k IS NULL THEN 0.7 WHEN k IN ('hot', 'NaN') THEN NULL ELSE least(20.0, greatest(0.5, k::DOUBLE)) END AS value, CASE WHEN k IN ('hot', 'NaN') THEN 'must be a number' END AS error FROM (SELECT event_id, {_KNOB.format('VARCHAR')} AS k FROM events)".replace("k::DOUBLE", "try_cast(k AS DOUBLE)"))
def clamp_params(spark, sf):
    value, error = rules.clamp(F.col("k"), 0.5, 20.0, 0.7)
    return table(spark, sf, "events").select("event_id", F.expr(_KNOB.format("STRING")).alias("k")).select("event_id", value.alias("value"), error.alias("error"))


@query("latency_lookup", "SELECT event_id, CASE event_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 3 WHEN 2 THEN 6 WHEN 3 THEN 13 END AS frames, CASE WHEN event_id % 5 = 4 THEN 'unknown latency' END AS error FROM events")
def latency_lookup(spark, sf):
    frames, error = rules.context_frames(F.element_at(F.array(*map(F.lit, (80, 320, 560, 1120, 99))), (F.col("event_id") % 5 + 1).cast("int")))
    return table(spark, sf, "events").select("event_id", frames.alias("frames"), error.alias("error"))


@query("payload_decode", "SELECT conv_id, turn, CASE WHEN turn % 3 <> 2 THEN octet_length(text::BLOB)::INT END AS size, CASE WHEN turn % 3 = 2 THEN 'invalid base64' END AS error FROM (SELECT conv_id, turn, encode(text) AS text FROM conversations)")
def payload_decode(spark, sf):
    c = table(spark, sf, "conversations")
    coded = F.base64(F.encode("text", "UTF-8"))
    raw, error = rules.decode_payload(F.when(F.col("turn") % 3 == 2, "*not base64*").when(F.col("turn") % 3 == 1, F.concat(F.lit("data:audio/wav;base64,"), coded)).otherwise(coded))
    return c.select("conv_id", "turn", F.octet_length(raw).alias("size"), error.alias("error"))


@query("length_bounds", "SELECT conv_id, turn, CASE WHEN trim(text) = '' THEN 'empty' WHEN length(text) > 200 THEN 'too_long' END AS error FROM conversations")
def length_bounds(spark, sf):
    t = F.col("text")
    return table(spark, sf, "conversations").select("conv_id", "turn", rules.first_failing([("empty", F.trim(t) == ""), ("too_long", F.length(t) > 200)]).alias("error"))


_MAIL = "CASE event_id % 4 WHEN 0 THEN concat(' user', CAST(user_id AS {0}), '@example.org ') WHEN 1 THEN 'no address' WHEN 2 THEN NULL ELSE concat('u', CAST(event_id AS {0}), '@x.ht') END"


@query("signup_rules", rf"SELECT event_id, email, left(trim(props), 1000) AS note, left(trim(event_type), 80) AS use_case, regexp_matches(email, '^[^\s@]+@[^\s@]+\.[^\s@]+$') AS valid FROM (SELECT *, trim(coalesce({_MAIL.format('VARCHAR')}, '')) AS email FROM events)")
def signup_rules(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.expr(_MAIL.format("STRING")).alias("email"), F.col("props").alias("note"), F.col("event_type").alias("use_case"))
    return rules.signup(e)


@query("quota_window", """WITH RECURSIVE e AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
w AS (SELECT user_id, event_id, i, ts, ts + INTERVAL 1 HOUR AS reset, 1 AS n FROM e WHERE i = 1
      UNION ALL SELECT e.user_id, e.event_id, e.i, e.ts, CASE WHEN e.ts >= w.reset THEN e.ts + INTERVAL 1 HOUR ELSE w.reset END, CASE WHEN e.ts >= w.reset THEN 1 ELSE n + 1 END FROM w JOIN e ON e.user_id = w.user_id AND e.i = w.i + 1)
SELECT user_id::VARCHAR AS key, event_id AS id, n <= 5 AS ok, greatest(0, 5 - n)::INT AS remaining, CASE WHEN n <= 5 THEN 0 ELSE ceil(date_diff('microsecond', ts, reset) / 1000000.0)::INT END AS retry_after FROM w""")
def quota_window(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"))
    return quota_batch(e, 5, 3600).drop("ts", "reset")


@query("columnar_scan", "SELECT row_number() OVER () - 1 AS idx, length(text) AS n FROM documents")
def columnar_scan(spark, sf):
    return src.read_columnar(spark, f"{sf}/documents.parquet", need_audio=False).select("idx", F.length("raw_text").alias("n"))


@query("source_union", "SELECT source, synthetic, weight, count(*) AS n FROM (SELECT 'org__docs' AS source, false AS synthetic, 1.0::DOUBLE AS weight FROM documents UNION ALL SELECT 'org__talk__main', true, 0.5 FROM conversations) GROUP BY ALL")
def source_union(spark, sf):
    d = _docs(spark, sf).select(F.col("doc_id").alias("idx"), F.col("text").alias("raw_text"))
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("idx"), F.col("text").alias("raw_text"))
    every = src.union_sources([(d, src.slug("org/docs"), False, 1.0), (c, src.slug("org/talk", "main"), True, 0.5)])
    return every.groupBy("source", "synthetic", "weight").agg(F.count(F.lit(1)).alias("n"))
