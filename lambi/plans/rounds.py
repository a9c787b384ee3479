"""Round trips: reports and manifests written to the shared folder and read again; synthesis clips."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lambi.functions import phonemes as ph
from lambi.functions import textnorm as tn
from lambi.operators import curation, rules, scoring, splits
from lambi.plans.catalog import _CLASS, _SPLIT, _VOICES, MAX_S, MIN_S, ORACLES, VOICES, _phonemes_sql, classified, query, table
from lambi.plans.fixtures import CLIPS_SQL, NORM_SQL, clips, every_latency, sentence_pairs
from lambi.sources import tables as src
from lambi.sources.shared import kept, shared_folder

_SHAPE = "CASE id % 6 WHEN 0 THEN 12.0 ELSE 1.0 END * v + CASE WHEN id % 5 = 1 THEN 0.02 ELSE 0.0 END"
_PART = "CASE WHEN id % 9 = 3 THEN {0} WHEN id % 9 = 4 THEN {1} ELSE {2} END"


def synthesis_clips(spark: SparkSession, sf: str) -> DataFrame:
    """Ten embeddings as a wave of 80 samples a second, some too loud, with an offset, even, short or
    long, with what is said in the first turn of a conversation; every 13th twice."""
    e = table(spark, sf, "embeddings").groupBy(F.expr("vec_id div 10").alias("id")).agg(F.sort_array(F.collect_list(F.struct("vec_id", "embedding"))).alias("all"))
    wave = F.flatten(F.transform("all", lambda x: F.transform(x["embedding"], lambda v: v.cast("double"))))
    e = e.withColumn("w", wave).withColumn("w", F.expr("CASE WHEN id % 7 = 2 THEN transform(w, v -> sign(v) * 0.25D) ELSE w END"))
    e = e.withColumn("w", F.expr(f"transform(w, v -> CAST({_SHAPE} AS DOUBLE))")).withColumn("wave", F.expr(_PART.format("slice(w, 1, 60)", "concat(w, w)", "w")))
    turns = table(spark, sf, "conversations").where("turn = 0").select(F.col("conv_id").alias("id"), F.col("text"))
    both = e.select("id", "wave").join(turns, "id", "left").withColumn("idx", F.explode(F.expr("CASE WHEN id % 13 = 0 THEN array(id, id + 1000000) ELSE array(id) END")))
    return both.select("idx", "wave", F.lit(80).alias("sr"), ph.phonemes(F.coalesce("text", F.lit(""))).alias("phonemes"))


_SYNTHESIS = f"""{_phonemes_sql("SELECT conv_id AS doc_id, text FROM conversations WHERE turn = 0")},
e AS (SELECT vec_id // 10 AS id, flatten(list(list_transform(embedding, lambda v: v::DOUBLE) ORDER BY vec_id)) AS w FROM embeddings GROUP BY 1),
e2 AS (SELECT id, CASE WHEN id % 7 = 2 THEN list_transform(w, lambda v: sign(v) * 0.25::DOUBLE) ELSE w END AS w FROM e), e3 AS (SELECT id, list_transform(w, lambda v: ({_SHAPE})::DOUBLE) AS w FROM e2),
s AS (SELECT id, unnest(CASE WHEN id % 13 = 0 THEN [id, id + 1000000] ELSE [id] END) AS idx, {_PART.format('w[1:60]', 'list_concat(w, w)', 'w')} AS wave, coalesce(phonemes, '') AS phonemes FROM e3 LEFT JOIN ph ON doc_id = id),
f AS (SELECT idx, 20 * log10(greatest(sqrt((wave[i] * wave[i] + wave[i + 1] * wave[i + 1]) / 2), 1e-10)) AS db FROM (SELECT idx, wave, unnest(range(1, len(wave))) AS i FROM s)),
n AS (SELECT idx, quantile_cont(db, 0.95) - quantile_cont(db, 0.05) AS snr FROM f GROUP BY idx),
m AS (SELECT s.*, len(wave) / 80 AS duration, len(list_filter(wave, lambda v: abs(v) >= 0.999)) / len(wave) AS clip_ratio, abs(list_sum(wave)) / len(wave) AS dc_offset, snr, length(replace(phonemes, ' ', '')) AS k FROM s JOIN n USING (idx)),
r AS (SELECT *, CASE WHEN clip_ratio > 0.005 THEN 'clipped' WHEN dc_offset > 0.005 THEN 'dc_offset' WHEN duration < 1 THEN 'too_short' WHEN duration > 12 THEN 'too_long' WHEN snr < 15 THEN 'low_snr' WHEN k < 5 THEN 'too_few_phonemes' WHEN k > 400 THEN 'too_many_phonemes' WHEN k / duration > 22 THEN 'implausible_phoneme_rate' END AS reason FROM m)
SELECT idx, round(snr, 5) AS snr, k AS n_phonemes, CASE WHEN reason IS NULL AND row_number() OVER (PARTITION BY reason, wave, replace(phonemes, ' ', '') ORDER BY idx) > 1 THEN 'duplicate' ELSE reason END AS drop_reason FROM r""".replace("\\\\", "\\")


@query("synthesis_rules", f"WITH {_SYNTHESIS}")
def synthesis_rules(spark, sf):
    """F02 over measures of the samples, with its duplicates."""
    out = curation.classify_synthesis(synthesis_clips(spark, sf), "idx", "wave", "sr", "phonemes", ["idx"])
    return out.select("idx", F.round("snr", 5).alias("snr"), "n_phonemes", "drop_reason")


@query("charset_rules", f"""WITH c AS ({CLIPS_SQL}), n AS (SELECT *, {NORM_SQL.format('raw_text')} AS text FROM c)
SELECT idx, CASE WHEN duration IS NULL THEN 'undecodable_audio' WHEN regexp_replace(text, '[a-zA-ZàèéòùÀÈÉÒÙ0-9 .,?!''\\-:;"()%&/]', '', 'g') <> '' THEN 'out_of_charset' WHEN duration < {MIN_S} THEN 'too_short' WHEN duration > {MAX_S} THEN 'too_long'
WHEN duration <= 0 OR length(text) / duration > 25.0 THEN 'implausible_chars_per_second' END AS drop_reason FROM n""")
def charset_rules(spark, sf):
    """F01 with foreign letters dropped and empty texts kept."""
    df = clips(spark, sf).withColumn("text", tn.normalize(F.col("raw_text")))
    checks = rules.speech_rules(F.col("text"), F.col("duration"), MIN_S, MAX_S, foreign=tn.out_of_charset(F.col("text")), keep_empty=True)
    return df.select("idx", rules.first_failing(checks).alias("drop_reason"))


@query("manifest_jsonl", f"WITH c AS ({CLIPS_SQL}) SELECT {_SPLIT} AS split, path AS audio_filepath, round(duration, 3) AS duration, raw_text AS text FROM c")
def manifest_jsonl(spark, sf):
    """S10: clips as JSON lines, a folder a split, read back with their splits."""
    out = shared_folder(spark)
    rows = clips(spark, sf).select(splits.hash_split(F.col("path"), 0.1, 0.1).alias("split"), F.col("path").alias("audio_filepath"), F.round("duration", 3).alias("duration"), F.col("raw_text").alias("text"), F.col("source").alias("_source"))
    src.write_manifest(rows, out)
    return spark.read.schema("audio_filepath string, duration double, text string, split string").json(out).select("split", "audio_filepath", "duration", "text")


@query("manifest_pipe", f"WITH c AS ({CLIPS_SQL}), i AS (SELECT speaker, dense_rank() OVER (ORDER BY speaker) - 1 AS k FROM (SELECT DISTINCT speaker FROM c WHERE speaker IS NOT NULL)) SELECT path, audio_md5 AS phonemes, k::INT AS speaker_index FROM c JOIN i USING (speaker)")
def manifest_pipe(spark, sf):
    """S11: lines of path, what is said (here a digest of it) and speaker index, read back."""
    df = clips(spark, sf)
    index = splits.dense_index(df, "speaker").withColumnsRenamed({"speaker": "_s", "index": "speaker_index"})
    out = shared_folder(spark)
    src.write_pipe_manifest(df.join(index, F.col("speaker") == F.col("_s")).select("path", F.col("audio_md5").alias("phonemes"), "speaker_index"), out)
    return spark.read.option("sep", "|").option("quote", "").schema("path string, phonemes string, speaker_index int").csv(out)


def _written(spark: SparkSession, blocks: dict[str, DataFrame], shown: tuple[str, ...] = ()) -> DataFrame:
    """Blocks written as a report, all of them, and read back, those of `shown` if it names some: their
    rows as JSON objects of text values."""
    out = shared_folder(spark)
    src.write_reports(blocks, out)
    each = []
    for name in shown or blocks:
        back = spark.read.schema(blocks[name].schema).json(f"{out}/{name}")
        cells = F.array_join(F.array(*(F.coalesce(F.format_string("%.6f", c) if t in ("double", "float") else F.col(c).cast("string"), F.lit("-")) for c, t in sorted(back.dtypes))), "|")
        each.append(back.select(F.lit(name).alias("block"), cells.alias("row")))
    return reduce(DataFrame.unionByName, each)


def _cells(block: str, sql: str, *columns: str) -> str:
    """The same rows by SQL; columns in order, those marked ~ with six places."""
    cells = ", '|', ".join(f"coalesce(printf('%.6f', {c[1:]}::DOUBLE), '-')" if c[0] == "~" else f"coalesce({c}::VARCHAR, '-')" for c in columns)
    return f"SELECT '{block}' AS block, concat({cells}) AS row FROM ({sql})"


_CLASSED = f"{_CLASS}, p AS (SELECT *, {_SPLIT} AS split FROM k), q AS (FROM p WHERE drop_reason IS NULL)"


@query("prepare_report", f"WITH {_CLASSED} " + " UNION ALL ".join([
    _cells("drops", "SELECT drop_reason, count(*) AS clips FROM p WHERE drop_reason IS NOT NULL GROUP BY 1", "clips", "drop_reason"),
    _cells("sources", "SELECT source, count(*) AS clips, round(sum(duration) / 3600, 6) AS hours FROM q GROUP BY 1", "clips", "~hours", "source"),
    _cells("splits", "SELECT split, count(*) AS clips, round(sum(duration) / 3600, 6) AS hours FROM q GROUP BY 1", "clips", "~hours", "split"),
    _cells("totals", "SELECT count(*) AS clips, sum(duration) / 3600 AS hours, coalesce(sum(duration) FILTER (NOT synthetic), 0) / 3600 AS r, coalesce(sum(duration) FILTER (synthetic), 0) / 3600 AS s FROM q", "clips", "~hours", "~r", "~s"),
    _cells("style", r"SELECT avg(regexp_matches(text, '\p{Lu}')::INT) AS a, avg(regexp_matches(text, '[.!?,]')::INT) AS b FROM q", "~a", "~b"),
]))
def prepare_report(spark, sf):
    """S12: the blocks of a prepared speech corpus."""
    rows = kept(classified(spark, sf))
    return _written(spark, curation.prepare_report(rows))


@query("audit_report", " UNION ALL ".join([
    _cells("sources", ORACLES["source_profile"], "~clipped_share", "clips", "fmt", "~gap", "~max_dc", "~median_e8k", "~median_f999", "~median_s", "native_sr", "source", "tier", "~total_s"),
    _cells("rates", ORACLES["rate_histogram"], "clips", "native_sr", "source"),
    _cells("duplicates", ORACLES["duplicate_corpora"], "a", "b", "overlap", "~share_a", "~share_b"),
    _cells("speakers", ORACLES["speaker_report"].replace("SELECT * REPLACE (CASE WHEN idx % 2 = 1 THEN upper(speaker) ELSE speaker END AS speaker) FROM", "SELECT * FROM"), "best_tier", "clips", "speaker", "stage1", "stage2", "voice"),
]))
def audit_report(spark, sf):
    """S12: the blocks of an audit."""
    voices = spark.createDataFrame(VOICES, "name string, speaker_id string, stage2 boolean, stage2_sources array<string>")
    blocks = curation.audit_report(clips(spark, sf), voices)
    blocks["sources"] = blocks["sources"].withColumn("gap", F.round("gap", 3))
    return _written(spark, blocks)


@query("results_report", " UNION ALL ".join([
    _cells("results", ORACLES["wer_cer"], "~cer", "clips", "latency_ms", "model", "~wer"),
    _cells("comparison", ORACLES["system_compare"], "~baseline_wer", "~delta", "latency_ms", "~tuned_wer"),
]))
def results_report(spark, sf):
    """S12: the blocks of a benchmark. All are written; the rows are those of the blocks that the SQL has."""
    p = sentence_pairs(spark, sf)
    rates = scoring.rates(every_latency(scoring.measured(p)), "model", "latency_ms")
    blocks = curation.results_report(rates, scoring.tag_counts(every_latency(p), "model", "latency_ms"), "baseline", "tuned")
    return _written(spark, blocks, ("results", "comparison"))
