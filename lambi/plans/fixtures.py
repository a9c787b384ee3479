"""Clip and scoring views over the given tables, for Spark and, as SQL, for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lambi.sources.tables import spread

_CLIPS = """
SELECT doc_id AS idx, source, CAST(substring(source, 4) AS INT) AS source_ord, text AS raw_text,
       CASE WHEN doc_id % 97 = 0 THEN NULL ELSE concat('spk', CAST(doc_id * 7 % 40 AS {s})) END AS speaker,
       n_chars / (CAST(8.0 AS DOUBLE) + doc_id % 24) AS duration, source IN ('src0', 'src3', 'src5') AS synthetic,
       CASE doc_id % 4 WHEN 0 THEN 16000 WHEN 1 THEN 22050 ELSE 24000 END AS native_sr,
       power(CAST(10.0 AS DOUBLE), -(doc_id % 9)) AS e8k,
       concat('/wav/', source, '/', lpad(CAST(doc_id AS {s}), 7, '0'), '.wav') AS path, md5(text) AS audio_md5,
       CASE doc_id % 3 WHEN 0 THEN 'flac' ELSE 'wav' END AS fmt, CAST(4000 + doc_id % 8 * 1000 AS DOUBLE) AS f999,
       (doc_id % 11) / CAST(1000.0 AS DOUBLE) AS clip_ratio, (doc_id % 13) / CAST(2000.0 AS DOUBLE) AS dc_offset
FROM documents"""
CLIPS_SQL = _CLIPS.format(s="VARCHAR")
NORM_SQL = (
    r"regexp_replace(trim(regexp_replace(replace(replace(translate(translate(regexp_replace(regexp_replace(nfc_normalize(coalesce({0}, '')), '[\x00-\x08\x0b-\x1f\x{{7f}}-\x{{9f}}]', ' ', 'g'), "
    r"'[\[(<](?:noise|inaudible|unk|silence|music|laugh|applause|foreign|uh+|um+)[^\])>]*[\])>]', ' ', 'gi'), '‘’ʼʹ′´`', ''''''''''''''''), "
    "'“”„«»‐‑‒–—―', '\"\"\"\"\"------'), chr(8203), ''), chr(160), ' '), '\\s+', ' ', 'g')), '\\s+([,.!?;:])', '\\1', 'g')"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; documents, whose texts are costly to work on, over all cores."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name == "documents" else df


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.selectExpr(
        "doc_id AS idx", "source", "CAST(substring(source, 4) AS INT) AS source_ord", "text AS raw_text", "CASE WHEN doc_id % 97 = 0 THEN NULL ELSE concat('spk', CAST(doc_id * 7 % 40 AS STRING)) END AS speaker",
        "n_chars / (8.0D + doc_id % 24) AS duration", "source IN ('src0', 'src3', 'src5') AS synthetic", "CASE doc_id % 4 WHEN 0 THEN 16000 WHEN 1 THEN 22050 ELSE 24000 END AS native_sr",
        "power(10.0D, -(doc_id % 9)) AS e8k", "concat('/wav/', source, '/', lpad(CAST(doc_id AS STRING), 7, '0'), '.wav') AS path", "md5(text) AS audio_md5",
        "CASE doc_id % 3 WHEN 0 THEN 'flac' ELSE 'wav' END AS fmt", "CAST(4000 + doc_id % 8 * 1000 AS DOUBLE) AS f999", "(doc_id % 11) / 1000.0D AS clip_ratio", "(doc_id % 13) / 2000.0D AS dc_offset",
    )


_NOISY = """concat(CASE WHEN doc_id % 3 = 0 THEN '[noise] ' WHEN doc_id % 3 = 1 THEN '(Laughs {e}) ' ELSE '' END, CASE WHEN doc_id % 2 = 0 THEN replace(replace(text, '{e}', 'e{acute}'), ', ', ' ,{nbsp}') ELSE replace(text, ' de ', ' d’{zwsp}') END,
       CASE WHEN doc_id % 5 = 0 THEN ' “fin” {control} — !' ELSE '' END)""".format(e="é", acute="\u0301", nbsp="\u00a0", zwsp="\u200b", control="\x07")
NOISY_SQL = f"SELECT doc_id, {_NOISY} AS text FROM documents"


def noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with annotations, decomposed accents, odd blanks, quotes and control characters."""
    return table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_NOISY} AS text")


MODELS = [("baseline", 3), ("tuned", 7)]
LATENCIES = [80, 320]


def _pairs(texts: DataFrame) -> DataFrame:
    """Reference and hypothesis of two models: every k-th word is lost, of the others every fifth is
    misheard. `texts` has doc_id and text; all words of it count."""
    words = F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ")
    models = F.explode(F.array(*(F.struct(F.lit(m).alias("model"), F.lit(k).alias("k")) for m, k in MODELS)))
    df = texts.select("doc_id", words.alias("rw"), models.alias("m")).select("doc_id", "rw", "m.*")
    kept = F.expr("filter(rw, (w, i) -> (i + 1) % k <> 0)")
    df = df.withColumn("hw", kept).withColumn("hw", F.expr("transform(hw, (w, i) -> CASE WHEN (i + 1) % 5 = 0 THEN replace(w, 'e', 'a') ELSE w END)"))
    hyp = F.concat(F.array_join("hw", " "), F.when(F.col("doc_id") % 10 == 0, " <fr-FR>").otherwise(""))
    return df.select("doc_id", "model", F.when(F.col("doc_id") % 50 == 0, "").otherwise(F.array_join("rw", " ")).alias("reference"), hyp.alias("hypothesis"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of whole documents."""
    return _pairs(table(spark, sf_dir, "documents").select("doc_id", "text"))


def deletion_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents against themselves without every k-th word."""
    words = F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ")
    models = F.explode(F.array(*(F.struct(F.lit(m).alias("model"), F.lit(k).alias("k")) for m, k in MODELS)))
    df = table(spark, sf_dir, "documents").select("doc_id", "text").select("doc_id", words.alias("rw"), models.alias("m")).select("doc_id", "rw", "m.*")
    return df.select("doc_id", "model", F.array_join("rw", " ").alias("reference"), F.array_join(F.expr("filter(rw, (w, i) -> (i + 1) % k <> 0)"), " ").alias("hypothesis"))


_SENTENCE = r"[^.!?]*[.!?]"


def sentence_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of every sentence of all conversations, which are short enough for SQL."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.regexp_extract_all("text", F.lit(_SENTENCE), F.lit(0))).alias("i", "text"))
    return _pairs(turns.select((F.col("conv_id") * 1000000 + F.col("turn") * 1000 + F.col("i")).alias("doc_id"), "text"))


def every_latency(df: DataFrame) -> DataFrame:
    """Rows repeated for each latency, at which both models give the same hypotheses."""
    return df.withColumn("latency_ms", F.explode(F.array(*map(F.lit, LATENCIES))))


def _pairs_sql(texts: str) -> str:
    return rf"""
SELECT doc_id, model, latency_ms, CASE WHEN doc_id % 50 = 0 THEN '' ELSE array_to_string(rw, ' ') END AS reference,
       concat(array_to_string(list_transform(hw, lambda w, i: CASE WHEN i % 5 = 0 THEN replace(w, 'e', 'a') ELSE w END), ' '), CASE WHEN doc_id % 10 = 0 THEN ' <fr-FR>' ELSE '' END) AS hypothesis
FROM (SELECT doc_id, model, rw, list_filter(rw, lambda w, i: i % k <> 0) AS hw
      FROM (SELECT doc_id, string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ') AS rw FROM ({texts})), (VALUES ('baseline', 3), ('tuned', 7)) m(model, k)),
     (VALUES (80), (320)) l(latency_ms)"""


PAIRS_SQL = _pairs_sql("SELECT doc_id, text FROM documents")
SENTENCE_PAIRS_SQL = _pairs_sql(f"SELECT conv_id * 1000000 + turn * 1000 + i - 1 AS doc_id, text FROM (SELECT conv_id, turn, unnest(s) AS text, unnest(range(1, len(s) + 1)) AS i FROM (SELECT conv_id, turn, regexp_extract_all(text, '{_SENTENCE}') AS s FROM conversations))")


def waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("passage"), F.col("embedding").alias("wave"), F.lit(16000).alias("sr"))


def refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), (10 + F.col("vec_id") % 390).cast("int").alias("length"), F.col("embedding").alias("vec"))


_LOUD = "CASE vec_id % 5 WHEN 0 THEN 1e-6 WHEN 1 THEN 2.0 ELSE 0.5 END"


def long_waves(spark: SparkSession, sf_dir: str, block: int = 500) -> DataFrame:
    """Waves of many samples: the embeddings of a label among `block` ids in order, each at a level of
    its own (some nearly silent). passage is the label, segment the block."""
    e = table(spark, sf_dir, "embeddings").withColumn("segment", F.floor(F.col("vec_id") / block)).withColumn("gain", F.expr(_LOUD).cast("double"))
    grouped = e.groupBy("label", "segment").agg(F.sort_array(F.collect_list(F.struct("vec_id", "gain", "embedding"))).alias("all"))
    wave = F.flatten(F.transform("all", lambda x: F.transform(x["embedding"], lambda v: v.cast("double") * x["gain"])))
    return grouped.select(F.col("label").cast("long").alias("passage"), "segment", wave.alias("wave"), F.lit(16000).alias("sr"))


LONG_WAVES_SQL = f"SELECT label::BIGINT AS passage, vec_id // 500 AS segment, flatten(list(list_transform(embedding, lambda v: v::DOUBLE * ({_LOUD})) ORDER BY vec_id)) AS wave FROM embeddings GROUP BY label, vec_id // 500"
