"""Streaming forms as queries: tables arrive as files in the shared folder, in two runs of a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lambi.functions import textnorm as tn
from lambi.operators import rules
from lambi.plans.catalog import _MAIL, MAX_S, MIN_S, ORACLES, clips, query, table
from lambi.plans.fixtures import CLIPS_SQL, NORM_SQL
from lambi.sources.shared import shared_folder
from lambi.streaming import quota


def in_two_runs(spark: SparkSession, early: DataFrame, late: DataFrame, start: Callable) -> str:
    """Folder of what a stream writes over files of `early` and, once they are done, of `late`.

    `start(stream, output, checkpoint)` begins a run over all files that have come; the second run goes
    on from the checkpoint of the first, with the state that it left.
    """
    top = shared_folder(spark)
    for rows in (early, late):
        rows.write.mode("append").parquet(f"{top}/in")
        stream = spark.readStream.schema(early.schema).parquet(f"{top}/in")
        run = start(stream, f"{top}/out", f"{top}/checkpoint")
        run.awaitTermination()
    return f"{top}/out"


def _to_parquet(df: DataFrame, output: str, checkpoint: str):
    return df.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


@query("quota_stream", ORACLES["quota_window"])
def quota_stream(spark, sf):
    """X01 with keyed state in the RocksDB store; the later half of the events comes after a restart."""
    e = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"))
    ends = e.agg(F.min("ts"), F.max("ts")).first()
    middle = None if ends[0] is None else ends[0] + (ends[1] - ends[0]) / 2
    before = F.col("ts") < F.lit(middle)
    out = quota.OUT
    with quota.rocksdb(spark):
        path = in_two_runs(spark, e.where(before), e.where(~before), lambda s, o, c: _to_parquet(quota.quota_stream(s, 5, 3600), o, c))
    return spark.read.schema(out).parquet(path).drop("ts", "reset")


@query("stream_curation", f"""WITH c AS ({CLIPS_SQL}), n AS (SELECT *, {NORM_SQL.format('raw_text')} AS text FROM c)
SELECT DISTINCT md5(lower(text)) AS content_key FROM n WHERE NOT (duration IS NULL OR text = '' OR duration < {MIN_S} OR duration > {MAX_S} OR duration <= 0 OR length(text) / duration > 25.0)""")
def stream_curation(spark, sf):
    """X02: rows that pass the speech rules, one of each content, over two runs."""
    df = clips(spark, sf).select("idx", tn.normalize(F.col("raw_text")).alias("text"), "duration", F.timestamp_seconds(F.col("idx")).alias("ts"))
    odd = F.col("idx") % 2 == 1

    def start(stream, output, checkpoint):
        kept = quota.curate_stream(stream, rules.speech_rules(F.col("text"), F.col("duration"), MIN_S, MAX_S), F.md5(F.lower("text")), "ts", "36500 days")
        return _to_parquet(kept.select("content_key"), output, checkpoint)

    path = in_two_runs(spark, df.where(odd), df.where(~odd), start)
    return spark.read.schema("content_key string").parquet(path)


@query("signup_sink", rf"SELECT email, left(trim(props), 1000) AS note, left(trim(event_type), 80) AS use_case, count(*) AS n FROM (SELECT *, trim(coalesce({_MAIL.format('VARCHAR')}, '')) AS email FROM events) WHERE regexp_matches(email, '^[^\s@]+@[^\s@]+\.[^\s@]+$') GROUP BY ALL")
def signup_sink(spark, sf):
    """X03: valid sign-ups appended as JSON lines with the time of their arrival, over two runs."""
    e = table(spark, sf, "events").select(F.expr(_MAIL.format("STRING")).alias("email"), F.col("props").alias("note"), F.col("event_type").alias("use_case"))
    first = F.length("note") % 2 == 0
    path = in_two_runs(spark, e.where(first), e.where(~F.coalesce(first, F.lit(False))), quota.write_signups)
    rows = spark.read.schema("email string, note string, use_case string, received timestamp").json(path)
    return rows.where("received is not null").groupBy("email", "note", "use_case").agg(F.count(F.lit(1)).alias("n"))
