import json

import pytest
from pyspark.sql import functions as F

from lambi.operators.rules import speech_rules
from lambi.plans import streams
from lambi.sources import tables as src
from lambi.streaming import quota


def test_pick_column():
    assert src.pick_column(["ID", "Sentence", "text"], src.TEXT) == "text"
    assert src.pick_column(["Sentence"], src.TEXT) == "Sentence"
    assert src.pick_column(["a"], src.SPEAKER, None, False) is None
    with pytest.raises(ValueError):
        src.pick_column(["a"], src.TEXT)
    with pytest.raises(ValueError):
        src.pick_column(["Text"], src.TEXT, "text")


def test_loose_files(spark, tmp_path):
    for d, name in (("a", "x.wav"), ("b", "x.wav"), ("b", "y.wav")):
        (tmp_path / d).mkdir(exist_ok=True)
        (tmp_path / d / name).write_bytes(d.encode())
    meta = tmp_path / "meta.csv"
    meta.write_text("file_name,text\nclips/x.wav,wi\nz.wav,non\ny.wav,men\n")
    assert src.is_loose(spark, str(tmp_path))
    got = sorted((r["raw_text"], bytes(r["audio"])) for r in src.read_loose(spark, str(tmp_path), str(meta)).collect())
    assert got == [("men", b"b"), ("wi", b"b")]


def test_predictions_take_their_own_column(spark, tmp_path):
    rows = [{"text": "a", "hypothesis": "b"}, {"text": "c", "pred": "d", "transcript": "x"}, {"text": "e", "pred_text": "f", "pred": "y"}, {"text": "g"}]
    (tmp_path / "l.json").write_text("\n" + "\n".join(map(json.dumps, rows)))
    (tmp_path / "a.json").write_text(" \n" + json.dumps(rows, indent=1))
    for name in ("l.json", "a.json"):
        assert {r["text"]: r["pred_text"] for r in src.read_predictions(spark, str(tmp_path / name)).collect()} == {"a": "b", "c": "d", "e": "f", "g": None}
    (tmp_path / "n.json").write_text('{"text": "a"}')
    with pytest.raises(ValueError):
        src.read_predictions(spark, str(tmp_path / "n.json"))


def test_manifests_and_reports(spark, tmp_path):
    df = spark.createDataFrame([("/a", "ɡa", 0, "train", "x")], "path string, phonemes string, speaker_index int, split string, _source string")
    src.write_manifest(df, str(tmp_path / "m"))
    back = spark.read.json(str(tmp_path / "m"))
    assert "_source" not in back.columns and back.first()["phonemes"] == "ɡa"
    src.write_pipe_manifest(df, str(tmp_path / "p"))
    assert spark.read.text(str(tmp_path / "p")).first()[0] == "/a|ɡa|0"
    blocks = {"drops": df.groupBy("split").count(), "speakers": df.select("path", "speaker_index")}
    for _ in range(2):
        src.write_reports(blocks, str(tmp_path / "r"))
    assert src.read_report(spark, str(tmp_path / "r"), "drops").first().asDict() == {"split": "train", "count": 1}
    assert src.read_report(spark, str(tmp_path / "r"), "speakers").count() == 1


def test_row_limit_counts_rows_of_the_table(spark, tmp_path):
    spark.range(10).selectExpr("CAST(id AS STRING) AS text").write.parquet(str(tmp_path / "t"))
    assert src.read_columnar(spark, str(tmp_path / "t"), limit=3, need_audio=False).count() == 3
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "b.wav").write_bytes(b"b")
    (tmp_path / "meta.csv").write_text("file_name,text\na.wav,wi\nb.wav,non\n")
    assert src.read_loose(spark, str(tmp_path / "w"), str(tmp_path / "meta.csv"), limit=1).count() == 0


EVENTS = [("a", 1, "2024-01-01 00:00:00"), ("a", 2, "2024-01-01 00:30:00"), ("a", 3, "2024-01-01 00:59:59"), ("a", 4, "2024-01-01 01:00:00"), ("b", 5, "2024-01-01 00:10:00")]


def events(spark):
    return spark.createDataFrame(EVENTS, "key string, id long, t string").select("key", "id", F.to_timestamp("t").alias("ts"))


def test_quota_batch(spark):
    got = {r["id"]: (r["ok"], r["remaining"], r["retry_after"]) for r in quota.quota_batch(events(spark), 2, 3600).collect()}
    assert got == {1: (True, 1, 0), 2: (True, 0, 0), 3: (False, 0, 1), 4: (True, 1, 0), 5: (True, 1, 0)}


def test_quota_stream_equals_batch(spark, tmp_path):
    pytest.importorskip("google.protobuf")
    events(spark).coalesce(1).write.parquet(str(tmp_path / "in"))
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema(events(spark).schema).parquet(str(tmp_path / "in"))
        q = quota.quota_stream(stream, 2, 3600).writeStream.format("memory").queryName("quota").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        cols = ["key", "id", "ok", "remaining", "retry_after"]
        assert sorted(map(tuple, spark.table("quota").select(cols).collect())) == sorted(map(tuple, quota.quota_batch(events(spark), 2, 3600).select(cols).collect()))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)


def test_stream_curation_keeps_one_copy(spark, tmp_path):
    df = spark.createDataFrame([("wi wi", 3.0, "2024-01-01 00:00:00"), ("wi wi", 3.0, "2024-01-01 00:05:00"), ("", 3.0, "2024-01-01 00:06:00")], "text string, duration double, t string").select("text", "duration", F.to_timestamp("t").alias("ts"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    out = quota.curate_stream(stream, speech_rules(F.col("text"), F.col("duration")), F.md5("text"), "ts")
    q = out.writeStream.format("memory").queryName("curated").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("curated").count() == 1


def test_signups_are_appended(spark, tmp_path):
    df = spark.createDataFrame([("a@b.ht", "n", "u"), ("nope", "n", "u")], "email string, note string, use_case string")
    df.write.parquet(str(tmp_path / "in"))
    q = quota.write_signups(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    rows = spark.read.json(str(tmp_path / "out")).collect()
    assert [r["email"] for r in rows] == ["a@b.ht"] and rows[0]["received"]


def test_late_and_repeated_events_after_a_restart(spark):
    pytest.importorskip("google.protobuf")
    rows = lambda data: spark.createDataFrame(data, "key string, id long, t string").select("key", "id", F.to_timestamp("t").alias("ts"))
    early = rows([("a", 3, "2024-01-01 10:20:00"), ("a", 1, "2024-01-01 10:00:00"), ("a", 2, "2024-01-01 10:10:00")])
    late = rows([("a", 4, "2024-01-01 11:00:00"), ("a", 2, "2024-01-01 10:15:00"), ("a", 9, "2024-01-01 02:00:00"), ("b", 5, "2024-01-01 10:59:00")])
    with quota.rocksdb(spark):
        path = streams.in_two_runs(spark, early, late, lambda s, o, c: streams._to_parquet(quota.quota_stream(s, 2, 3600), o, c))
    got = sorted((r["key"], r["ts"].strftime("%H:%M"), r["id"], r["ok"], r["remaining"]) for r in spark.read.parquet(path).collect())
    # the window of 10:00 goes on after the restart, the repeated event counts, the late one is dropped
    assert got == [("a", "10:00", 1, True, 1), ("a", "10:10", 2, True, 0), ("a", "10:15", 2, False, 0), ("a", "10:20", 3, False, 0), ("a", "11:00", 4, True, 1), ("b", "10:59", 5, True, 1)]


def test_present_nulls_of_predictions_stay(spark, tmp_path):
    rows = [{"text": "a", "pred_text": None, "hypothesis": "b"}, {"text": "c", "pred": None, "hypothesis": "d", "n": {"x": 1}}, {"text": "e", "hypothesis": "f", "n": None}]
    (tmp_path / "l.json").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=1))
    for name in ("l.json", "a.json"):
        got = src.read_predictions(spark, str(tmp_path / name))
        assert {r["text"]: r["pred_text"] for r in got.collect()} == {"a": None, "c": None, "e": "f"} and "n" in got.columns


def test_counts_come_from_footers(spark, tmp_path):
    spark.range(1000).withColumn("x", F.rand()).repartition(3).write.parquet(str(tmp_path / "t"))
    out = src.footer_counts(spark, {"t": str(tmp_path / "t"), "gone": str(tmp_path / "gone")})
    assert {r["name"]: r["n"] for r in out.collect()} == {"t": 1000, "gone": None}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "ReadSchema: struct<count(*):bigint>" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_manifest_replaces_only_its_splits(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(r, "path string, split string")
    src.write_manifest(rows(("a", "train"), ("b", "val")), str(tmp_path / "m"))
    src.write_manifest(rows(("c", "val")), str(tmp_path / "m"))
    assert sorted(map(tuple, spark.read.json(str(tmp_path / "m")).collect())) == [("a", "train"), ("c", "val")]
