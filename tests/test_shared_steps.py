import random

from pyspark.sql import functions as F

from lambi.functions import phonemes as ph
from lambi.functions.pieces import UNKNOWN, tokenizer, word_counts
from lambi.operators import coverage
from lambi.plans import catalog, fixtures
from lambi.sources import tables as src

SMALL = "/root/testdata/sf0.001"


def test_index_counts_on_over_files(spark, tmp_path):
    for part, ids in (("a", [5, 3, 9]), ("b", [1]), ("c", [7, 8])):
        spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / f"part={part}"))
    rows = src.read_columnar(spark, str(tmp_path), need_audio=False).select("idx", "raw_text").collect()
    assert sorted(map(tuple, rows)) == [(0, "t5"), (1, "t3"), (2, "t9"), (3, "t1"), (4, "t7"), (5, "t8")]


def test_phonemes_by_steps_equal_those_by_tokens(spark):
    rng = random.Random(8)
    parts = ["oun", "ann", "enn", "onn", "an", "en", "on", "ou", "ui", "ch", "ny", "n", "y", "a", "e", "o", "u", "i", "é", "x", "g", "r", "*", "", "", "'", " ", "\t", "\n", ".", ",", ";", "12", "3.5", "1,234,567", "007", "٣", "$", "9 8"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for i in range(3000)] + [(-1, None), (-2, "")]
    df = spark.createDataFrame(rows, "i long, t string")
    for keep in (True, False):
        plain = F.trim(F.regexp_replace(F.array_join(F.transform(ph.tokens(F.col("t")), lambda x: ph.token_phonemes(x, keep)), ""), " +", " "))
        assert df.select("t", ph.phonemes(F.col("t"), keep).alias("a"), plain.alias("b")).where("not (a <=> b)").collect() == []


def test_tokens_of_counted_words_equal_those_of_texts(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice(["ab", "b", "abc", "é", "日", " ", "\n", "\t", "\x0b"]) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in [*texts, "", None]], "text string")
    tok = tokenizer(spark.createDataFrame([("a", 1), ("ab", 2), ("b", 3)], "piece string, id int"))
    whole, words = df.withColumn("tokens", tok(F.col("text"))), word_counts(df, "text").withColumn("tokens", tok(F.col("word")))
    assert words.count() < 1500
    assert coverage.token_report(whole, "text", "tokens", UNKNOWN).collect() == coverage.token_report(words, "word", "tokens", UNKNOWN, weight="n").collect()
    assert coverage.unknown_pieces(whole, "text", "tokens", UNKNOWN).collect() == coverage.unknown_pieces(words, "word", "tokens", UNKNOWN, weight="n").collect()
    one = spark.createDataFrame([("ab cd " * 5000,)], "text string")
    assert word_counts(one, "text").count() == 2


def test_classified_reads_the_texts_once(spark):
    plan = catalog.classified(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "raw_text" not in plan and "regexp" not in plan.lower()


def test_prepare_report_reads_its_rows_once(spark, monkeypatch):
    from lambi.plans import rounds

    seen = []
    monkeypatch.setattr(rounds.curation, "prepare_report", lambda rows: seen.append(rows._jdf.queryExecution().optimizedPlan().toString()) or {"rows": rows.select("idx")})
    rounds.prepare_report(spark, SMALL).count()
    assert "Join" not in seen[0] and fixtures.CLIPS_SQL
