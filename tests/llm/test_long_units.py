"""Long texts in operators 9 and 10."""

import random
import time

from pyspark.sql import functions as F

from lambi.llm import licenses, urls


def test_grams_like_slices(spark):
    texts = ["", "^", "^a^", "^ab😀é^", "^\n ab\\$^" * 3]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("t", urls._grams(F.col("t")).alias("g")).collect()
    for r in got:
        assert r["g"] == [r["t"][i : i + n] for n in urls.GRAMS for i in range(len(r["t"]) - n + 1)]


def test_urls_of_a_megabyte(spark):
    labelled = spark.createDataFrame(urls.LABELLED, "url string, label int")
    pages = spark.createDataFrame([(1, "data://" + "ab/é?" * 10 + "x" * 1_000_000), (2, "http://a.b/" + "c1" * 500_000)], "page_id long, url string")
    began = time.time()
    assert len(urls.judge_urls(pages, labelled).collect()) == 2
    assert time.time() - began < 60


def test_long_licence_texts_are_compared(spark):
    rng = random.Random(3)
    body = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(900))
    files = [(1, "a/x", body + " and no more."), (2, "b/x", " ".join(body.split()[:880])), (3, "c/x", "other words " * 400), (4, "d/x", None)]
    df = spark.createDataFrame(files, "doc_id long, path string, text string")
    got = {r["doc_id"]: r["own"] for r in licenses.scan_licenses(df, F.col("path"), [("Long", body), ("MIT", "permission is hereby granted free of charge")]).collect()}
    assert got == {1: "Long", 2: "Long", 3: None, 4: None}
