from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from lambi.llm.mixing import TARGETS, mix_sources


def test_mixing_stage_meets_targets_by_copies(spark):
    """Rare languages are repeated as often as their weight says; rows of one id keep their own text and count."""
    langs = ["en"] * 12 + ["de"] * 4 + ["fr"] * 3 + ["es"]
    rows = [(i, "w " * (20 + i % 7), langs[i % 20], f"src{i // 20 % 3}", 1) for i in range(2000)]
    rows += [(5, "twice " * 9, "es", "src0", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.mixing(spark, docs, "")
    assert out.columns == docs.columns
    got = Counter(map(tuple, out.collect()))
    drawn = {(r["doc_id"], r["lang"]): r["copies"] for r in mix_sources(docs).collect()}
    assert got == Counter({r: drawn[r[0], r[2]] for r in rows if drawn[r[0], r[2]]}) and max(got.values()) > 1
    tokens = {r["lang"]: r["n"] for r in out.groupBy("lang").agg(F.sum(F.size(F.split(F.trim("text"), " "))).alias("n")).collect()}
    for lang, share in TARGETS["lang"].items():
        assert abs(tokens[lang] / sum(tokens.values()) - share) < 0.03, tokens
