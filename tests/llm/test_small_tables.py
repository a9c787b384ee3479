"""Every operator on tables of a row or two, of nulls only, and on repeated rows."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lambi.llm import idstore, licenses, minhash, mixing, packing, quality, shared, substrings, suffix_tree_lm, urls, vectors
from lambi.llm.encoding import public_path
from lambi.llm.shared import cut, scratch

TABLES = {
    "one": [(1, "one")],
    "blank": [(None, None), (1, None), (2, " \n")],
    "copies": [(3, "a b c d e f g " * 30)] * 2,
}
PER_ROW = {
    "minhash": lambda d: minhash.near_duplicates(d, k=2),
    "store": lambda d: idstore.read_ids(d.sparkSession, idstore.write_ids(d, public_path("byte_bpe_50k.json"))),
    "quality": quality.repetition_coverage,
    "substrings": substrings.remove_repeats,
    "mixing": mixing.mix_sources,
    "tree": suffix_tree_lm.score_documents,
    "packing": lambda d: packing.pack_documents(d, public_path("word_bpe_49k.json")),
    "licenses": lambda d: licenses.scan_licenses(d, F.expr(licenses.PATH)),
}


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("table", TABLES)
@pytest.mark.parametrize("operator", PER_ROW)
def test_one_row_out_per_row_in(spark, operator, table):
    rows = TABLES[table]
    out = PER_ROW[operator](documents(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0) for r in out) == sorted((i or 0) for i, _ in rows)


@pytest.mark.parametrize("rows", [[(1, [1.0, 0.0], 0)], [(1, None, None)], [(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0)]])
def test_few_vectors(spark, rows):
    out = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"]) for r in out} == {(i, len(rows) - 1, 1) for i, _, _ in rows}


@pytest.mark.parametrize("rows", [[(1, None)], [(None, "x")], [(1, "http://A.com/en/7")]])
def test_few_urls(spark, rows):
    labelled = spark.createDataFrame(urls.LABELLED, "url string, label int")
    out = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), labelled).collect()
    assert [r["page_id"] for r in out] == [i for i, _ in rows] and out[0]["verdict"] in ("allow", "block")


def test_stages_on_repeated_rows(spark):
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(80))
    docs = documents(spark, [(3, text), (3, text), (4, text + " more")])
    kept = {"quality rules": 3, "near dedup": 2, "substring dedup": 3}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.count() <= kept.get(name, 3), name
    left = corpus_pipeline.substring_dedup(spark, docs, "").collect()
    assert sorted((r["doc_id"], r["text"].strip() == "more", r["lang"]) for r in left) == [(3, False, "en"), (3, False, "en"), (4, True, "en")]


def test_scratch_folders_are_deleted(spark, tmp_path, monkeypatch):
    import os

    documents(spark, [(1, "".join(f"w{i} " for i in range(90)))]).write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    monkeypatch.setattr(shared, "_SCRATCH", [str(tmp_path / "shared")])
    with scratch(spark):
        assert cut(spark.range(3)).count() == 3 and len(os.listdir(tmp_path / "shared")) == 1
    assert not os.listdir(tmp_path / "shared")
    assert corpus_pipeline.run(spark, str(tmp_path / "sf")).count() == 1
    assert len(os.listdir(tmp_path / "shared")) == 1
