import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from lambi.llm import licenses, mixing, urls, vectors
from lambi.llm.vectors import near_vectors


def docs(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["le", "cat", "a|b", "x@y", "of"]) for _ in range(rng.randint(0, 60))) + rng.choice(["", "\nReleased under the MIT License.", "\nLicensed under CC BY-NC 4.0.", "\nlicense"]), rng.choice(["en", "fr", None]), rng.choice(["src0", "src1", "src2"])) for i in range(200)]
    rows += [(500, None, "en", "src0"), (501, "", None, None), (502, "w " * 30_000, "de", "src9")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize(("run", "sql"), [(mixing.mix_sources, mixing.ORACLE), (lambda d: licenses.scan_licenses(d, F.expr(licenses.PATH)), licenses.ORACLE)])
def test_equals_sql(spark, run, sql):
    rows, df = docs(spark)
    out = run(df.withColumn("n_tokens", F.lit(1)).withColumn("weight", F.lit(1)).withColumn("folder", F.lit("f")))
    c = duckdb.connect()
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"])  # noqa: F841
    c.execute("CREATE TABLE documents AS SELECT * FROM documents")
    cols = ", ".join(out.columns)
    want = c.execute(f"SELECT {cols} FROM ({sql})").fetchall()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, map(tuple, out.collect()))) == sorted(map(key, want))
    assert run(df.limit(0)).count() == 0


def test_raking_meets_marginals(spark):
    cells = spark.createDataFrame([(s, g, "t", float(10 * i + j + 5)) for i, s in enumerate("abc") for j, g in enumerate(["en", "de"])], "source string, lang string, topic string, tokens double")
    fitted = mixing.rake(cells, {"source": 0.0, "lang": {"en": 0.7, "de": 0.3}, "topic": 1.0}, rounds=50).join(cells, ["source", "lang", "topic"]).withColumn("m", F.col("weight") * F.col("tokens"))
    total = fitted.agg(F.sum("m")).first()[0]
    assert all(abs(r["m"] / total - 1 / 3) < 1e-6 for r in fitted.groupBy("source").agg(F.sum("m").alias("m")).collect())
    assert abs(fitted.where("lang = 'en'").agg(F.sum("m")).first()[0] / total - 0.7) < 1e-6


def test_raking_apart_equals_raking_together(spark):
    rng = random.Random(2)
    cells = spark.createDataFrame([(f"s{i}", g, t, float(rng.randint(1, 900))) for i in range(30) for g in ("en", "de", "xx") for t in ("a", "b") if rng.random() < 0.8], "source string, lang string, topic string, tokens double")
    one, two = ({(r["source"], r["lang"], r["topic"]): (r["weight"], r["residual"]) for r in mixing.rake(cells, mixing.TARGETS, 5, together=n).collect()} for n in (1000, 10))
    assert one.keys() == two.keys() and all(np.allclose(one[k], two[k], rtol=1e-9, atol=1e-12) for k in one)
    assert 0 < next(iter(one.values()))[1] < 0.1


URLS = [
    (1, "http://blog.A.Example.com/en/7?x", "blog.a.example.com", "/en/7", "example.com/en/7", "allow"), (2, "https://x.com/en/9", "x.com", "/en/9", "com/en/", "block"), (3, "http://notcom/en/", "notcom", "/en/", None, None),
    (4, None, "", "", None, None), (5, "no scheme/en/", "", "", None, None), (6, "http://a.net/de/", "a.net", "/de/", "net/de/", "block"), (7, "http://a.example.net/de/81#t", "a.example.net", "/de/81", "example.net/de/8", "allow"),
    (8, "http://b.org", "b.org", "", None, None), (9, "http://b.org?q=/es/", "b.org", "", None, None), (10, "", "", "", None, None), (11, "http://" + "h" * 30_000 + ".org/es/", "h" * 30_000 + ".org", "/es/", "org/es/", "block"), (None, "://com/en/", "com", "/en/", "com/en/", "block"),
]


def test_url_verdicts(spark):
    df = spark.createDataFrame([(i, u, 1, "r") for i, u, *_ in URLS], "page_id long, url string, label int, rule string")
    labelled = spark.createDataFrame(urls.LABELLED, "url string, label int")
    got = {r["page_id"]: r for r in urls.judge_urls(df, labelled).collect()}
    for i, _, host, path, rule, verdict in URLS:
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    assert urls.judge_urls(df.limit(0), labelled).count() == 0
    own = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls.LABELLED)], "page_id long, url string")
    right = sum((r["verdict"] == "block") == urls.LABELLED[r["page_id"]][1] for r in urls.judge_urls(own, labelled, rules=[]).collect())
    assert right >= 22


def test_url_scores_equal_a_plain_model(spark):
    labelled = spark.createDataFrame(urls.LABELLED, "url string, label int")
    model = urls.train_urls(labelled)
    hashing = HashingTF(numFeatures=urls.FEATURES)
    rows = [(i, u, None) for i, (u, *_) in enumerate(urls.LABELLED)] + [(100, "https://CASINO.win/slots?x", "y"), (101, "http://é.org/ü" * 300, "z"), (102, None, "z"), (103, "", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string").withColumnRenamed("url", "address")
    got = {r["page_id"]: r for r in urls.judge_urls(df, labelled, rules=[], url_col="address").collect()}
    for i, u, _ in rows:
        rest = (u or "").partition("://")[2]
        end = min([k for k in map(rest.find, "/?#") if k >= 0], default=len(rest))
        host, path = rest[:end], rest[end:].split("?")[0].split("#")[0]
        framed = [f"^{host.lower()}^", f"${path.lower()}$"]
        at = {hashing.indexOf(t[k : k + n]) for t in framed for n in urls.GRAMS for k in range(len(t) - n + 1)}
        score = 1 / (1 + np.exp(-(model.intercept + sum(model.coefficients[int(k)] for k in at))))
        assert abs(got[i]["score"] - score) < 2e-6 and got[i]["verdict"] == ("block" if score >= 0.5 else "allow"), u


def test_near_vectors(spark):
    rng = np.random.default_rng(5)
    rows, n = [], 0
    for label in (0, 1):
        for _ in range(30):
            centre = rng.normal(size=16)
            for _ in range(rng.integers(1, 8)):
                rows.append((n, (centre + rng.normal(size=16) * 0.09).tolist(), label))
                n += 1
    rows += [(n, rows[0][1], 0), (n + 1, rows[0][1], 1), (n + 2, [0.0] * 16, 0), (n + 3, None, 0), (n + 4, [float("nan")] * 16, 0), (n + 5, rows[0][1], None), (n + 6, [None] * 16, 0), (n + 7, [1.0, 2.0], 0), (n + 8, [], 1)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, n int, shard string")
    out = {r["vec_id"]: r for r in near_vectors(df).collect()}
    good = [(i, np.asarray(v, np.float32).astype(float), g) for i, v, g in rows if g is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = {i: set() for i, *_ in rows}
    for i, a, g in good:
        for j, b, h in good:
            if i != j and g == h and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
                links[i].add(j)
    for i in links:
        reach, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - reach
            reach |= new
            todo += new
        assert (out[i]["n_links"], out[i]["component_id"], out[i]["kept"]) == (len(links[i]), min(reach), min(reach) == i), i
    assert len(out) == len(rows) and out[0]["audit_recall"] == 1.0
    assert near_vectors(df.limit(0)).count() == 0


def test_search_connects_a_group_of_near_copies():
    """All of a graph are in range of each other: each query finds its beam at least, and the finds connect all."""
    r = np.random.default_rng(3)
    x = r.normal(size=64) + r.normal(size=(1024, 64)) * 0.05
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    edges = vectors.build_graph(x)
    at, _ = np.nonzero(edges >= 0)
    table = vectors._both_ways(at, edges[edges >= 0], len(x))
    a, b = vectors.range_search(x, table, x, np.arange(len(x)), 0.98)
    assert (np.einsum("id,id->i", x[a], x[b]) >= 0.98).all()
    assert np.bincount(a, minlength=len(x)).min() > vectors.BEAM
    below, root = vectors._forest(a, b)
    assert len(below) == len(x) - 1 and (root == 0).all()
