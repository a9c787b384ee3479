import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lambi.llm.mixing import mix_sources

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, carried string, body string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    """Documents with further columns whose names the stages use themselves."""
    rows = [(i, t, ("en", "de", "fr", "es")[k % 4], f"src{k % 3}", len(t or ""), False, f"c{k}", "b") for k, (i, t) in enumerate(rows)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


def sample():
    rng = random.Random(11)
    words = lambda n: [f"{rng.choice('abcdefghij')}{rng.randint(0, 999)}" for _ in range(n)]
    base = words(200)
    near = [*base[:100], "other", *base[101:]]
    passage = " ".join(words(70))
    rows = [(i, " ".join(words(80))) for i in range(40)]
    rows += [(100, " ".join(base)), (101, " ".join(near)), (102, " ".join(base)), (103, " ".join(words(60)) + " " + passage), (104, passage + " " + " ".join(words(60)))]
    rows += [(105, "same words again " * 40), (106, "short"), (107, None), (108, ""), (109, " ".join(words(9000)))]
    rows += [(None, " ".join(words(70))), (None, "x y"), (110, " ".join(base[:90]) + " tail"), (110, " ".join(words(75)))]
    return rows + [rows[3], rows[3]]


def run_stages(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        rows = docs.collect()
        out.append((name, docs.columns, rows))
        docs = spark.createDataFrame(rows, docs.schema)
    return out


def test_stages_equal_brute_force(spark):
    from tokenizers import Tokenizer

    from lambi.llm.encoding import public_path

    rows, docs = table(spark, sample())
    got = run_stages(spark, docs)
    assert all(columns == docs.columns for _, columns, _ in got[:-1])

    def clean(t):
        w = WORD.findall(t or "")
        grams = Counter(zip(w, w[1:], w[2:]))
        return len(w) >= 50 and 100 * len({k for j in range(len(w) - 2) if grams[tuple(w[j : j + 3])] > 1 for k in range(j, j + 3)}) <= 50 * len(w)

    first = [r for r in rows if clean(r[1])]
    assert Counter(map(tuple, got[0][2])) == Counter(first)

    sets = lambda t: {tuple(w[j : j + 5]) for w in [WORD.findall(t.lower())] for j in range(len(w) - 4)}
    linked = lambda a, b: len(a & b) * 100 >= 80 * len(a | b)
    shingles = [(r, sets(r[1])) for r in dict(((r[0], r[1]), r) for r in first).values()]
    want = Counter((r[0], r[1]) for r, s in shingles if r[0] is None or not any(q[0] is not None and q[0] < r[0] and linked(s, z) for q, z in shingles))
    second = Counter((r["doc_id"], r["text"]) for r in got[1][2])
    assert second == want and second[(100, rows[40][1])] == 1 and not any(i in (101, 102) for i, _ in second)

    order = sorted(second, key=lambda x: (x[0] is not None, x[0] or 0))
    texts = {(r["doc_id"], r["carried"]): r["text"] for r in got[2][2]}
    seen: set[bytes] = set()
    for i, t in order:
        if i is None or i == 110:
            continue
        body, gone = t.encode(), set()
        mine = set()
        for s in range(len(body) - 99):
            w = body[s : s + 100]
            if w in seen or w in mine:
                gone.update(range(s, s + 100))
            mine.add(w)
        seen |= mine
        left = bytes(c for k, c in enumerate(body) if k not in gone).decode()
        assert [x for (j, _), x in texts.items() if j == i] == ([left] if left.strip() else []), i
    assert all(r["n_chars"] == len(r["text"]) for r in got[2][2])

    before = spark.createDataFrame(got[2][2], SCHEMA)
    copies = Counter()
    for r in mix_sources(before, carry=("doc_id", "text")).collect():
        copies[tuple(r["carried"])] += r["copies"]
    assert Counter((r["doc_id"], r["text"]) for r in got[3][2]) == +copies

    enc = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    pieces = got[4][2]
    want_ids = Counter()
    for r in got[3][2]:
        ids = [*enc.encode(r["text"], add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            want_ids[(r["doc_id"], k // 2048, tuple(ids[k : k + 2048]))] += 1
    assert Counter((r["doc_id"], r["piece"], tuple(r["ids"])) for r in pieces) == want_ids
    by_sequence: dict = {}
    for r in pieces:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        ends = [0, *(a + n for a, n in sorted(parts))]
        assert [a for a, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048


@pytest.mark.parametrize("rows", [[], [(None, None), (None, None)], [(1, ""), (1, "")]])
def test_whole_pipeline_on_hardly_anything(spark, tmp_path, rows):
    _, docs = table(spark, rows)
    docs.drop("kept").withColumn("kept", F.lit(None).cast("boolean")).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and {"doc_id", "ids", "sequence_id", "offset"} <= set(out.columns)
