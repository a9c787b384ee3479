"""The trie tokenizer against a plain longest match."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lambi.functions import pieces
from lambi.functions.pieces import UNKNOWN, Trie, tokenizer
from lambi.operators import coverage


def plain(text, vocabulary):
    out, at = [], 0
    while at < len(text):
        if text[at] in " \t\n\v\f\r":
            at += 1
            continue
        best = max((p for p in vocabulary if p and text.startswith(p, at)), key=len, default=None)
        if best is not None:
            out.append((vocabulary[best], at, at + len(best)))
        elif out and out[-1][0] == UNKNOWN and out[-1][2] == at:
            out[-1] = (UNKNOWN, out[-1][1], at + 1)
        else:
            out.append((UNKNOWN, at, at + 1))
        at += len(best or "x")
    return out


@pytest.mark.parametrize("seed", range(4))
def test_like_a_plain_match(spark, monkeypatch, seed):
    monkeypatch.setattr(pieces, "SLICE", 40)
    rng = random.Random(seed)
    letters = "abcé漢😀"
    vocabulary = {"".join(rng.choices(letters[: rng.randint(1, 6)], k=rng.randint(1, 6))): i for i in range(1, rng.choice([2, 30, 300]))}
    texts = [None, "", " \n ", "😀" * 50, *("".join(rng.choices(letters + "x \n\v", k=rng.randint(0, 60))) for _ in range(80))]
    table = spark.createDataFrame([*vocabulary.items(), (None, 5), ("", 6), (rng.choice(list(vocabulary)), 9999)], "piece string, id int")
    out = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", tokenizer(table)(F.col("text")).alias("t")).orderBy("i").collect()
    assert [[tuple(x) for x in r["t"]] for r in out] == [plain(t or "", vocabulary) for t in texts]


def test_large_vocabulary_and_limit(spark, monkeypatch):
    rng = random.Random(9)
    words = {"".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(1, 9))) for _ in range(20_000)}
    trie = Trie({w: i for i, w in enumerate(sorted(words), 1)})
    ids, start, end = trie.tokens(np.array([ord(c) for w in sorted(words)[:500] for c in w + " "], dtype=np.int64))
    assert ids.tolist() == list(range(1, 501)) and (end - start).tolist() == [len(w) for w in sorted(words)[:500]]
    monkeypatch.setattr(pieces, "MOST_PIECES", 2)
    with pytest.raises(ValueError):
        tokenizer(spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "piece string, id int"))


def test_reports_of_nothing(spark):
    vocabulary = spark.createDataFrame([("a", 1)], "piece string, id int")
    for rows in ([], [(None,)], [(" ",)]):
        df = spark.createDataFrame(rows, "text string").withColumn("tokens", tokenizer(vocabulary)(F.col("text")))
        r = coverage.token_report(df, "text", "tokens", UNKNOWN).first()
        assert (r["tokens"], r["words"], r["unknown"], r["tokens_per_word"], r["unknown_rate"], r["verdict"]) == (0, 0, 0, 0.0, 0.0, "OK")
