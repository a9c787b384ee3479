"""Operator 11 against brute force."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lambi.llm.spelling import near_pairs, spelling_variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(docs, min_length=7):
    found = Counter()
    for i, text in docs:
        run = ""
        for c in (text or "") + "\0":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                found[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
                run = ""
    n = {w: k for w, k in found.items() if len(w) >= min_length and k >= 2}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def rows(spark, docs, **options):
    return [tuple(r) for r in spelling_variants(spark.createDataFrame(docs, "doc_id long, text string"), **options).collect()]


def test_like_brute_force(spark):
    rng = random.Random(5)
    letters = "abcdéÀ÷"
    base = ["".join(rng.choices(letters, k=rng.randint(6, 11))) for _ in range(25)]

    def spoiled(w):
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2, 3])):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]])
        return w

    docs = [(i, " ".join(rng.choice([str.upper, str])(spoiled(rng.choice(base))) + rng.choice(["", ",", "9", "ğ"]) for _ in range(90))) for i in range(60)]
    docs += [(None, f"{base[0]} {base[1]}"), (3, None), (4, ""), docs[7], docs[7]]
    want = plain(docs)
    got = rows(spark, docs)
    assert len(got) == len(want) and set(got) == want


def test_forms_lead_on(spark):
    docs = [(i, "w " + "abcdefgh " * 200 + "abcdefxh " * 20 + "abcdeyxh " * 2) for i in range(1)]
    got = {r[0]: r[1:] for r in rows(spark, docs, noise=None)}
    assert got == {
        "abcdefgh": (None, "abcdefgh", 200, 1, None), "abcdefxh": ("abcdefgh", "abcdefgh", 20, 2, 200), "abcdeyxh": ("abcdefxh", "abcdefgh", 2, 1, 20),
    }
    chain = ["aaaaaaa" + "b" * k for k in range(6)]
    counts = [2 * 10**k for k in range(5)] + [2 * 10**4]
    got = {r[0]: r[2] for r in rows(spark, [(1, " ".join(f"{w} " * n for w, n in zip(chain, counts)))], noise=None)}
    assert [got[w] for w in chain] == [chain[4]] * 5 + [chain[5]]


@pytest.mark.parametrize("length", [4, 7, 12, 70])
def test_all_edits_share_a_key(spark, length):
    word = ("abcdefghijkl" * 6)[:length]
    edits = {word[:i] + c + word[i + d :] for i in range(length + 1) for c in ("", "a", "z", word[i - 1]) for d in (0, 1)} - {word}
    words = spark.createDataFrame([(w, 2) for w in edits | {word}], "word string, n long").where(F.length("word") >= 4)
    got = {frozenset(r) for r in near_pairs(words).where((F.col("x") == word) | (F.col("y") == word)).select("x", "y").collect()}
    assert got == {frozenset((word, w)) for w in edits if one_edit(w, word) and len(w) >= 4}


def test_small_and_odd_tables(spark):
    assert rows(spark, [(1, None), (None, None), (2, "")]) == []
    long = "q" * 100_000
    got = rows(spark, [(1, f"{long} {long} {long}x {long}x")], noise=None)
    assert sorted((len(r[0]), r[1], r[4]) for r in got) == [(100_000, None, 1), (100_001, None, 1)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants(empty).count() == 0
    clash = spark.createDataFrame([(1, "letters letters", "w", 5, "k")], "doc_id long, text string, word string, n int, key string")
    assert [tuple(r) for r in spelling_variants(clash, noise=None).collect()] == [("letters", None, "letters", 2, 0, None)]
