import hashlib
import random

import numpy as np
import pytest

from lambi.llm import substrings
from lambi.llm.substrings import equal_strings, remove_repeats


def brute(rows, length):
    """Positions covered by a string that also starts earlier, from all strings of all texts."""
    first = {}
    for i, text in rows:
        body = (text or "").encode()
        for s in range(len(body) - length + 1):
            at = first.setdefault(body[s : s + length], (i, s))
            if (i, s) < at:
                first[body[s : s + length]] = (i, s)
    out = {}
    for i, text in rows:
        body = (text or "").encode()
        gone = bytearray(len(body))
        for s in range(len(body) - length + 1):
            if first[body[s : s + length]] < (i, s):
                gone[s : s + length] = b"\1" * length
        spans = sum(1 for k in range(len(body)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(c for c, g in zip(body, gone) if not g)
        out[i] = (len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randint(20, 60))) for _ in range(6)]
    line = "the very common line that a third of all documents hold, one hundred and thirty bytes long or so, to be exact about it all."
    rows = []
    for i in range(120):
        parts = [" ".join(word() for _ in range(rng.randint(0, 50))) for _ in range(3)]
        if i % 3 == 0:
            parts.insert(1, line)
        if i % 5 == 0:
            parts.insert(2, rng.choice(passages))
        rows.append((i, "\n".join(parts)))
    rows += [(200 + i, rows[3][1]) for i in range(10)]
    rows += [(300, None), (301, ""), (302, "ab" * 400), (303, "x" * 1000), (304, "y" * 99), (305, "y" * 100)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("together", [256, 3])
def test_equals_brute_force(spark, monkeypatch, together):
    """Also with keys that are split because many stretches share them."""
    monkeypatch.setattr(substrings, "TOGETHER", together)
    rows = texts(together)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r[1:]) for r in remove_repeats(df).collect()}
    assert got == brute(rows, 100)


def test_text_that_remains_and_clashing_columns(spark):
    a = "".join(chr(97 + i % 23) for i in range(150))
    df = spark.createDataFrame([(1, a, 5, "k"), (2, "head " + a, 6, "k"), (None, None, 7, None)], "doc_id long, text string, start int, key string")
    got = {r["doc_id"]: (r["n_removed"], r["text"]) for r in remove_repeats(df, with_text=True).collect()}
    assert got[1][0] == 150 - 23 and got[2] == (150, "head ") and got[None] == (0, None)


def test_empty_and_repeated_rows(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    body = "".join(random.Random(1).choices("abcdef", k=400))
    got = remove_repeats(spark.createDataFrame([(1, body), (1, body), (2, body)], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(1, 0), (1, 0), (2, 400)]


def test_intervals_find_equal_strings():
    rng = np.random.default_rng(3)
    for length in (5, 12):
        pieces = [rng.integers(97, 99, rng.integers(1, 60)).astype(np.uint8).tobytes() for _ in range(30)]
        data = b"\xff".join(pieces) + b"\xff"
        order, cut = equal_strings(np.frombuffer(data, np.uint8), 0xFF, length)
        group = np.cumsum(cut)
        seen = {}
        for p, g in zip(order.tolist(), group.tolist()):
            w = data[p : p + length]
            if len(w) == length and b"\xff" not in w:
                assert seen.setdefault(w, g) == g
        assert len(set(seen.values())) == len(seen)


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    """No row loses bytes that repeat nothing: null ids first, then ids with several texts."""
    rng = random.Random(2)
    piece = lambda n: "".join(rng.choices("abcdefgh", k=n))
    a, b = piece(300), piece(300)
    rows = [(None, piece(50) + a), (None, piece(60) + a), (None, piece(400)), (5, b + piece(200)), (5, piece(120) + b), (5, piece(150)), (6, a), (7, b), (None, None), (None, None), (5, ""), (5, "")]
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()), key=str)
    assert len(got) == len(rows)
    removed = lambda i, n: next(x[2] for x in got if x[:2] == (i, n))
    assert {removed(None, 350), removed(None, 360)} == {0, 300} and removed(None, 400) == 0
    assert {removed(5, 500), removed(5, 420)} == {0, 300} and removed(5, 150) == 0
    assert removed(6, 300) == 300 and removed(7, 300) == 300
