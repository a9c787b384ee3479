"""Operator 13 against a plain tree."""

import hashlib
import random
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from lambi.llm.merkle import fall, manifest, rise

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, low=False):
    i, text, lang, source, n = row
    if low and text is not None:
        text = "".join(c.lower() if c.isascii() else c for c in text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def tree(digests):
    """Root, and for each leaf the siblings of each level: before and behind."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for k, p in enumerate(at):
            lo = p // 16 * 16
            paths[k].append(("".join(digests[lo:p]), "".join(digests[p + 1 : lo + 16])))
        digests, at = [h(*digests[lo : lo + 16]) for lo in range(0, len(digests), 16)], [p // 16 for p in at]
    return digests[0], paths


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    parts = {s: sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in names}
    trees = {s: tree([leaf(r) for r in parts[s]]) for s in names}
    root, tops = tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for r, path in zip(parts[s], trees[s][1]):
            bad = r[0] is not None and crc32(str(r[0]).encode()) % 5 == 0
            folded = leaf(r, bad)
            for a, b in path + top:
                folded = h(a, folded, b)
            out.append((r[0], leaf(r), trees[s][0], root, h(*(x for p in path + top for x in p)), folded, folded == root))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"tree": F.lit(1), "number": F.lit("x"), "digest": F.lit(None)})
    return sorted((tuple(r) for r in manifest(df, tampered=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).collect()), key=repr)


def test_like_a_plain_tree(spark):
    rng = random.Random(2)
    sources = ["hot"] * 40 + [None, "", "é", "a", "-", "="] + [f"s{i}" for i in range(20)]
    text = lambda: rng.choice([None, "", "é" * rng.randint(0, 9), "Abc" * rng.randint(0, 9), "low"])
    rows = [(i * 3, text(), rng.choice(["en", None]), rng.choice(sources), rng.choice([None, i])) for i in range(900)]
    rows += [(None, "X", "en", "a", 1), (None, "Y", "en", "a", 1), rows[5], rows[5], (9, "Z" * 200_000, None, None, None)]
    got = run(spark, rows)
    assert got == plain(rows) and 0 < sum(not r[6] for r in got) < 300


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 257])
def test_sizes(spark, n):
    rows = [(i, f"T{i}", "en", "s", 2) for i in range(n)]
    assert run(spark, rows) == plain(rows) if n else run(spark, rows) == []


@pytest.mark.parametrize("n, levels", [(1, 0), (1, 2), (16, 1), (17, 2), (255, 2), (256, 2)])
def test_sweeps_of_a_block(n, levels):
    digests = [h(str(i)) for i in range(n)]
    top, got = rise(digests, levels)
    for own, path in zip(digests, fall(n, levels, got, [])):
        assert len(path) == levels
        for a, b in path:
            own = h(a, own, b)
        assert own == top
