"""Running numbers and sums against a plain loop."""

import random

import pytest

from lambi.operators.running import running


def plain(rows, group, order, value):
    out, seen = [], {}
    for r in sorted(rows, key=lambda r: tuple((r[c] is not None, r[c]) for c in (*group, *order))):
        at, total = seen.get(tuple(r[c] for c in group), (0, 0))
        out.append((*r.values(), at, total))
        seen[tuple(r[c] for c in group)] = (at + 1, total + (r[value] or 0))
    return sorted(out, key=repr), {k: n for k, (n, _) in seen.items()}


@pytest.mark.parametrize("group", [(), ("g",)])
def test_like_a_loop(spark, group):
    rng = random.Random(3)
    rows = [{"g": rng.choice(["a", "a", "a", "b", None, ""]), "k": i if i % 9 else None, "v": rng.choice([None, 1, 5])} for i in range(200)]
    rows = [r for r in rows if r["k"] is not None] + [{"g": "b", "k": None, "v": 2}]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "g string, k int, v long").repartition(7)
    got = running(df, ["k"], group, "v").collect()
    want, sizes = plain(rows, group, ["k"], "v")
    assert sorted(((r["g"], r["k"], r["v"], r["number"], r["before"]) for r in got), key=repr) == want
    assert all(r["size"] == sizes[tuple(r[c] for c in group)] for r in got)


def test_ties_and_empty(spark):
    got = running(spark.createDataFrame([("x", 1)] * 5, "g string, k int"), ["k"], ["g"])
    assert got.columns == ["g", "k", "size", "number"] and sorted(r["number"] for r in got.collect()) == list(range(5))
    assert running(spark.createDataFrame([], "g string, k int"), ["k"]).count() == 0
