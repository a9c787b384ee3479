"""Distributed quantiles against numpy and Spark's own percentile."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lambi.operators import quantiles as qs


def test_bits_keep_the_order(spark):
    rng = np.random.default_rng(1)
    odd = [0.0, 5e-324, 2.2e-308, 2.3e-308, 1.0, math.nextafter(1, 2), math.nextafter(2, 1), 2.0, 1e308, 1.7976931348623157e308, math.inf, 0.1, 1 / 3, 4.0, 8.0, math.nextafter(8, 0)]
    xs = sorted({*odd, *(-x for x in odd), *rng.normal(0, 1, 300), *(10.0 ** rng.uniform(-300, 300, 300))})
    df = spark.createDataFrame([(float(x),) for x in [*xs, math.nan]], "x double")
    got = [(r["x"], r["b"]) for r in df.select("x", qs.ordered_bits(F.col("x")).alias("b")).collect()]
    codes = [b for _, b in got]
    assert codes == sorted(set(codes))
    assert all(b == np.float64(x).view(np.int64) for x, b in got if x >= 0 and not math.isnan(x))


@pytest.mark.parametrize("gather", [0, 4096])
@pytest.mark.parametrize("q", [0.5, 0.9, 0.0])
def test_like_percentile(spark, monkeypatch, gather, q):
    monkeypatch.setattr(qs, "GATHER", gather)
    rng = np.random.default_rng(2)
    hot = [("hot", None, float(x), int(i % 7)) for i, x in enumerate(rng.normal(3, 1e-9, 4000))]  # distinct, nearly all rows
    rest = [(g, int(rng.integers(0, 2)), None if rng.random() < 0.1 else float(rng.choice([1e-9, 0.5, -2.0, rng.random()])), int(rng.integers(0, 3))) for g in ["a", "b", None] for _ in range(40)]
    df = spark.createDataFrame([*hot, *rest, ("nulls", 1, None, 4), ("one", 1, 2.5, 4)], "g string, h int, x double, y int")
    want = df.groupBy("g", "h").agg(F.percentile("x", q).alias("x"), F.percentile("y", q).alias("y")).collect()
    out = qs.quantiles(df, ["g", "h"], ["x", "y"], q)
    key = lambda r: (r["g"] or "", -1 if r["h"] is None else r["h"])
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, want), key=repr) and len({key(r) for r in want}) == len(want)
    plan = out._jdf.queryExecution().toString()
    assert "percentile" not in plan and "median" not in plan


def test_empty(spark):
    assert qs.quantiles(spark.createDataFrame([], "g string, x double"), ["g"], ["x"]).collect() == []
