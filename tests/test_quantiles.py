"""Exact quantiles against Spark's own percentile, whatever the values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tideline.functions import quantiles

QS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0)


def columns():
    rng = random.Random(8)
    n = 6000
    yield "normal", [rng.gauss(0, 1) for _ in range(n)]
    yield "tails", [rng.choice((-1, 1)) * 10 ** rng.uniform(-300, 300) for _ in range(n)]
    yield "ties", [float(rng.randint(0, 3)) for _ in range(n)]
    yield "close", [1.0 + i * 2**-52 for i in range(n)]
    yield "odd", [rng.choice((math.nan, math.inf, -math.inf, 0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, None, 3.0)) for _ in range(n)]
    yield "some", [rng.random() if i % 10 == 0 else None for i in range(n)]
    yield "one", [7.5 if i == 11 else None for i in range(n)]
    yield "none", [None] * n


@pytest.mark.parametrize("limits", [(4096, 4096), (8, 3), (2, 1)])
def test_equal_percentile(spark, monkeypatch, limits):
    monkeypatch.setattr(quantiles, "BINS", limits[0])
    monkeypatch.setattr(quantiles, "FEW", limits[1])
    names, cols = zip(*[c for c in columns() if limits[1] > 1 or c[0] in ("normal", "ties", "close", "odd")])
    df = spark.createDataFrame(list(zip(*cols)), ", ".join(f"{n} double" for n in names)).repartition(5)
    got = quantiles.exact_quantiles(df, {n: QS for n in names})
    want = df.agg(*[F.percentile(n, F.array(*map(F.lit, QS))).alias(n) for n in names]).first()
    for n in names:
        for i, q in enumerate(QS):
            a, b = got[n, q], want[n][i] if want[n] is not None else None
            assert a == b or (a is not None and b is not None and (math.isnan(a) and math.isnan(b) or math.isclose(a, b, rel_tol=1e-15))), (n, q, a, b)


def test_integers_names_and_no_rows(spark):
    df = spark.range(1001).select((F.col("id") * 3).alias("a.b"), F.col("id").cast("int").alias("c"))
    assert quantiles.exact_quantiles(df, {"a.b": (0.5, 0.9995), "c": (0.25,)}) == {("a.b", 0.5): 1500.0, ("a.b", 0.9995): pytest.approx(2998.5), ("c", 0.25): 250.0}
    assert quantiles.exact_quantiles(df.where("c < 0"), {"c": (0.5,)}) == {("c", 0.5): None}
