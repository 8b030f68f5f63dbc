"""The pattern index against the exact search; patterns and outcomes against plain arithmetic."""

import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tideline.operators import patterns as P
from tideline.operators.features import similar_vectors


@pytest.fixture(scope="module")
def vectors(spark, tmp_path_factory):
    """Clusters of several widths, copies, a label with a hot bucket, and vectors that have no direction or no label."""
    rng = random.Random(4)
    rows = []
    for label, clusters, size, width in ((0, 40, 25, 0.2), (1, 5, 160, 0.4), (2, 1, 900, 0.02), (3, 12, 1, 1.0)):
        for _ in range(clusters):
            centre = [rng.gauss(0, 1) for _ in range(16)]
            rows += [(label, [c + rng.gauss(0, width) for c in centre]) for _ in range(size)]
    rows += [(0, rows[7][1])] * 60 + [(1, [2 * x for x in rows[1500][1]]), (0, [0.0] * 16), (0, None), (0, [math.nan] * 16), (1, [1.0, None] + [0.0] * 14), (None, rows[3][1]), (0, [1.0, 2.0])]
    path = str(tmp_path_factory.mktemp("vectors"))
    spark.createDataFrame([(i, label, v) for i, (label, v) in enumerate(rows)], "vec_id long, label int, embedding array<double>").repartition(3).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def asked(vectors):
    return vectors.where("vec_id % 10 = 0").withColumnRenamed("vec_id", "query_id")


def exact(vectors, k):
    one = P.usable(vectors).where("size(v) = 16").withColumnRenamed("v", "embedding")
    return similar_vectors(one, asked(one), k)


@pytest.mark.parametrize(("bucket", "split"), [(128, 4096), (16, 10)])
def test_recall(spark, vectors, monkeypatch, bucket, split):
    monkeypatch.setattr(P, "SPLIT", split)
    index = P.fit_index(vectors, k=10, bucket=bucket)
    found = P.search(index, asked(vectors), k=10)
    rows = found.collect()
    want = exact(vectors, 10)
    assert P.recall(found, want).first().recall >= 0.9
    true = {(r.query_id, r.vec_id): r.cosine for r in exact(vectors, 5000).collect()}
    assert all(abs(true[r.query_id, r.vec_id] - r.cosine) < 1e-9 for r in rows if (r.query_id, r.vec_id) in true)
    by_query = {}
    for r in rows:
        by_query.setdefault(r.query_id, []).append(r)
    assert all(sorted(x.rank for x in v) == [*range(1, len(v) + 1)] and len(v) <= 10 for v in by_query.values())
    if split == 10:
        assert index.sizes.agg(F.max("salts")).first()[0] > 1
        n, pairs = vectors.where("label = 0").count(), index.codes.where("label = 0").groupBy("part", "code").count().agg(F.max("count")).first()[0]
        assert pairs < n / 3  # buckets are a share of the label
    copies = [r for r in rows if r.query_id in range(2720, 2772, 10) and r["rank"] == 1]
    assert len(copies) == 6 and all(abs(r.cosine - 1) < 1e-12 for r in copies)


def test_copies_do_not_multiply(spark):
    rows = [(i, "x", [1.0, 2.0, 3.0]) for i in range(3000)] + [(9000 + i, "x", [1.0, 2.0, 3.0 + i]) for i in range(1, 4)]
    v = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    index = P.fit_index(v, k=5)
    assert index.classes.count() == 4 and index.members.count() == 6 + 3
    got = {(r.query_id, r["rank"]): r.vec_id for r in P.search(index, asked(v), k=5).collect()}
    assert [got[0, i] for i in range(1, 6)] == [1, 2, 3, 4, 5] and [got[2990, i] for i in range(1, 6)] == [0, 1, 2, 3, 4]


def test_nothing_to_search(spark, vectors):
    none = vectors.where("vec_id < 0")
    assert P.search(P.fit_index(none), asked(none)).collect() == []
    assert P.search(P.fit_index(vectors), asked(none)).collect() == []


def test_patterns_and_outcomes(spark):
    rng, rows = random.Random(1), []
    for s in ("A", "B"):
        for i in range(40):
            o, c = rng.uniform(5, 9), rng.uniform(5, 9)
            rows.append((s, date(2025, 1, 1) + timedelta(days=i), o, max(o, c) + 1, min(o, c) - 1, c, 0 if (s, i) == ("B", 30) else rng.randint(1, 99)))
    out = P.price_patterns(spark.createDataFrame(rows, "symbol string, date date, open double, high double, low double, close double, volume bigint")).collect()
    by = {s: [r for r in rows if r[0] == s] for s in "AB"}
    for r in out:
        own = by[r.symbol]
        i = (r.date - date(2025, 1, 1)).days
        want = []
        for j in range(i - 4, i + 1):
            if j < 20 or own[j][6] == 0:
                want = None
                break
            d = own[j]
            want += [math.log(d[2] / own[j - 1][5]), math.log(d[3] / d[4]), math.log(d[5] / d[2]), math.log(d[6] / (sum(x[6] for x in own[j - 20 : j]) / 20))]
        assert (r.v is None) == (want is None) and (want is None or all(abs(a - b) < 1e-9 for a, b in zip(r.v, want)))
        assert r.outcome is None if i > 34 else abs(r.outcome - (own[i + 5][5] / own[i][5] - 1)) < 1e-12
    found = spark.createDataFrame([(1, 10, 0.9), (1, 11, 0.5), (1, 12, 0.8), (1, 13, 0.7), (2, 10, 0.2), (2, 99, 0.9)], "query_id long, vec_id long, cosine double")
    after = spark.createDataFrame([(10, 0.1), (11, -0.2), (12, 0.005), (13, None)], "vec_id long, outcome double")
    got = {r.query_id: r for r in P.pattern_outcomes(found, after).collect()}
    a = got[1]
    assert (a.n_similar, a.n_known) == (4, 3) and [round(x, 9) for x in (a.bullish, a.neutral, a.bearish)] == [round(1 / 3, 9)] * 3
    assert (a.mean_bullish, a.mean_bearish) == (0.1, -0.2) and abs(a.weighted_outcome - (0.09 - 0.1 + 0.004) / 2.2) < 1e-12
    assert (got[2].n_similar, got[2].n_known, got[2].bullish) == (2, 1, 1.0) and P.pattern_outcomes(found, after, least=0.95).count() == 0


def test_search_moves_no_pairs(spark, vectors):
    index, store = P.fit_index(vectors, k=10), spark.sparkContext._jsc.sc().statusStore()
    written = lambda: store.executorList(False).apply(0).totalShuffleWrite()
    vectors.groupBy("vec_id").count().collect()
    before = written()
    assert len(P.search(index, asked(vectors), k=10).collect()) > 2000
    assert written() - before < 2_000_000


@pytest.mark.parametrize(("block", "pairs", "dense"), [(65_536, 2_000_000, 2000), (50, 300, 20), (65_536, 2_000_000, 10**9)])
def test_nearest_is_the_search_without_an_index(spark, vectors, monkeypatch, block, pairs, dense):
    monkeypatch.setattr(P, "DENSE", dense)
    monkeypatch.setattr(P, "ASKED", block)
    monkeypatch.setattr(P, "PAIRS", pairs)
    v = vectors.withColumn("outcome", F.col("vec_id") * 0.5)
    want = {(r.query_id, r["rank"]): (r.vec_id, r.cosine) for r in P.search(P.fit_index(vectors, k=5), asked(vectors), k=5).collect()}
    for sample in (None, v.where("vec_id % 4 = 0").coalesce(1)):
        got = P.nearest(v, asked(vectors), k=5, sample=sample).collect()
        same = [want.get((r.query_id, r["rank"])) == (r.vec_id, r.cosine) for r in got]
        assert len(got) > 1000 and sum(same) > 0.98 * len(got)  # copies are counted apart, so labels with many have a bit more
        assert all(r.outcome == r.vec_id * 0.5 for r in got)


def test_exact_search_leaves_nothing_out(spark, vectors):
    """Points that lie anywhere: their neighbours share few signs, so buckets alone miss many."""
    rng = random.Random(9)
    rows = [(i, i % 2, [rng.gauss(0, 1) for _ in range(48)]) for i in range(3000)]
    far = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    for table, k in ((far, 10), (vectors.where("embedding is null or size(embedding) = 16"), 7)):
        found = P.search(P.fit_index(table, k=k, bucket=32), asked(table), k=k, exact=True)
        usable = P.usable(table).withColumnRenamed("v", "embedding")
        want = {(r.query_id, r["rank"]): r.vec_id for r in similar_vectors(usable, asked(usable), k).collect()}
        assert {(r.query_id, r["rank"]): r.vec_id for r in found.collect()} == want
