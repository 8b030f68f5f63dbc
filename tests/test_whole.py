"""Cases in which operators once did less than the whole job."""

import datetime as dt
import math
import random

from tideline.operators import features as X


def test_splits_do_not_meet_days_as_a_product(spark):
    rng, day = random.Random(4), dt.date(2020, 1, 1)
    days = [(s, day + dt.timedelta(i), 10.0) for s in (1, 2, 3) for i in range(0, 900, rng.randint(2, 5))]
    days += [days[5], (1, None, 10.0), (None, day, 10.0)]
    splits = [(rng.choice((1, 2, 4)), day + dt.timedelta(rng.randint(-400, 1000)), *rng.choice(((10, 1), (1, 2), (3, 2)))) for _ in range(60)] + [(1, None, 10, 1), (None, day, 10, 1)]
    daily = spark.createDataFrame(days, "symbol long, date date, close double")
    actions = spark.createDataFrame(splits, "symbol int, date date, split_from int, split_to int")
    near = [[x for x in splits if x[0] == s and s is not None and x[1] and d] for s, d, _ in days]

    got = X.split_adjusted(daily, actions)
    rows = sorted(map(tuple, got.select("symbol", "date", "factor", "is_reverse_day", "adj_close").collect()), key=str)
    want = [(s, d, math.prod(a / b for _, e, a, b in own if e > d), any(e == d and a > b for _, e, a, b in own)) for (s, d, _), own in zip(days, near)]
    assert len(rows) == len(want)
    for r, x in zip(rows, sorted(want, key=str)):
        assert r[:2] == x[:2] and math.isclose(r[2], x[2], rel_tol=1e-9) and r[3] == x[3] and math.isclose(r[4], 10 * r[2])

    found = X.corporate_features(daily, actions)
    want = {}
    for (s, d, _), own in zip(days, near):
        back = [((d - e).days, a > b) for _, e, a, b in own]
        want[s, d] = (min((n for n, r in back if r and n >= 0), default=None), sum(0 <= n <= 365 for n, _ in back), any(abs(n) <= 5 for n, _ in back))
    rows = found.collect()
    assert len(rows) == len(want) and {(r[0], r[1]): tuple(r[2:]) for r in rows} == want
    for df in (got, found):
        assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_cascade_keeps_every_row_once(spark):
    """Rows with one key, or without a symbol, are neither multiplied nor thrown out by the global cap's join."""
    from tideline.config import ManifestConfig, SessionLimits
    from tideline.operators import selection as L

    at = dt.datetime(2024, 1, 2, 15, 0)
    rows = [("A", at, "x", 0.9)] * 3 + [("A", at, "x", 0.8)] * 2 + [(None, at, "y", 0.7), (None, at, "y", 0.7), ("B", at, "x", 0.6), ("C", at, "x", None)]
    cols = "symbol string, timestamp timestamp, event_type string, score double, close double, rvol_day double, dollar_volume_bar double, volume double, dollar_volume_day double, spread_proxy double, session string"
    df = spark.createDataFrame([(*r, 10.0, 2.0, 1e9, 1e9, 1e9, 0.01, "RTH") for r in rows], cols)
    low = ManifestConfig(min_score=0.1, limits={"RTH": SessionLimits()}, per_symbol_day=10)
    out = L.cascade(df, low).collect()
    assert len(out) == len(rows) and sum(r.descarte_stage is None for r in out) == 8
    out = L.cascade(df, ManifestConfig(min_score=0.1, limits={"RTH": SessionLimits()}, per_symbol_day=10, max_events=6)).collect()
    assert len(out) == len(rows) and sorted(str(r.descarte_stage) for r in out) == ["None"] * 6 + ["stage1_quality"] + ["stage5_global_cap"] * 2
    assert sum(r.symbol is None and r.descarte_stage is None for r in out) == 1


def test_next_events_take_one_running_pass(spark):
    import time

    from pyspark.sql import functions as F

    rows = spark.range(40_000).select(F.lit("A").alias("symbol"), F.timestamp_seconds(F.col("id") * 60).alias("timestamp"), F.when(F.col("id") % 7 == 0, "b").otherwise("a").alias("event_type"))
    began = time.perf_counter()
    n = X.event_sequences(rows, "a", "b", 3).count()
    assert n == sum(1 for i in range(40_000) if i % 7 and (-i) % 7 <= 3 and i + (-i) % 7 < 40_000)
    assert time.perf_counter() - began < 15


def test_macd_takes_all_closes(spark):
    rng = random.Random(1)
    closes = [rng.uniform(5, 50) for _ in range(700)]
    daily = spark.createDataFrame([("A", dt.date(2020, 1, 1) + dt.timedelta(i), c, 1.0) for i, c in enumerate(closes)], "symbol string, date date, close double, volume double")
    got = [r.macd for r in X.indicators(daily).orderBy("date").collect()]
    fast = slow = closes[0]
    for c, m in zip(closes, got):
        fast, slow = fast + 2 / 13 * (c - fast), slow + 2 / 27 * (c - slow)
        assert math.isclose(m, fast - slow, rel_tol=1e-9, abs_tol=1e-9)
