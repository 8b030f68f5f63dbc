"""Stateful streams against the batch operators, with rows out of order, over several runs of each query."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tideline.config import IntradayConfig
from tideline.operators.detectors import detected, intraday_events, with_cooldown
from tideline.streaming import ordered, stream

BASE = {"min_bars": 10, "rth_spike": 1.2, "ext_spike": 1.2, "rth_volume": 100, "ext_volume": 100, "rth_dollar_volume": 100, "ext_dollar_volume": 100, "min_range_pct": 0.1, "vwap_up_pct": 2, "vwap_down_pct": 2, "vwap_up_volume": 0.5, "vwap_down_volume": 0.5,
        "momentum_up_pct": 2, "momentum_down_pct": 2, "momentum_volume": 0.5, "base_window": 6, "base_range_multiple": 12.0, "base_break_pct": 1.0, "base_volume": 0.5, "or_volume": 0.5, "or_break_pct": 1.0, "flush_drop_pct": 5.0, "flush_volume": 0.5, "flush_red_bars": 2}
OPTIONS = {"dedup_minutes": 7, "bearish_red_bars": 2, "bearish_drop_pct": 1.0, "vwap_up_bars": 2, "vwap_down_bars": 2, "failed_reclaim_bars": 4, "min_acceleration": 0.5, "flush_window": 15, "tape_transactions": 3, "tape_spike": 1.1, "full_score": True}


@pytest.fixture(scope="module")
def bars(spark, tmp_path_factory):
    rng = random.Random(3)
    rows = []
    for symbol, per_day in (("A", 90), ("B", 40), ("few", 9), ("C", 60)):
        for day in (8, 9, 10):
            t, price = datetime(2025, 1, day, rng.choice((9, 14)), 30), 10.0
            for _ in range(per_day):
                o = price
                price = max(0.5, price * (1 + rng.gauss(0, 0.015)))
                v = rng.choice((0, 100, 300, 500, 900, 5000))
                bar = [symbol, t, t.date(), o, max(o, price) * 1.01, min(o, price) * 0.99, price, v, rng.randint(0, 30)]
                if rng.random() < 0.03:
                    bar[rng.choice((3, 4, 5, 6, 7))] = None
                rows.append(tuple(bar))
                t += timedelta(minutes=rng.choice((1, 1, 1, 2, 30)))
    path = str(tmp_path_factory.mktemp("bars"))
    spark.createDataFrame(rows, "symbol string, timestamp timestamp, date date, open double, high double, low double, close double, volume bigint, transactions bigint").write.mode("append").parquet(path)
    return spark.read.parquet(path)


def shown(df):
    cols = ("symbol", "timestamp", "event_type", "direction", "session", "event_bias", "close_vs_open", "volume")
    return sorted((*(str(r[c]) for c in cols), None if r.spike_x is None else round(r.spike_x, 6), round(r.score, 6)) for r in df.collect())


@pytest.mark.parametrize("options", [{}, OPTIONS])
def test_live_events_equal_batch(bars, options):
    cfg = IntradayConfig(**(BASE | options))
    want = shown(intraday_events(bars, cfg))
    assert len({x[2] for x in want}) >= 5 and not any(x[0] == "few" for x in want)
    got = stream.replayed(bars, lambda s: ordered.live_events(s, cfg, "20 minutes"), 1200, slices=3)
    assert shown(got) == want


def test_hits_come_with_their_bars(bars):
    cfg = IntradayConfig(**BASE)
    want = sorted((r.symbol, r.timestamp, r.event_type, r.direction, round(r.score, 6)) for r in detected(bars, cfg).collect())
    got = stream.replayed(bars, lambda s: ordered.live_events(s, cfg, "20 minutes", best=False), 1200, slices=2)
    assert sorted((r.symbol, r.timestamp, r.event_type, r.direction, round(r.score, 6)) for r in got.collect()) == want


def test_every_rule_bar_by_bar(bars):
    """Without a bucket and a minimum of bars, the processor alone gives what the rules give in one pass."""
    cfg = IntradayConfig(**(BASE | OPTIONS | {"min_bars": 1, "dedup_minutes": 1}))
    rows = bars.withColumn("us", F.unix_micros("timestamp")).orderBy("symbol", "timestamp").collect()
    from tideline.functions.time import market_time, minute_of_day, session_of

    clock = market_time(F.col("timestamp"))
    keyed = bars.select("symbol", F.unix_millis("timestamp").alias("ms"), F.unix_micros("timestamp").alias("us"), F.unix_date("date").alias("day"), session_of(clock, "CLOSED").alias("session"), minute_of_day(clock).cast("int").alias("minute"), "open", "high", "low", "close", F.col("volume").cast("double"), F.col("transactions").cast("double")).collect()
    live, found = ordered.LiveDetectors(cfg), []
    for symbol in ("A", "B", "few", "C"):
        state = {}
        own = sorted(tuple(r)[1:] for r in keyed if r.symbol == symbol)
        for k in range(0, len(own), 7):  # state goes on between calls
            found += [(symbol, *x) for x in live.step(state, own[k : k + 7], own[min(k + 6, len(own) - 1)][0])]
            state.pop("wake", None)
        assert len(state["bars"]) <= live.depth
        found += [(symbol, *x) for x in live.step(state, [], own[-1][0] + 10**9)]
        assert state == {}
    assert len(rows) == len(keyed)
    want = intraday_events(bars, cfg)
    assert sorted((x[0], x[1], x[3], x[4], round(x[-1], 6)) for x in found) == sorted((r.symbol, r.us, r.event_type, r.direction, round(r.score, 6)) for r in want.withColumn("us", F.unix_micros("timestamp")).collect())


def test_cooldown_out_of_order(spark):
    t0 = datetime(2025, 1, 10, 20, 0)
    rows = [("AB"[i % 2], ("x", "y", "z")[i % 3], t0 + timedelta(seconds=170 * (i // 3), microseconds=i % 7)) for i in range(1500)]
    events = spark.createDataFrame(rows, "symbol string, event_type string, timestamp timestamp")
    want = with_cooldown(events.withColumn("date", F.to_date("timestamp")), 17).select("symbol", "event_type", "timestamp")
    got = stream.replayed(events, lambda s: ordered.cooldown(s, 17, "2 hours"), 7200, slices=3)
    rows = sorted(map(tuple, want.collect()))
    assert len({r[2].date() for r in rows}) == 2 and sorted(map(tuple, got.collect())) == rows


def test_cooldown_state():
    """An event older than the last accepted one, in a later batch, is judged in its place; what is over is forgotten."""
    step = ordered.Cooldown(1800).step
    at = lambda h, m: (h * 60 + m) * 60
    row = lambda s: (s * 1000, s, 0, s * 10**6)
    state = {}
    assert step(state, [row(at(14, 5)), row(at(14, 30))], at(14, 30) * 1000) == [(at(14, 5) * 10**6,)]
    state.pop("wake")
    assert step(state, [row(at(15, 40))], at(15, 40) * 1000) == [(at(15, 40) * 10**6,)]
    assert state.pop("wake") == ordered.DAY_END_MS
    assert step(state, [], ordered.DAY_END_MS) == [] and state == {}


def test_options_that_need_the_whole_day_are_refused():
    with pytest.raises(ValueError, match="cooldown"):
        ordered.LiveDetectors(IntradayConfig(max_per_symbol_day=3))
