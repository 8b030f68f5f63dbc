"""Hand-made frames: the edges of the operators that whole tables don't show."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tideline.config import IntradayConfig, ManifestConfig, SessionLimits
from tideline.functions import scalars, time
from tideline.operators import aggregates, detectors, features, halts, joins, quality, rolling, selection
from tideline.sources import bars as B

BAR = "symbol string, timestamp timestamp, date date, open double, high double, low double, close double, volume bigint, vwap double"


def minutes(n, start=datetime(2025, 1, 10, 15, 0), symbol="A", **change):
    out = []
    for i in range(n):
        t = start + timedelta(minutes=i)
        row = dict(symbol=symbol, timestamp=t, date=t.date(), open=10.0, high=10.1, low=9.9, close=10.0, volume=1000, vwap=10.0)
        for k, f in change.items():
            row[k] = f(i)
        out.append(tuple(row.values()))
    return out


def test_sessions_and_daylight_saving(spark):
    times = [datetime(2025, 1, 10, 13, 0), datetime(2025, 1, 10, 14, 30), datetime(2025, 1, 10, 20, 59, 30), datetime(2025, 1, 10, 21, 0), datetime(2025, 1, 10, 21, 30), datetime(2025, 1, 11, 8, 59), datetime(2025, 3, 7, 13, 45), datetime(2025, 3, 10, 13, 45)]
    df = spark.createDataFrame([(t,) for t in times], "timestamp timestamp")
    out = [r.session for r in time.with_market_time(df).collect()]
    assert out == ["premarket", "rth", "rth", "postmarket", "postmarket", "closed", "premarket", "rth"]
    kept = time.recalculated_sessions(df)
    assert kept.count() == 7 and time.recalculated_sessions(df, compat=True).where("session = 'RTH'").count() == 4


def test_zero_volume_and_zero_prices(spark):
    df = spark.createDataFrame(minutes(40, volume=lambda i: 0, open=lambda i: 0.0), BAR)
    out = detectors.intraday_columns(df, IntradayConfig(min_bars=30))
    assert out.where("spike_x is not null or range_pct is not null").count() == 0
    assert detectors.intraday_events(df, IntradayConfig()).count() == 0


def test_minimum_bars(spark):
    df = spark.createDataFrame(minutes(29) + minutes(30, symbol="B"), BAR)
    assert {r.symbol for r in detectors.intraday_columns(df).select("symbol").distinct().collect()} == {"B"}


def test_halt_window(spark):
    flat = lambda i: 30 <= i < 35
    rows = minutes(60, open=lambda i: 10.0, high=lambda i: 10.0 if flat(i) else 10.1, low=lambda i: 10.0 if flat(i) else 9.9, volume=lambda i: 0 if flat(i) else 100_000)
    out = halts.detect_halts(spark.createDataFrame(rows, BAR)).orderBy("timestamp").collect()
    assert [i for i, r in enumerate(out) if r.halt_flat] == [30, 31, 32, 33, 34]
    assert [i for i, r in enumerate(out) if r.halt_sequence] == [32, 33, 34]
    assert [i for i, r in enumerate(out) if r.in_halt_window] == list(range(15, 49))


def test_official_halts_overlap_and_stay_open(spark):
    df = spark.createDataFrame(minutes(180), BAR)
    t = datetime(2025, 1, 10, 15, 0)
    spans = [("A", t + timedelta(minutes=5), t + timedelta(minutes=10)), ("A", t + timedelta(minutes=8), t + timedelta(minutes=12)), ("A", t + timedelta(minutes=60), None), ("B", t, t)]
    out = halts.with_official_halts(df, spark.createDataFrame(spans, "symbol string, halt_timestamp timestamp, resume_timestamp timestamp"))
    assert out.count() == 180
    assert [r.timestamp.minute + 60 * (r.timestamp.hour - 15) for r in out.where("halt_official").orderBy("timestamp").collect()] == [*range(5, 13), *range(60, 121)]


def test_official_halt_text(spark):
    lines = ["Date|Time|Symbol|Name|Market|Reason|Pause|ResDate|ResTime", "01/10/2025|09:45:00| abc |Abc Inc|NASDAQ|luld|3.5|01/10/2025|09:50:00", "01/10/2025|10:00:00|xyz|X|NYSE|T1|||", "Rows: 2"]
    out = B.official_halts(spark.createDataFrame([(x,) for x in lines], "value string")).orderBy("symbol").collect()
    assert [(r.symbol, r.reason_code, r.halt_duration_minutes, r.pause_threshold_price) for r in out] == [("ABC", "LULD", 5.0, 3.5), ("XYZ", "T1", None, None)]


def test_ssr_trigger_and_next_day(spark):
    day = lambda d, f: minutes(60, datetime(2025, 1, d, 14, 30), close=f)
    df = spark.createDataFrame(day(9, lambda i: 150.0) + day(10, lambda i: 150 - 0.5 * i) + day(13, lambda i: 130.0) + day(14, lambda i: 130.0), BAR)
    out = halts.ssr_intraday(df).orderBy("timestamp").collect()
    assert next(i for i, r in enumerate(out) if r.ssr_trigger) == 60 + 30
    assert [r.ssr_active for r in out].index(True) == 90 and all(r.ssr_active for r in out[90:180]) and not any(r.ssr_active for r in out[180:])


def test_nearest_quantile_and_min_periods(spark):
    df = spark.createDataFrame([("A", date(2025, 1, i), float(i)) for i in range(1, 11)], "symbol string, date date, x double")
    out = df.select(rolling.nearest_quantile("x", rolling.last_rows(rolling.by_daily(), 10), 0.95).alias("q"), rolling.mean_at_least("x", rolling.last_rows(rolling.by_daily(), 5), 3).alias("m")).collect()
    assert out[-1].q == 10.0 and [r.m for r in out[:3]] == [None, None, 2.0]


def test_dedup_keeps_the_best(spark):
    t = datetime(2025, 1, 1)
    rows = [("A", t, "x", 1.0, None, "up"), ("A", t, "x", 1.0, 2.0, "down"), ("A", t, "y", None, None, "up"), ("A", t, "y", None, 1.0, "down")] + [("B", t, "x", float(i), 0.0, "up") for i in range(12)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp, event_type string, score double, spike_x double, direction string")
    once = selection.exact_dedup(df)
    assert {(r.symbol, r.event_type): (r.score, r.spike_x) for r in once.collect()} == {("A", "x"): (1.0, 2.0), ("A", "y"): (None, 1.0), ("B", "x"): (11.0, 0.0)}
    assert sorted(map(str, selection.exact_dedup(once).collect())) == sorted(map(str, once.collect()))
    assert selection.dedup_stats(df, once).first().residual == 0


def test_average_rank(spark):
    rows = [("x", "RTH", s) for s in (1.0, 2.0, 2.0, 5.0, 5.0, None)] + [("y", "PM", 3.0)]
    out = rolling.average_rank_cdf(spark.createDataFrame(rows, "event_type string, session string, score double")).collect()
    got = {(r.event_type, r.score_raw): round(r.score, 6) for r in out}
    assert len(out) == 6 and got == {("x", 1.0): 0.0, ("x", 2.0): round(1.5 / 3.5, 6), ("x", 5.0): 1.0, ("y", 3.0): 0.5}


def test_cascade_conserves_rows(spark):
    rows, t = [], datetime(2025, 1, 6, 15, 0)
    for i in range(400):
        rows.append((f"S{i % 5}", t + timedelta(minutes=7 * i), "x", ("RTH", "PM", "CLOSED")[i % 3], (i % 10) / 10 if i % 17 else None, 10.0, 10.5, 9.9, 10.2, 1_000_000, 1e7 if i % 13 else None, 2.0 if i % 4 else None, 1e7, 0.02 if i % 7 else None))
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp, event_type string, session string, score double, open double, high double, low double, close double, volume bigint, dollar_volume_day double, rvol_day double, dollar_volume_bar double, spread_proxy double")
    cfg = ManifestConfig(limits={"RTH": SessionLimits(), "PM": SessionLimits()}, per_symbol_month=8, per_symbol_day=2, per_symbol=7, max_events=12)
    out = selection.cascade(df, cfg)
    kept, gone = selection.kept_and_discarded(out)
    assert kept.count() + gone.count() == 400 and kept.count() == 12
    assert gone.where("descarte_reason is null").count() == 0
    assert kept.groupBy("symbol", "date_only").count().agg(F.max("count")).first()[0] <= 2 and kept.groupBy("symbol").count().agg(F.max("count")).first()[0] <= 7
    reasons = {r.reason for r in selection.attribution(out).collect()}
    assert {"low_score", "unknown_session", "null_metric", "global_cap", ""} <= reasons
    assert selection.sanity_checks(kept, cfg).count() == 10


def test_downsampling_is_even(spark):
    for n, m in ((5, 5), (5, 6), (5, 50), (7, 30), (1, 9)):
        df = spark.createDataFrame([("A", datetime(2025, 1, 1) + timedelta(seconds=i), i) for i in range(m)], "symbol string, timestamp timestamp, i int")
        assert [r.i for r in rolling.downsampled(df, F.lit(n)).orderBy("i").collect()] == [int(k * m / n) for k in range(min(n, m))]


def test_as_of(spark):
    t = datetime(2025, 1, 1)
    trades = spark.createDataFrame([("A", t, 1, 5.0), ("A", t + timedelta(seconds=2), 2, 6.0), ("B", t, 3, 1.0)], "symbol string, timestamp timestamp, event_id int, price double")
    quotes = spark.createDataFrame([("A", t + timedelta(seconds=1), 1, 4.0), ("A", t + timedelta(seconds=2), 2, 5.5)], "symbol string, timestamp timestamp, event_id int, bid_price double")
    assert {r.event_id: r.bid_price for r in joins.as_of(trades, quotes, ["bid_price"]).collect()} == {1: None, 2: 5.5, 3: None}


def test_event_windows_use_own_widths(spark):
    df = spark.createDataFrame(minutes(40), BAR)
    events = spark.createDataFrame([("A", 1, datetime(2025, 1, 10, 15, 20), None, None), ("A", 2, datetime(2025, 1, 10, 15, 20), 0, 1)], "symbol string, event_key int, event_time timestamp, window_before_min int, window_after_min int")
    out = joins.in_event_windows(df, events).groupBy("event_key").count().collect()
    assert {r.event_key: r["count"] for r in out} == {1: 11, 2: 2}


def test_triple_barrier(spark):
    t = datetime(2025, 1, 10, 15, 0)
    rows = minutes(3, high=lambda i: (10.0, 12.0, 12.0)[i], low=lambda i: (10.0, 9.5, 8.0)[i]) + minutes(3, symbol="B", high=lambda i: (10.0, 12.0, 10.0)[i], low=lambda i: (10.0, 8.0, 10.0)[i]) + minutes(30, symbol="C")
    events = spark.createDataFrame([(s, s, t, 10.0) for s in "ABCD"], "symbol string, event_key string, event_time timestamp, entry double")
    out = {r.event_key: (r.label, r.exit_return) for r in features.triple_barrier(spark.createDataFrame(rows, BAR), events).collect()}
    assert out == {"A": (1, 0.15), "B": (-1, -0.10), "C": (0, 0.0), "D": (0, None)}


def test_cooldown(spark):
    rows = [("A", datetime(2025, 1, 1, 10, m), date(2025, 1, 1), "x", 1.0) for m in (0, 3, 5, 9, 10, 14)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp, date date, event_type string, score double")
    assert sorted(r.timestamp.minute for r in detectors.with_cooldown(df, 5).collect()) == [0, 5, 10]


def test_sources(spark, tmp_path):
    raw = spark.createDataFrame([(1736519400000, 1.0, 2.0, 0.5, 1.5, 100, 1.2, 7)], "t long, o double, h double, l double, c double, v long, vw double, n int")
    out = B.normalised_bars(raw, "A")
    B.write_bars(out, str(tmp_path / "bars"))
    B.write_bars(out.withColumn("close", F.lit(9.0).cast("float")), str(tmp_path / "bars"))
    back = B.scan_bars(spark, str(tmp_path / "bars")).collect()
    assert len(back) == 1 and back[0].close == 9.0 and back[0].symbol == "A" and str(back[0].timestamp) == "2025-01-10 14:30:00"
    with pytest.raises(ValueError):
        B.checked_manifest(out)
    shorts = B.short_interest(spark.createDataFrame([("A", "2025-01-15")], "ticker string, settlement_date string")).first()
    assert str(shorts.publish_date) == "2025-01-22"
    tickers = spark.createDataFrame([("A", "Abc", "CS", "stocks"), ("B", "Fund", "ETF", "stocks"), ("C", "Cde ADR", "CS", "stocks"), ("D", "Def", "CS", "otc")], "ticker string, name string, type string, market string")
    assert [r.ticker for r in scalars.universe(tickers).collect()] == ["A"] and scalars.universe(tickers, False).count() == 2


def test_logs(spark):
    lines = ["2025-01-01 10:00:00 INFO [10/100] ok", "2025-01-01 10:10:00 INFO [30/100] ok", "DEBUG error here", "HTTP 429", "connection timed out", "ERROR something", "retrying after error"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert {r["class"]: r.n for r in quality.log_classes(df).collect()} == {"rate_limit": 1, "timeout": 1, "error": 1}
    r = quality.log_progress(df).first()
    assert (r.done, r.total, r.rate, r.eta_minutes) == (30, 100, 2.0, 35.0)


def test_numbers_that_are_no_status(spark):
    lines = {
        "timeout": ["ERROR request timed out for 429", "ERROR request timed out for 14290", "timeout after 404 rows"],
        "error": ["ERROR user 404 has no bars", "error in 512 rows", "exception at line 1429", "Error: bad row 503"],
        "rate_limit": ["HTTP 429", "HTTP/1.1 429", "Rate limited (429), giving up", "Max retries exceeded (429) for AAPL", "429 Too Many Requests", "status_code=429", "HTTPError: 429 Client Error", "2025-01-01 10:00:00 ERROR - 429"],
        "not_found": ["HTTP 404", "status: 404", "page not found"],
        "server": ["HTTP 503", "502 Bad Gateway", "got 500 from host", "ERROR (504)"],
    }
    df = spark.createDataFrame([(x,) for v in lines.values() for x in v], "value string")
    assert {r["class"]: r.n for r in quality.log_classes(df).collect()} == {c: len(v) for c, v in lines.items()}


def test_l2_selection_breaks_ties_by_type(spark):
    at = datetime(2025, 1, 10, 15, 0)
    rows = [(s, at, t, x, x, 9.0) for s, x in (("B", 5.0), ("A", 5.0), ("C", 1.0)) for t in ("d", "c", "b", "a")]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp, event_type string, liquidity_score double, rvol_day double, dollar_volume_day double").coalesce(1)
    out = features.l2_selection(df, 0.2, 5.0, 6).orderBy("rank_month").collect()
    assert [r.symbol + r.event_type for r in out] == ["Aa", "Ab", "Ac", "Ad", "Ba", "Bb"]


def test_mean_spread_is_added_up_in_order(spark):
    """Last bits are those of a sum in the order of events, however rows are dealt: means of prices in cents often lie between two roundings."""
    at, spreads = datetime(2025, 1, 10, 15, 0), [((i * 7919) % 1000) / 7 for i in range(400)]
    rows = [(f"S{i % 4}", at + timedelta(seconds=i * 31 % 400), i, 0.1, x + 0.1) for i, x in enumerate(spreads)]
    want = {}
    for s in range(4):
        total = 0.0
        for r in rows[s::4]:
            total += r[4] - r[3]
        want[f"S{s}"] = total / 100
    trades = spark.createDataFrame([(f"S{i % 4}", at, i, 1.0 + i) for i in range(8)], "symbol string, timestamp timestamp, event_id long, price double")
    quotes = spark.createDataFrame(rows, "symbol string, timestamp timestamp, event_id long, bid_price double, ask_price double")
    for dealt in (quotes.coalesce(1), quotes.repartition(7), quotes.orderBy(F.desc("ask_price"))):
        assert {r.symbol: r.mean_spread for r in features.l2_metrics(trades, dealt).collect()} == want


def test_empty_tables(spark):
    df = spark.createDataFrame([], BAR)
    assert detectors.intraday_events(df).count() == 0 and halts.detect_halts(df).count() == 0 and detectors.daily_events(df.drop("timestamp", "vwap")).count() == 0
    assert quality.bar_quality(df).first().is_empty and aggregates.duplicate_rate(df.withColumn("event_type", F.lit("x"))).first().pct is None
