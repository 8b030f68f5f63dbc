"""Groups that hold most of the rows, shards that are whole or not there, rules that change, and costs."""

import math
import random
from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideline.functions.scalars import data_fingerprint
from tideline.operators import features as X
from tideline.operators import joins, rolling, scans
from tideline.sources import bars as B
from tideline.sources.ledger import Ledger
from tideline.streaming import alerts


def hot(rng, n):
    """Nine of ten rows in one group; null groups and null values among the rest."""
    return [("hot" if rng.random() < 0.9 else rng.choice(("a", "b", None)), i, rng.choice((None, rng.randint(0, 9)))) for i in range(n)]


def test_running_values_of_a_hot_group(spark):
    rows = hot(random.Random(1), 3000)
    df = spark.createDataFrame(rows, "g string, i long, v long").repartition(3)
    parts = scans.sorted_parts(df, ("g",), ("i",))
    assert parts.where("g = 'hot'").select("__part").distinct().count() == 4
    sums = {(r.g, r.i): r.s for r in scans.running_sum(df, ("g",), ("i",), "v", "s").collect()}
    last = {(r.g, r.i): r.l for r in scans.last_known(df, ("g",), ("i",), "v", "l").collect()}
    total, known = {}, {}
    for g, i, v in rows:
        assert sums[g, i] == total.get(g, 0)
        total[g] = total.get(g, 0) + (v or 0)
        known[g] = v if v is not None else known.get(g)
        assert last[g, i] == known[g]
    assert len(sums) == len(last) == 3000
    assert scans.running_sum(df.where("i < 0"), ("g",), ("i",), "v", "s").count() == 0


def test_ranks_of_a_hot_group(spark):
    rng = random.Random(2)
    rows = [(k, "hot" if rng.random() < 0.9 else rng.choice(("a", None)), rng.choice((None, 0.5, round(rng.random(), 2)))) for k in range(2000)] + [(5000, "one", 3.0), (5001, "twins", 1.0), (5002, "twins", 1.0)]
    out = rolling.average_rank_cdf(spark.createDataFrame(rows, "k long, g string, score double"), by=("g",)).collect()
    frame = pd.DataFrame(rows, columns=["k", "g", "score"]).dropna(subset="score")
    frame["g"] = frame["g"].fillna("-")
    rank = frame.groupby("g")["score"].rank()
    top = rank.groupby(frame["g"]).transform("max")
    want = dict(zip(frame["k"], [0.5 if t <= 1 else (r - 1) / (t - 1) for r, t in zip(rank, top)]))
    assert {r.k for r in out} == set(want) and all(math.isclose(r.score, want[r.k]) for r in out)
    assert {r.k: r.score_raw for r in out} == dict(zip(frame["k"], frame["score"]))


def test_as_of_a_hot_symbol(spark):
    rng, t0 = random.Random(3), datetime(2025, 1, 10)
    at = lambda: t0 + timedelta(seconds=rng.randint(0, 900))
    sym = lambda: "hot" if rng.random() < 0.9 else rng.choice(("a", "b"))
    left = [(sym(), at(), i) for i in range(800)]
    right = [(s, t, 5000 + i, rng.choice((None, rng.random()))) for i in range(700) for s, t in [(sym(), at())]]
    out = joins.as_of(spark.createDataFrame(left, "symbol string, timestamp timestamp, event_id long"), spark.createDataFrame(right, "symbol string, timestamp timestamp, event_id long, bid double"), ["bid"]).collect()
    assert len(out) == 800
    for r in out:
        before = [(t, i, b) for s, t, i, b in right if s == r.symbol and t <= r.timestamp]
        assert r.bid == (max(before, key=lambda x: x[:2])[2] if before else None)


@pytest.mark.parametrize("block", [256, 4, 1])
def test_exponential_mean(spark, block):
    rng, rows, want = random.Random(4), [], {}
    for s, n in (("A", 60), ("B", 1), ("C", 9), ("D", 5)):
        xs = [None if (s == "D" or rng.random() < 0.2) else rng.uniform(1, 50) for _ in range(n)]
        for i, (x, m) in enumerate(zip(xs, pd.Series(xs, dtype="float64").ewm(span=12, adjust=False, ignore_na=True).mean())):
            rows.append((s, date(2025, 1, 1) + timedelta(days=i), x))
            want[s, rows[-1][1]] = None if math.isnan(m) else m
    out = X.exponential_mean(spark.createDataFrame(rows, "symbol string, date date, close double"), "close", 12, "m", block=block).collect()
    assert len(out) == len(want)
    for r in out:
        w = want[r.symbol, r.date]
        assert (r.m is None) == (w is None) and (w is None or math.isclose(r.m, w, rel_tol=1e-9))


def test_ledger(spark, tmp_path):
    rows = spark.createDataFrame([(f"s{i % 7}", i, float(i)) for i in range(300)], "symbol string, timestamp long, x double")
    ledger = Ledger(spark, str(tmp_path / "events"))
    with pytest.raises(FileNotFoundError):
        ledger.read()
    assert ledger.append(rows.where("timestamp < 100"), "a") == 0
    dead = ledger.write(rows.where("timestamp >= 100"))  # dies before it commits
    assert ledger.read().count() == 100 and ledger.orphans() == [dead]
    assert ledger.append(rows.where("timestamp >= 100").drop("x"), "b") == 1 and ledger.append(rows, "a") == 0
    assert ledger.read().count() == 300 and ledger.read().where("x is null").count() == 200
    other = Ledger(spark, str(tmp_path / "events"))
    assert not other._put("00000001.json", "{}")  # a number is taken once
    assert other.append(rows.limit(5), "c") == 2
    whole = sorted(map(str, ledger.read().collect()))
    assert ledger.compact() == 3 and ledger.compact() is None
    assert sorted(map(str, other.read().collect())) == whole and [e["replaces"] for e in other.live()] == [[0, 1, 2]]
    assert ledger.append(rows, "b") == 1  # a merged batch is still known
    late = [e["number"] for e in ledger.entries()][:2]
    with pytest.raises(RuntimeError, match="replaced"):
        ledger._commit(ledger.write(rows), "another merge of the same", late)
    assert len(ledger.orphans()) == 5 and ledger.vacuum() == []
    assert len(ledger.vacuum(0)) == 5 and sorted(map(str, ledger.read().collect())) == whole


def test_clustered_table(spark, tmp_path):
    days = [date(2025, 1, 1)] * 900 + [date(2025, 2, 1 + i % 20) for i in range(100)]
    rows = [("hot" if i % 2 else f"s{i % 40}", d, datetime(2025, 1, 1) + timedelta(minutes=i), 1.0, i) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "symbol string, date date, timestamp timestamp, close double, volume long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = B.write_clustered(df, "clustered_bars", str(tmp_path / "t"), buckets=4, rows_per_file=100)
        windowed = table.withColumn("n", F.count("*").over(rolling.by_symbol()))
        joined = table.join(table.groupBy("symbol").agg(F.max("close").alias("top")), "symbol")
        for plan in (windowed, joined):
            assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, table.collect())) == sorted(map(str, df.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table clustered_bars")
    B.write_bars(df, str(tmp_path / "bars"), spread=4, rows_per_file=150)
    files = list((tmp_path / "bars" / "date=2025-01-01").glob("*.parquet"))
    assert len(files) >= 4 and max(spark.read.parquet(str(f)).count() for f in files) <= 150
    assert B.scan_bars(spark, str(tmp_path / "bars")).count() == 1000


EVENT = "symbol string, timestamp timestamp, date date, event_type string, direction string, session string, close double, score double, spike_x double"


def test_alerts(spark, tmp_path):
    rng, t0 = random.Random(6), datetime(2025, 1, 10)
    events = [(rng.choice("AB"), t0 + timedelta(minutes=i), (t0 + timedelta(minutes=i)).date(), rng.choice(alerts.TYPES), rng.choice(("up", "down")), rng.choice(("RTH", "PM")), rng.uniform(1, 20), rng.choice((None, rng.random())), rng.choice((None, 3.0))) for i in range(120)]
    maybe = lambda x: x if rng.random() < 0.4 else None
    rules = [(i, i % 5, maybe(["flush", "vwap_break", "flush"]), maybe(["RTH"]), maybe(["A", "C"]), maybe("up"), maybe(5.0), maybe(15.0), maybe(0.5), maybe(2.0)) for i in range(40)] + [(99, 1, [], None, None, None, None, None, None, None)]
    fit = lambda e, r: (r[2] is None or e[3] in r[2]) and (r[3] is None or e[5] in r[3]) and (r[4] is None or e[0] in r[4]) and (r[5] is None or e[4] == r[5]) and (r[6] is None or e[6] >= r[6]) and (r[7] is None or e[6] <= r[7]) and (r[8] is None or (e[7] is not None and e[7] >= r[8])) and (r[9] is None or (e[8] is not None and e[8] >= r[9]))
    table = spark.createDataFrame(events, EVENT)
    got = alerts.matched(table, spark.createDataFrame(rules, alerts.RULES))
    want = sorted((r[0], r[1], e[1]) for e in events for r in rules if fit(e, r))
    assert sorted((a.rule_id, a.user, a.timestamp) for a in got.collect()) == want and len(want) > 100
    best = alerts.ranked(got, 3).collect()
    for user in {a[1] for a in want}:
        own = sorted({(-e[7] if e[7] is not None else 1, e[1]) for e in events for r in rules if r[1] == user and fit(e, r)})[:3]
        assert [x.timestamp for x in sorted(best, key=lambda x: x.rank) if x.user == user] == [t for _, t in own]
    # On a stream: a rule that changes between two batches counts in the second.
    one = [(1, 7, None, None, None, "up", None, None, None, None)]
    paths = {n: str(tmp_path / n) for n in ("in", "rules", "out", "log")}
    for direction, half in (("up", events[:60]), ("down", events[60:])):
        spark.createDataFrame([(*one[0][:5], direction, *one[0][6:])], alerts.RULES).write.mode("overwrite").parquet(paths["rules"])
        spark.createDataFrame(half, EVENT).coalesce(1).write.mode("append").parquet(paths["in"])
        source = spark.readStream.schema(EVENT).parquet(paths["in"])
        source.writeStream.foreachBatch(alerts.alerting(spark, paths["rules"], paths["out"])).option("checkpointLocation", paths["log"]).trigger(availableNow=True).start().awaitTermination()
    seen = {a.timestamp for a in spark.read.parquet(paths["out"]).collect()}
    assert seen == {e[1] for e in events[:60] if e[4] == "up"} | {e[1] for e in events[60:] if e[4] == "down"}


def test_costs(spark):
    rows = [(10.0, 0.10, 0.04, 0.02, False), (10.0, 0.10, 0.04, 0.02, True), (2.0, -0.05, None, None, None), (0.0, 0.1, 0.1, 0.1, False), (10.0, None, 0.04, 0.02, False)]
    a, b, c, d, e = X.net_of_costs(spark.createDataFrame(rows, "entry double, exit_return double, spread double, sigma double, ssr boolean")).collect()
    assert math.isclose(a.fees, (0.006 + 0.0000278 * 11) / 10) and math.isclose(a.slip, 2 * (0.02 + 0.2 * 0.02 * 10) / 10)
    assert math.isclose(b.slip, 2 * (0.08 + 0.04) / 10) and math.isclose(b.net_return, 0.10 - b.fees - b.slip) and b.net_label == 1
    assert math.isclose(c.slip, 0.01) and c.net_label == -1
    assert d.net_return is None and e.net_return is None


def test_fingerprints_differ(spark):
    of = lambda *rows: data_fingerprint(spark.createDataFrame(rows, "a string, b string")).first().fingerprint
    assert len({of(("a|b", "c")), of(("a", "b|c")), of((None, "x")), of(("-", "x")), of(("", "1:x")), of(("1:x", "")), of(("\\N", "x"))}) == 7
    assert of(("a", "b"), ("c", None)) == of(("c", None), ("a", "b"))


@pytest.mark.parametrize("limits", [(), ("max_price",), ("min_price", "sessions", "min_score"), ("min_spike", "direction", "symbols"), ("direction", "min_score", "max_price"), ("min_price", "max_price", "min_spike", "sessions", "symbols", "direction", "min_score")])
def test_best_alerts_without_all_pairs(spark, limits, monkeypatch):
    monkeypatch.setattr(alerts, "BROADCAST_EVENTS", 200 if "sessions" in limits else 200_000)
    rng, t0 = random.Random(len(limits)), datetime(2025, 1, 10)
    odd = lambda x: rng.choice((None, math.nan, x, x, x, x, x, x))
    at = [(s, t0 + timedelta(hours=i), t, d) for s in "ABC" for i in range(40) for t in ("flush", "vwap_break", "other") for d in ("up", "down", None) if rng.random() < 0.6]
    events = [(s, ts, ts.date(), t, d, rng.choice(("RTH", "PM", "late")), odd(float(rng.randint(1, 20))), odd(round(rng.random(), 1)), odd(float(rng.randint(1, 5)))) for s, ts, t, d in at]
    limit = lambda c, x: x if c in limits and rng.random() < 0.6 else None
    rules = [(i, i % 25, rng.choice((None, ["flush"], ["other", "flush"], [])), limit("sessions", ["RTH", "late"]), limit("symbols", ["A", "C"]), limit("direction", "up"), limit("min_price", rng.uniform(1, 20)), limit("max_price", rng.uniform(1, 20)), limit("min_score", rng.random()), limit("min_spike", rng.uniform(1, 5))) for i in range(60)]
    events, rules = spark.createDataFrame(events, EVENT).repartition(3), spark.createDataFrame(rules, alerts.RULES)
    columns = ("user", "symbol", "timestamp", "event_type", "direction", "rule_id", "date", "score", "rank")
    shown = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert shown(alerts.best(events, rules, 3)) == shown(alerts.ranked(alerts.matched(events, rules), 3))
    if len(limits) < 3:
        assert alerts._worth_keeping(events, rules, 3).count() < events.count() / 2


def test_best_alerts_write_little(spark):
    rng, t0 = random.Random(5), datetime(2025, 1, 10)
    events = spark.createDataFrame([("A", t0 + timedelta(minutes=i), date(2025, 1, 10 + i % 4), "flush", "up", "RTH", rng.uniform(1, 20), rng.random(), 1.0) for i in range(1000)], EVENT)
    rules = spark.createDataFrame([(i, i, None, None, None, None, None, rng.uniform(1, 20), rng.random() / 2, None) for i in range(500)], alerts.RULES)
    store = spark.sparkContext._jsc.sc().statusStore()
    written = lambda: store.executorList(False).apply(0).totalShuffleWrite()
    events.groupBy("symbol").count().collect()
    before = written()
    assert alerts.best(events, rules, 3).count() > 4000
    assert written() - before < 300_000
