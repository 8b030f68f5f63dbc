"""Streams give what the batch operators give on the same rows."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tideline.config import IntradayConfig
from tideline.operators.detectors import intraday_events, with_cooldown
from tideline.sources.adapters import bars_of
from tideline.streaming import stream

TICK = "symbol string, timestamp timestamp, price double, size bigint, event_type string"


@pytest.fixture(scope="module")
def ticks(spark, tmp_path_factory):
    t0 = datetime(2025, 1, 10, 14, 30)
    rows = [("AB"[i % 2], t0 + timedelta(seconds=20 * i), 10 + (i * 37 % 101) / 25, 100 + i * 13 % 977, ("x", "y", "z")[i % 3]) for i in range(900)]
    path = str(tmp_path_factory.mktemp("ticks"))
    for k in range(3):
        spark.createDataFrame(rows[300 * k : 300 * (k + 1)], TICK).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    return path


def source(spark, path):
    return spark.readStream.schema(TICK).option("maxFilesPerTrigger", 1).parquet(path)


def rows_of(spark, df, name, tmp_path):
    query = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name)


def test_minute_bars_equal_batch(spark, ticks, tmp_path):
    got = rows_of(spark, stream.minute_bars(source(spark, ticks), late="1 minute"), "bars", tmp_path)
    batch = bars_of(spark.read.parquet(ticks), "1 minute").drop("vwap")
    a = {tuple(r) for r in got.select(batch.columns).collect()}
    assert a and a <= {tuple(r) for r in batch.collect()} and len(a) >= batch.count() - 4


def test_dedup_and_screener(spark, ticks, tmp_path):
    twice = source(spark, ticks).select("symbol", F.date_trunc("minute", "timestamp").alias("timestamp"), "event_type")
    got = rows_of(spark, stream.deduplicated(twice), "dedup", tmp_path)
    assert got.count() == spark.read.parquet(ticks).select("symbol", F.date_trunc("minute", "timestamp"), "event_type").distinct().count()
    found = rows_of(spark, stream.screener(source(spark, ticks), ("x", "y", "z")), "screen", tmp_path)
    assert found.where("symbol = 'A'").count() > 0


def test_live_detectors_equal_batch(spark, ticks, tmp_path):
    cfg = IntradayConfig(min_bars=10, rth_spike=1.5, rth_volume=100, rth_dollar_volume=100, min_range_pct=0.1, vwap_up_pct=5, vwap_down_pct=5, vwap_up_volume=1, vwap_down_volume=1)
    batch = bars_of(spark.read.parquet(ticks), "1 minute")
    bars, events = str(tmp_path / "bars"), str(tmp_path / "events")
    batch.repartition(3).write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    src.writeStream.foreachBatch(stream.live_detectors(spark, bars, events, cfg)).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    cols = ["symbol", "timestamp", "event_type", "direction"]
    got, want = spark.read.parquet(events).select(cols).collect(), intraday_events(batch, cfg).select(cols).collect()
    assert want and sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_cooldown_equals_batch(spark, ticks, tmp_path):
    got = rows_of(spark, stream.cooldown(source(spark, ticks), 5), "cool", tmp_path)
    want, last = set(), {}
    for r in spark.read.parquet(ticks).orderBy("timestamp").collect():
        k = (r.symbol, r.event_type)
        if k not in last or r.timestamp - last[k] >= timedelta(minutes=5):
            want.add((*k, r.timestamp))
            last[k] = r.timestamp
    assert {tuple(r) for r in got.collect()} == want


def test_cooldown_equals_the_batch_operator_over_midnight(spark, tmp_path):
    """Many batches over three days, equal seconds included; the state of a day goes when the day is over."""
    t0 = datetime(2025, 1, 10, 20, 0)
    rows = [("AB"[i % 2], t0 + timedelta(seconds=170 * (i // 3)), 1.0, 1, ("x", "y", "z")[i % 3]) for i in range(3000)]
    for k in range(6):
        spark.createDataFrame(rows[500 * k : 500 * (k + 1)], TICK).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)
    stored = spark.read.schema(TICK).parquet(str(tmp_path / "in"))
    want = with_cooldown(stored.withColumn("date", F.to_date("timestamp")), 17).select("symbol", "event_type", "timestamp")
    got = stream.finished(stream.cooldown(source(spark, str(tmp_path / "in")), 17))
    rows = sorted(map(tuple, want.collect()))
    assert len({r[2].date() for r in rows}) == 3 and sorted(map(tuple, got.collect())) == rows


def test_stream_static_join(spark, ticks, tmp_path):
    static = spark.createDataFrame([("A", 5.0)], "symbol string, mean_volume double")
    got = rows_of(spark, stream.enriched_stream(source(spark, ticks), static, ["symbol"]), "joined", tmp_path)
    assert got.count() == 900 and got.where("mean_volume = 5").count() == 450
