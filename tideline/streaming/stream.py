"""The operators on streams. Rolling frames don't exist on streams, so detectors run as their batch selves on a bounded look-back."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.config import IntradayConfig
from tideline.operators.detectors import intraday_events
from tideline.storage import shared_folder


def minute_bars(ticks: DataFrame, width: str = "1 minute", late: str = "5 minutes") -> DataFrame:
    """Ticks (symbol, timestamp, price, size) to bars; ticks later than `late` are dropped by the watermark."""
    out = ticks.withWatermark("timestamp", late).groupBy("symbol", F.window("timestamp", width).alias("w")).agg(
        F.min_by("price", "timestamp").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "timestamp").alias("close"), F.sum("size").alias("volume"), F.count("*").alias("transactions")
    )
    return out.select("symbol", F.col("w.start").alias("timestamp"), F.to_date("w.start").alias("date"), "open", "high", "low", "close", "volume", "transactions")


def screener(events: DataFrame, types: tuple[str, ...], width: str = "5 minutes", slide: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Symbols that show all of the event types within a sliding window."""
    out = events.withWatermark("timestamp", late).groupBy("symbol", F.window("timestamp", width, slide).alias("w")).agg(F.collect_set("event_type").alias("types"))
    return out.where(F.size(F.array_intersect("types", F.array(*[F.lit(t) for t in types]))) == len(types)).select("symbol", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))


def deduplicated(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("timestamp", late).dropDuplicatesWithinWatermark(["symbol", "timestamp", "event_type"])


def enriched_stream(events: DataFrame, static: DataFrame, on: list[str]) -> DataFrame:
    return events.join(static, on, "left")


def live_detectors(spark: SparkSession, bars_path: str, events_path: str, cfg: IntradayConfig, days: int = 1) -> Callable[[DataFrame, int], None]:
    """For foreachBatch over bars: appends them, runs the batch detectors on the days they touch, and replaces those days' events.

    The look-back is the symbol-day, which all frames end at, so results equal the batch ones; a batch that is run again
    writes the same days anew.
    """

    def step(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "date").parquet(bars_path)
        touched = batch.select("date").distinct()
        bars = spark.read.parquet(bars_path).drop("batch").join(F.broadcast(touched), "date", "left_semi")  # the dates of one batch
        found = intraday_events(bars, cfg)
        found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(events_path)

    return step


def cooldown(events: DataFrame, minutes: int, late: str = "1 hour") -> DataFrame:
    """Events at least `minutes` after the last accepted one of their symbol, day and type, as `with_cooldown` has them: state
    holds that one time per key, and goes once the watermark has passed the day.

    Times count in whole seconds, and all events of an accepted second stay; events of a batch are taken in time order. The
    columns are symbol, event_type, timestamp.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    step = 60 * minutes

    def accept(key, frames, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames), ignore_index=True).sort_values("second", kind="stable")
        last = state.get[0] if state.exists else None
        kept = []
        for i, t in enumerate(rows["second"].tolist()):
            if last is None or t == last or t - last >= step:
                kept.append(i)
                last = t
        state.update((last,))
        state.setTimeoutTimestamp(max(int(rows["day_end"].iloc[0]) * 1000, state.getCurrentWatermarkMs() + 1))
        yield rows.iloc[kept][["symbol", "event_type", "timestamp"]]

    day = F.to_date("timestamp")
    columns = ["symbol", "event_type", "timestamp", day.alias("date"), F.unix_timestamp("timestamp").alias("second"), F.unix_timestamp(F.date_add(day, 1).cast("timestamp")).alias("day_end")]
    keyed = events.withWatermark("timestamp", late).select(*columns).groupBy("symbol", "date", "event_type")
    return keyed.applyInPandasWithState(accept, "symbol string, event_type string, timestamp timestamp", "last long", "append", GroupStateTimeout.EventTimeTimeout)


def finished(stream: DataFrame) -> DataFrame:
    """What a stream has written once it has taken all that its source holds."""
    folder = shared_folder(stream.sparkSession)
    query = stream.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """State in RocksDB, which operators with timers need, while a query is started; the session's own setting comes back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def replayed(rows: DataFrame, build: Callable[[DataFrame], DataFrame], late: int, slices: int = 4) -> DataFrame:
    """What build makes of rows (with a timestamp) that arrive over time: each row up to `late` seconds after its time, in as many
    slices, one run of the query for each from where the last one stopped, then a heartbeat that lets out what waits."""
    spark = rows.sparkSession
    folder = shared_folder(spark)
    span = rows.agg(F.unix_seconds(F.min("timestamp")).alias("a"), F.unix_seconds(F.max("timestamp")).alias("b")).first()
    if span["a"] is None:
        return finished(build(spark.readStream.schema(rows.schema).parquet(_written(rows, f"{folder}/in"))))
    step = max(1, -(-(span["b"] + late - span["a"] + 1) // slices))
    at = F.unix_seconds("timestamp") + F.pmod(F.xxhash64(*rows.columns), F.lit(late)) - span["a"]
    rows.withColumn("__slice", F.floor(at / step)).write.partitionBy("__slice").parquet(f"{folder}/all")
    beat = spark.range(1).select(*[(F.timestamp_seconds(F.lit(span["b"] + 30 * 86_400 + late)) if f.name == "timestamp" else F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema])
    every = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("__slice", T.LongType())])).parquet(f"{folder}/all")
    for k in range(slices + 1):
        _written(every.where(f"__slice = {k}").drop("__slice") if k < slices else beat, f"{folder}/in")
        out = build(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"))
        with rocksdb(spark):
            query = out.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{folder}/rows")


def _written(rows: DataFrame, path: str) -> str:
    rows.write.mode("append").parquet(path)
    return path
