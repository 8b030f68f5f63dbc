"""The given tables as market data: ticks, intraday and daily bars, halts, trades, quotes and ticker details."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks_of(events: DataFrame) -> DataFrame:
    """Events as ticks; a stream of them stays one."""
    size = F.get_json_object("props", "$.k").cast("long")
    return events.select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("timestamp"), "event_id", "user_id", F.col("value").alias("price"), size.alias("size"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_of(table(spark, sf_dir, "events"))


def bars_of(trades: DataFrame, width: str = "15 minutes") -> DataFrame:
    """OHLCV bars of ticks (symbol, timestamp, price, size)."""
    out = trades.groupBy("symbol", F.window("timestamp", width).alias("w")).agg(
        F.min_by("price", "timestamp").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "timestamp").alias("close"),
        F.sum("size").alias("volume"), F.try_divide(F.sum(F.col("price") * F.col("size")), F.sum("size")).alias("vwap"), F.count("*").alias("transactions"),
    )
    return out.select("symbol", F.col("w.start").alias("timestamp"), F.to_date("w.start").alias("date"), "open", "high", "low", "close", "volume", "vwap", "transactions")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute bars; a symbol is an event type of 150 users, so that symbols grow in number with the data, not in length."""
    return bars_of(ticks(spark, sf_dir).withColumn("symbol", F.concat_ws("-", "symbol", F.floor(F.col("user_id") / 150))))


def daily_bars(spark: SparkSession, sf_dir: str, dealt: int | None = None) -> DataFrame:
    """Daily bars; symbols are the suppliers. dealt: so many tasks get whole symbols, from the rows as they are read: no other exchange follows."""
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    rows = table(spark, sf_dir, "lineitem")
    rows = (rows.repartition(dealt, "l_suppkey") if dealt else rows).withColumn("price", F.col("l_extendedprice") / F.col("l_quantity"))
    return rows.groupBy(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("date")).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"), F.sum("l_quantity").alias("volume")
    )


def halts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Halts of the symbols by their `error` users: even events stay open."""
    t = ticks(spark, sf_dir).where("symbol = 'error'")
    end = F.when(F.col("event_id") % 2 == 1, F.col("timestamp") + F.expr("interval 20 minutes"))
    return t.select(F.col("user_id").alias("symbol"), F.col("timestamp").alias("halt_timestamp"), end.alias("resume_timestamp"))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks(spark, sf_dir).where("symbol = 'purchase'").select(F.col("user_id").alias("symbol"), "timestamp", "event_id", "price", "size")


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir).where("symbol = 'view'")
    return t.select(F.col("user_id").alias("symbol"), "timestamp", "event_id", (F.col("price") * 0.99).alias("bid_price"), (F.col("price") * 1.01).alias("ask_price"), F.col("size").alias("bid_size"), (100 - F.col("size")).alias("ask_size"))


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap = F.when(F.col("s_suppkey") % 7 != 0, F.col("s_acctbal") * 1_000_000)
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ticker"), F.col("s_name").alias("name"), cap.alias("market_cap"))
