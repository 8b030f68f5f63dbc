"""Reading, shaping and writing bars, ticks, halts and reference tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names of vendor columns.
BAR_NAMES = {"v": "volume", "vw": "vwap", "o": "open", "c": "close", "h": "high", "l": "low", "t": "timestamp", "n": "transactions"}
TRADE_NAMES = {"sip_timestamp": "timestamp_ns", "participant_timestamp": "exchange_timestamp_ns"}
QUOTE_COLUMNS = ("ask_price", "bid_price", "ask_size", "bid_size", "ask_exchange", "bid_exchange", "conditions", "indicators")


def scan_bars(spark: SparkSession, root: str, **options: str) -> DataFrame:
    """Parquet bars below root, partition columns included; symbol from the path (symbol=S) where no column has it."""
    df = spark.read.options(**options).parquet(root)
    return with_symbol(df)


def scan_shards(spark: SparkSession, root: str) -> DataFrame:
    """All Parquet files below root; unreadable ones are skipped."""
    return spark.read.option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).option("mergeSchema", True).parquet(root)


def with_symbol(df: DataFrame, symbol: str | None = None) -> DataFrame:
    if "symbol" in df.columns:
        return df
    return df.withColumn("symbol", F.lit(symbol) if symbol else F.regexp_extract(F.input_file_name(), r"symbol=([^/]+)", 1))


def normalised_bars(df: DataFrame, symbol: str | None = None) -> DataFrame:
    """Vendor bars (v, vw, o, c, h, l, t in epoch ms, n) as bars."""
    out = df.withColumnsRenamed({k: v for k, v in BAR_NAMES.items() if k in df.columns})
    out = out.withColumn("timestamp", F.timestamp_millis("timestamp")).withColumn("date", F.to_date("timestamp"))
    for c in ("open", "high", "low", "close", "vwap"):
        if c in out.columns:
            out = out.withColumn(c, F.col(c).cast("float"))
    return with_symbol(out, symbol)


def normalised_ticks(df: DataFrame, names: dict[str, str] = TRADE_NAMES) -> DataFrame:
    """Trades or quotes with vendor names and epoch ns: renamed, with a timestamp beside the exact nanoseconds."""
    out = df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})
    return out.withColumn("timestamp", F.timestamp_micros(F.expr("timestamp_ns div 1000")))


def normalised_quotes(df: DataFrame) -> DataFrame:
    """Quotes with vendor names and epoch ns: as normalised_ticks, then the quote's own columns, null where df has none."""
    out = normalised_ticks(df)
    for c in QUOTE_COLUMNS:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("double" if c.endswith(("price", "size")) else "string"))
    return out


def write_bars(df: DataFrame, path: str, spread: int = 16, rows_per_file: int = 5_000_000) -> None:
    """Bars partitioned by date, sorted in each file; dates that df has are replaced, others stay.

    The symbols of a date are dealt over `spread` tasks, each of which writes files of so many rows at most.
    """
    ordered = df.withColumn("__s", F.pmod(F.xxhash64("symbol"), F.lit(spread))).repartition("date", "__s").sortWithinPartitions("date", "symbol", "timestamp").drop("__s")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file).option("compression", "zstd").partitionBy("date").parquet(path)


def write_clustered(df: DataFrame, table: str, path: str, buckets: int = 64, rows_per_file: int = 5_000_000) -> DataFrame:
    """Bars as a table of `buckets` buckets by symbol, sorted by symbol and time in each file: windows and joins by symbol read it without
    an exchange. A bucket is written by several tasks, one for each month of a symbol at most, so neither a busy date nor a busy symbol is one task."""
    month = F.date_format("date", "yyyy-MM")
    dealt = df.withColumn("__m", month).repartition("symbol", "__m").drop("__m")
    dealt.write.mode("overwrite").option("path", path).option("maxRecordsPerFile", rows_per_file).option("compression", "zstd").bucketBy(buckets, "symbol").sortBy("symbol", "timestamp").saveAsTable(table)
    return df.sparkSession.table(table)


def aligned_union(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns that some lack are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def official_halts(lines: DataFrame) -> DataFrame:
    """Halts from pipe-delimited text (column value): date|time|symbol|name|market|reason|pause price|resume date|resume time.

    Header and footer lines, and lines whose time can't be read, are dropped; duration is in minutes, null while open.
    """
    part = lambda i: F.trim(F.get(F.split("value", r"\|"), F.lit(i)))
    out = lines.select(
        F.upper(part(2)).alias("symbol"),
        F.try_to_timestamp(F.concat_ws(" ", part(0), part(1)), F.lit("MM/dd/yyyy HH:mm:ss")).alias("halt_timestamp"),
        F.try_to_timestamp(F.concat_ws(" ", part(7), part(8)), F.lit("MM/dd/yyyy HH:mm:ss")).alias("resume_timestamp"),
        F.upper(part(5)).alias("reason_code"), part(4).alias("market"), part(3).alias("company_name"), F.expr("try_cast(nullif(trim(get(split(value, '\\\\|'), 6)), '') as double)").alias("pause_threshold_price"),
    )
    out = out.where("symbol <> '' and halt_timestamp is not null")
    return out.withColumn("halt_duration_minutes", (F.unix_timestamp("resume_timestamp") - F.unix_timestamp("halt_timestamp")) / 60)


def halt_summary(halts: DataFrame) -> DataFrame:
    return halts.groupBy("reason_code").agg(F.count("*").alias("n_halts"), F.avg("halt_duration_minutes").alias("mean_minutes"))


def short_interest(df: DataFrame, business_days: bool = False) -> DataFrame:
    """settlement_date and publish_date as dates; publish_date is settlement + 7 days if no row has one."""
    for c in ("publish_date", "short_interest", "avg_daily_volume", "days_to_cover"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string" if c == "publish_date" else "double"))
    df = df.withColumn("settlement_date", F.try_to_date("settlement_date")).withColumn("publish_date", F.try_to_date("publish_date"))
    none = df.agg(F.count("publish_date")).scalar() == 0
    step = F.lit(7)
    if business_days:  # seven weekdays on: a week, and two more that may meet a weekend
        step = F.when(F.dayofweek("settlement_date").between(2, 4), 9).when(F.dayofweek("settlement_date") == 7, 10).when(F.dayofweek("settlement_date") == 1, 9).otherwise(11)
    return df.withColumn("publish_date", F.when(none, F.date_add("settlement_date", step)).otherwise(F.col("publish_date")))


def short_volume(df: DataFrame) -> DataFrame:
    for c, kind in (("short_volume", "long"), ("total_volume", "long"), ("short_volume_ratio", "double")):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(kind))
    return df.withColumn("date", F.try_to_date("date"))


def checked_manifest(df: DataFrame, required: tuple[str, ...] = ("symbol", "timestamp", "event_type")) -> DataFrame:
    """df with type renamed to event_type; raises if a required column is missing; window columns default to null."""
    if "event_type" not in df.columns and "type" in df.columns:
        df = df.withColumnRenamed("type", "event_type")
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"manifest lacks {missing}")
    for c in ("window_before_min", "window_after_min"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(T.IntegerType()))
    return df


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_stats(row: DataFrame, path: str) -> None:
    row.write.mode("overwrite").json(path)
