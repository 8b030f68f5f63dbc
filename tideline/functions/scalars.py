"""Scalar expressions on bars and events."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = 1e-9


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0: such rows drop out of filters."""
    return F.try_divide(a, b)


def typical_price() -> Column:
    return (F.col("high") + F.col("low") + F.col("close")) / 3


def with_derived(df: DataFrame) -> DataFrame:
    """df with vwap_min, dollar_volume_bar and spread_proxy, each only if it isn't there."""
    for name, value in (("vwap_min", typical_price()), ("dollar_volume_bar", F.col("volume") * F.col("vwap_min")), ("spread_proxy", ratio(F.col("high") - F.col("low"), F.col("vwap_min")))):
        if name not in df.columns:
            df = df.withColumn(name, value)
    return df


def clipped(price: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(price, F.lit(high)), F.lit(low))


def body_ratio() -> Column:
    return F.abs(F.col("close") - F.col("open")) / (F.col("high") - F.col("low") + EPS)


def with_labels(df: DataFrame) -> DataFrame:
    """df with event_bias, close_vs_open and tier."""
    bias = F.when(F.col("direction") == "up", "bullish").when(F.col("direction") == "down", "bearish").otherwise("neutral")
    return df.withColumn("event_bias", bias).withColumn("close_vs_open", F.when(F.col("close") > F.col("open"), "green").otherwise("red")).withColumn("tier", F.lit(1))


def event_id(symbol: Column, kind: Column, ts: Column) -> Column:
    """symbol_type_YYYYMMDD_HHMMSS_ and eight hex digits of a SHA-1 over symbol, type and UTC time."""
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    digest = F.substring(F.sha1(F.concat_ws("|", symbol, kind, iso).cast("binary")), 1, 8)
    return F.concat_ws("_", symbol, kind, F.date_format(ts, "yyyyMMdd_HHmmss"), digest)


def daily_event_id(is_event: Column, date: Column) -> Column:
    return F.when(is_event, F.date_format(date, "yyyyMMdd"))


def null_count(df: DataFrame, keys: tuple[str, ...] = ("symbol", "timestamp", "event_type")) -> Column:
    """Nulls of a row outside the key."""
    out = F.lit(0)
    for c in df.columns:
        if c not in keys:
            out = out + F.col(f"`{c}`").isNull().cast("int")
    return out


def config_fingerprint(config: dict) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True).encode()).hexdigest()[:16]


def data_fingerprint(df: DataFrame) -> DataFrame:
    """One row: rows, and a sum over the rows of the first 60 bits of their MD5, which doesn't depend on their order.

    Each field goes in with its length before it, a null as a sign of its own, so different rows have different texts.
    """
    sized = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    text = F.concat(*[sized(F.col(f"`{c}`").cast("string")) for c in df.columns])
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(bits), F.lit(0)).cast("decimal(38,0)").alias("fingerprint"))


def universe(df: DataFrame, drop_adr: bool = True, letters: tuple[str, ...] | None = None) -> DataFrame:
    """Common stocks that are no ETF and not traded over the counter."""
    out = df.where((F.col("type") == "CS") & (F.coalesce(F.col("market"), F.lit("")) != "otc"))
    if drop_adr:
        out = out.where(~F.upper(F.coalesce("name", F.lit(""))).contains("ADR"))
    return out.where(F.substring("ticker", 1, 1).isin(*letters)) if letters else out
