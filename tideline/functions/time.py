"""Market time: storage is UTC, sessions are those of New York."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKET = "America/New_York"


def market_time(ts: Column) -> Column:
    """UTC timestamp to New York wall clock, daylight saving included."""
    return F.from_utc_timestamp(ts, MARKET)


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def session_of(ts: Column, fallback: str | None = "CLOSED", compat: bool = False) -> Column:
    """PM 04:00-09:30, RTH 09:30-16:00, AH 16:00-20:00 of a wall clock, else the fallback. compat: all of minute 16:00 is RTH."""
    m = minute_of_day(ts)
    close = 961 if compat else 960
    return F.when((m >= 240) & (m < 570), "PM").when((m >= 570) & (m < close), "RTH").when((m >= close) & (m < 1200), "AH").otherwise(F.lit(fallback))


def clock_session(ts: Column) -> Column:
    """premarket, rth, postmarket or unknown, by HH:mm of a wall clock; ends are exclusive."""
    hm = F.date_format(ts, "HH:mm")
    return F.when((hm >= "04:00") & (hm < "09:30"), "premarket").when((hm >= "09:30") & (hm < "16:00"), "rth").when((hm >= "16:00") & (hm < "20:00"), "postmarket").otherwise("unknown")


def with_market_time(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """df with timestamp_et, hour_et, minute_et, time_decimal, session (premarket, rth, postmarket, closed), is_market_hours, is_extended_hours."""
    et = market_time(F.col(ts))
    name = clock_session(F.col("timestamp_et"))
    out = df.withColumn("timestamp_et", et).withColumn("hour_et", F.hour("timestamp_et")).withColumn("minute_et", F.minute("timestamp_et"))
    out = out.withColumn("time_decimal", F.col("hour_et") + F.col("minute_et") / 60.0).withColumn("session", F.when(name == "unknown", "closed").otherwise(name))
    return out.withColumn("is_market_hours", F.col("session") == "rth").withColumn("is_extended_hours", F.col("session").isin("premarket", "postmarket"))


def recalculated_sessions(df: DataFrame, ts: str = "timestamp", compat: bool = False, keep_closed: bool = False) -> DataFrame:
    """df with session recomputed from New York time; rows outside all sessions go unless keep_closed."""
    out = df.withColumn("session", session_of(market_time(F.col(ts)), "CLOSED", compat))
    return out if keep_closed else out.where("session <> 'CLOSED'")


def in_clock_range(ts: Column, start: str, end: str) -> Column:
    """Whether the wall clock lies in [start, end], both HH:MM and inclusive."""

    def minutes(x: str) -> int:
        return int(x[:2]) * 60 + int(x[3:])

    return minute_of_day(ts).between(minutes(start), minutes(end))


def parsed_timestamp(df: DataFrame, name: str) -> Column:
    """A timestamp from a column of strings, epoch nanoseconds, dates or timestamps; what can't be read is null."""
    kind = df.schema[name].dataType.simpleString()
    if kind == "string":
        return F.try_to_timestamp(F.col(name))
    if kind in ("bigint", "int"):
        return F.timestamp_micros(F.expr(f"`{name}` div 1000"))
    return F.col(name).cast("timestamp")
