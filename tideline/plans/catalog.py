"""The registered queries: each applies operators to whole tables, beside the DuckDB SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6


def rounded(x: Column) -> Column:
    """x to DIGITS places as the SQL's round has it: the multiple is rounded, not the decimal that x reads as, which differs where x lies at a half."""
    near = F.round(x * 10.0**DIGITS) / 10.0**DIGITS
    return F.when(F.abs(near) == float("inf"), x).otherwise(near)


def plain(df: DataFrame) -> DataFrame:
    """Timestamps as epoch microseconds, dates as text, doubles rounded: what both engines print alike."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = F.unix_micros(c)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = rounded(c.cast("double")) + 0.0  # no negative zero
        out.append(c.alias(f.name))
    return df.select(*out)


def query(sql: str | None = None, doubles: str = "", dates: str = "", times: str = "") -> Callable:
    """Registers a function under its name; sql's columns named in doubles, dates and times are brought to the same plain form."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: plain(f(spark, sf_dir))
        if sql:
            parts = [f"round(({c})::double, {DIGITS}) + 0.0 as {c}" for c in doubles.split()] + [f"({c})::date::varchar as {c}" for c in dates.split()] + [f"epoch_us({c}) as {c}" for c in times.split()]
            head, _, tail = sql.strip().rpartition("\n---\n")
            body = tail or head
            wrapped = f"select * replace ({', '.join(parts)}) from ({body})" if parts else body
            ORACLES[f.__name__] = f"with {head}\n{wrapped}" if tail and head else wrapped
        return f

    return add


TICKS = "ticks as (select event_type as symbol, ts as timestamp, event_id, user_id, value as price, (props->>'k')::bigint as size from events)"
BARS = TICKS + """,
bars as (select symbol || '-' || (user_id // 150) as symbol, time_bucket(interval 15 minutes, timestamp) as timestamp, time_bucket(interval 15 minutes, timestamp)::date as date,
  arg_min(price, timestamp) as open, max(price) as high, min(price) as low, arg_max(price, timestamp) as close, sum(size)::bigint as volume,
  sum(price * size) / nullif(sum(size), 0) as vwap, count(*) as transactions from ticks group by 1, 2, 3)"""
DAILY = """rows_ as (select l_suppkey as symbol, l_shipdate::date as date, l_extendedprice / l_quantity as price, l_quantity as q,
  row(l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) as o from lineitem),
daily as (select symbol, date, arg_min(price, o) as open, max(price) as high, min(price) as low, arg_max(price, o) as close, sum(q) as volume from rows_ group by 1, 2)"""
METRICS = DAILY + """,
m1 as (select *, lag(close) over s as prev_close, case when count(volume) over w20 >= 5 then avg(volume) over w20 end as avg_volume,
  min(low) over w5 as low5, max(high) over w5 as high5, count(*) over (partition by symbol) as days from daily
  window s as (partition by symbol order by date), w20 as (s rows between 19 preceding and current row), w5 as (s rows between 4 preceding and current row)),
m2 as (select *, (open - prev_close) / nullif(prev_close, 0) * 100 as gap_pct, (high - low) / nullif(open, 0) * 100 as ire_pct, volume / nullif(avg_volume, 0) as rvol,
  greatest(high - low, abs(high - prev_close), abs(low - prev_close)) as tr, close * volume as dollar_volume, coalesce(low <= 0.9 * prev_close, false) as ssr,
  (low5 - close) / nullif(low5, 0) * 100 as drawdown_low_pct, (high5 - close) / nullif(high5, 0) * 100 as drawdown_high_pct from m1),
metrics as (select *, atr / nullif(close, 0) * 100 as atr_pct from (select *, case when count(tr) over w >= 10 then avg(tr) over w end as atr from m2
  window w as (partition by symbol order by date rows between 20 preceding and current row)))"""
ET = "timezone('America/New_York', timezone('UTC', {}))"
MINUTE = "(extract(hour from {0}) * 60 + extract(minute from {0}))"


def et(c: str = "timestamp") -> str:
    return ET.format(c)


def minute(c: str = "timestamp") -> str:
    return MINUTE.format(et(c))


def session(c: str = "timestamp", other: str = "CLOSED") -> str:
    m = minute(c)
    return f"case when {m} between 240 and 569 then 'PM' when {m} between 570 and 959 then 'RTH' when {m} between 960 and 1199 then 'AH' else '{other}' end"
