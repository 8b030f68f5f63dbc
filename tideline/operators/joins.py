"""Joins on intervals, as-of joins, coverage and membership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scans import last_known


def _bucket(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_timestamp(ts) / seconds)


def in_intervals(points: DataFrame, spans: DataFrame, keys: tuple[str, ...] = ("symbol",), ts: str = "timestamp", width: int = 3600) -> DataFrame:
    """The points that lie in a span (start, end; both count) of their keys, each once however many spans hold it.

    Spans are laid over buckets of `width` seconds, so the join is an equality on keys and bucket and a symbol's points
    and spans don't meet as a product.
    """
    laid = spans.where("start <= end").withColumn("__b", F.explode(F.sequence(_bucket(F.col("start"), width), _bucket(F.col("end"), width)))).select(*keys, "__b", "start", "end")
    p = points.withColumn("__b", _bucket(F.col(ts), width)).alias("p")
    s = laid.alias("s")
    on = (F.col("p.__b") == F.col("s.__b")) & F.col(f"p.{ts}").between(F.col("s.start"), F.col("s.end"))
    for k in keys:
        on = on & (F.col(f"p.{k}") == F.col(f"s.{k}"))
    return p.join(s, on, "left_semi").drop("__b")


def in_event_windows(ticks: DataFrame, events: DataFrame, before: float = 3, after: float = 7, keys: tuple[str, ...] = ("symbol",), width: int = 600) -> DataFrame:
    """Ticks with each event (event_key, event_time) whose window [-before, +after] minutes holds them.

    events may have window_before_min and window_after_min of their own, which go first where not null.
    """
    own = lambda c, d: F.coalesce(F.col(c).cast("double"), F.lit(float(d))) if c in events.columns else F.lit(float(d))
    lo = F.timestamp_micros((F.unix_micros("event_time") - own("window_before_min", before) * 60_000_000).cast("long"))
    hi = F.timestamp_micros((F.unix_micros("event_time") + own("window_after_min", after) * 60_000_000).cast("long"))
    span = events.withColumn("__lo", lo).withColumn("__hi", hi).withColumn("__b", F.explode(F.sequence(_bucket(F.col("__lo"), width), _bucket(F.col("__hi"), width))))
    span = span.select(*keys, "event_key", "event_time", "__lo", "__hi", "__b")
    out = ticks.withColumn("__b", _bucket(F.col("timestamp"), width)).join(span, [*keys, "__b"])
    return out.where(F.col("timestamp").between(F.col("__lo"), F.col("__hi"))).drop("__b", "__lo", "__hi")


def session_slices(events: DataFrame, bars: DataFrame, spec: list[tuple[int, str, str]]) -> DataFrame:
    """Bars around events (event_key, symbol, date), day by day: spec holds (day offset, from HH:MM, to HH:MM), ends included, New York time."""
    from tideline.functions.time import market_time, minute_of_day

    minutes = lambda x: int(x[:2]) * 60 + int(x[3:])
    rows = F.array(*[F.struct(F.lit(d).alias("offset"), F.lit(minutes(a)).alias("a"), F.lit(minutes(b)).alias("b")) for d, a, b in spec])
    wanted = events.select("event_key", "symbol", "date", F.explode(rows).alias("w")).select("event_key", "symbol", F.date_add("date", F.col("w.offset")).alias("date"), "w.offset", "w.a", "w.b")
    et = market_time(F.col("timestamp"))
    own = bars.withColumn("date", F.to_date(et)).withColumn("__m", minute_of_day(et))
    return own.join(wanted, ["symbol", "date"]).where(F.col("__m").between(F.col("a"), F.col("b"))).drop("__m", "a", "b")


def as_of(left: DataFrame, right: DataFrame, columns: list[str], keys: tuple[str, ...] = ("symbol",), ts: str = "timestamp", order: str = "event_id") -> DataFrame:
    """left with the columns of the last right row at or before it: a union in time order and the last right row known, no product. At
    equal times the right row comes first. A key may hold most of the rows: its time is cut into parts, and what is known at the
    end of one is carried into the next."""
    a = left.select("*", *[F.lit(None).cast(right.schema[c].dataType).alias(f"__{c}") for c in columns], F.lit(1).alias("__side"))
    b = right.select(*keys, ts, order, *[F.col(c).alias(f"__{c}") for c in columns], F.lit(0).alias("__side"))
    both = a.unionByName(b, allowMissingColumns=True)
    packed = F.when(F.col("__side") == 0, F.struct(*[F.col(f"__{c}").alias(c) for c in columns]))
    known = last_known(both.withColumn("__packed", packed), keys, (ts, "__side", order), "__packed", "__last")
    out = known.where("__side = 1")
    return out.select(*left.columns, *[F.col(f"__last.{c}").alias(c) for c in columns])


def within_days(events: DataFrame, news: DataFrame, days: int = 1, as_of_time: Column | None = None) -> DataFrame:
    """News (symbol, published) within so many days of events (event_key, symbol, event_time); not later than as_of_time."""
    wanted = events.withColumn("__d", F.explode(F.sequence(F.date_sub(F.to_date("event_time"), days), F.date_add(F.to_date("event_time"), days))))
    out = news.withColumn("__d", F.to_date("published")).join(wanted, ["symbol", "__d"]).drop("__d")
    out = out.where(F.abs(F.unix_timestamp("published") - F.unix_timestamp("event_time")) <= 86400 * days)
    return out if as_of_time is None else out.where(F.col("published") <= as_of_time)


def with_market_cap(symbols: DataFrame, details: DataFrame, most: float = 2e9) -> DataFrame:
    """Symbols (ticker) with market_cap that have none known or one below `most`."""
    return symbols.join(details.select("ticker", "market_cap"), "ticker", "left").where(F.col("market_cap").isNull() | (F.col("market_cap") < most))


def restricted(df: DataFrame, to: DataFrame, key: str) -> DataFrame:
    """The rows of df whose key is among those of `to`."""
    return df.join(to.select(key).distinct(), key, "left_semi")


def cap_audit(symbols: DataFrame, details: DataFrame, most: float = 2e9) -> DataFrame:
    """One row: symbols (ticker) with and without a known market cap, below `most`, and at or over it."""
    cap = F.col("market_cap")
    return symbols.join(details.select("ticker", "market_cap"), "ticker", "left").agg(
        F.count("*").alias("n_symbols"), F.count_if(cap.isNotNull()).alias("n_with"), F.count_if(cap.isNull()).alias("n_without"), F.count_if(cap < most).alias("n_under"), F.count_if(cap >= most).alias("n_over")
    )


def missing(universe: DataFrame, available: DataFrame, key: str | list[str]) -> DataFrame:
    return universe.join(available.select(*([key] if isinstance(key, str) else key)).distinct(), key, "left_anti")


def coverage(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(side, n): how many keys are in both, only in a, only in b."""
    x = a.select(key).distinct().withColumn("__a", F.lit(True))
    y = b.select(key).distinct().withColumn("__b", F.lit(True))
    side = F.when(F.col("__a").isNull(), "right_only").when(F.col("__b").isNull(), "left_only").otherwise("both")
    return x.join(y, key, "full_outer").groupBy(side.alias("side")).agg(F.count("*").alias("n"))


def completeness(expected: DataFrame, done: DataFrame, key: str = "symbol") -> DataFrame:
    """Per key: expected and done events, percentage, is_complete."""
    e, d = expected.groupBy(key).agg(F.count("*").alias("expected")), done.groupBy(key).agg(F.count("*").alias("done"))
    out = e.join(d, key, "left").fillna(0, ["done"])
    return out.withColumn("pct", F.col("done") * 100.0 / F.col("expected")).withColumn("is_complete", F.col("done") >= F.col("expected"))
