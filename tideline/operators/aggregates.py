"""Grouped summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.quantiles import exact_quantiles, quantile_columns
from tideline.storage import saved

CAP_EDGES = (0.0, 5e7, 3e8, 2e9, 1e10)
CAP_NAMES = ("nano", "micro", "small", "mid", "large")



def side_by_side(*rows: DataFrame) -> DataFrame:
    """One-row frames as one row: a union whose columns are then taken together, no join."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def symbol_ranking(daily: DataFrame, n: int | None = None) -> DataFrame:
    """Symbols by number of events, with their statistics, days, event rate and rank; the first n of them."""
    events = daily.where("is_event").groupBy("symbol").agg(
        F.count("*").alias("n_events"), F.sum(F.col("ssr").cast("int")).alias("n_ssr_events"), F.avg("gap_pct").alias("mean_gap"), F.max("gap_pct").alias("max_gap"),
        F.avg("rvol").alias("mean_rvol"), F.max("rvol").alias("max_rvol"), F.avg("atr_pct").alias("mean_atr"), F.avg("dollar_volume").alias("mean_dollar_volume"),
    )
    days = daily.groupBy("symbol").agg(F.count("*").alias("total_days"))
    out = events.join(days, "symbol", "left").withColumn("event_rate_pct", F.col("n_events") * 100.0 / F.col("total_days"))
    order = (F.desc("n_events"), F.desc("event_rate_pct"), F.asc("symbol"))
    if n is not None:
        out = out.orderBy(*order).limit(n)
    return out.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # one row per symbol


def opening_range(bars: DataFrame, minutes: int = 15) -> DataFrame:
    from tideline.functions.time import market_time, minute_of_day

    m = minute_of_day(market_time(F.col("timestamp")))
    return bars.where(m.between(570, 570 + minutes - 1)).groupBy("symbol", "date").agg(F.max("high").alias("or_high"), F.min("low").alias("or_low"))


def monthly_density(events: DataFrame, date: str = "date") -> DataFrame:
    return events.groupBy(F.date_format(date, "yyyy-MM").alias("month")).agg(F.count("*").alias("n_events"))


def top_symbols(events: DataFrame, n: int = 20) -> DataFrame:
    return events.groupBy("symbol").agg(F.count("*").alias("n_events")).orderBy(F.desc("n_events"), "symbol").limit(n)


def branch_breakdown(daily: DataFrame, branches: tuple[str, ...] = ("is_gap", "is_ire", "is_vswg", "is_atr", "is_flush")) -> DataFrame:
    """(branch, n, pct) among the events."""
    row = daily.where("is_event").agg(F.count("*").alias("total"), *[F.count_if(F.col(b)).alias(b) for b in branches])
    pairs = ", ".join(f"'{b}', {b}" for b in branches)
    return row.selectExpr("total", f"stack({len(branches)}, {pairs}) as (branch, n)").withColumn("pct", F.try_divide(F.col("n") * 100.0, F.col("total"))).drop("total")


def distribution(events: DataFrame, column: str) -> DataFrame:
    """(value, n, pct) of a column."""
    counts = events.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


def top_concentration(events: DataFrame, n: int = 20) -> DataFrame:
    """Share of the n busiest symbols in all events."""
    top = top_symbols(events, n).agg(F.sum("n_events").alias("top"))
    return side_by_side(top, events.agg(F.count("*").alias("total"))).select("top", "total", F.try_divide("top", "total").alias("share"))


def window_extent(events: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Per symbol the span of its events in epoch ms; given bounds go first."""
    ms = lambda c: (F.unix_micros(c) / 1000).cast("long")
    return events.groupBy("symbol").agg((F.lit(start) if start is not None else ms(F.min("timestamp"))).alias("ts_start"), (F.lit(end) if end is not None else ms(F.max("timestamp"))).alias("ts_end"))


def daily_rate(events: DataFrame) -> DataFrame:
    """Median, p95 and maximum of the events per symbol-day."""
    n = saved(events.groupBy("symbol", "date").agg(F.count("*").alias("n")), "daily-counts")
    found = exact_quantiles(n, {"n": (0.5, 0.95)})
    return n.agg(F.max("n").alias("max")).select(*quantile_columns(found, "n", ((0.5, "median"), (0.95, "p95"))), "max")


def outliers(events: DataFrame, columns: tuple[str, ...] = ("spike_x", "dollar_volume")) -> DataFrame:
    """(metric, median, p95, p99, max) and alerts: spikes over 500 times, a median dollar volume under 50k."""
    events, names = saved(events.select(*columns), "outliers"), ((0.5, "median"), (0.95, "p95"), (0.99, "p99"))
    found = exact_quantiles(events, {c: (0.5, 0.95, 0.99) for c in columns})
    arms = [F.struct(F.lit(c).alias("metric"), *quantile_columns(found, c, names), F.max(F.col(c).cast("double")).alias("max")) for c in columns]
    out = events.agg(F.array(*arms).alias("x")).select(F.explode("x").alias("x")).select("x.*")
    return out.withColumn("alert", F.when(F.col("metric") == "spike_x", F.col("max") > 500).otherwise(F.col("median") < 50_000))


def distinct_counts(events: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return events.agg(count("symbol").alias("n_symbols"), (count(F.struct("symbol", "timestamp", "event_type")) if approximate else F.count_distinct("symbol", "timestamp", "event_type")).alias("n_keys"), F.count("*").alias("n_rows"))


def duplicate_rate(events: DataFrame, by: str | None = None, key: tuple[str, ...] = ("symbol", "timestamp", "event_type")) -> DataFrame:
    """Rows, distinct keys, duplicates, percentage and status, over all or per `by` (a run, a file)."""
    grouped = events.groupBy(by) if by else events.groupBy()
    out = grouped.agg(F.count("*").alias("total"), F.count_distinct(*key).alias("n_unique"))
    out = out.withColumn("duplicates", F.col("total") - F.col("n_unique")).withColumn("pct", F.try_divide(F.col("duplicates") * 100.0, F.col("total")))
    return out.withColumn("status", F.when(F.col("pct") < 5, "OK").when(F.col("pct") < 10, "WARNING").otherwise("CRITICAL"))


def worst_duplicates(events: DataFrame, n: int = 10, key: tuple[str, ...] = ("symbol", "timestamp", "event_type")) -> DataFrame:
    groups = events.groupBy(*key).agg(F.count("*").alias("c")).where("c > 1")
    return groups.groupBy("symbol").agg(F.sum(F.col("c") - 1).alias("extra"), F.count("*").alias("n_groups")).orderBy(F.desc("extra"), "symbol").limit(n)


def modal_tier(events: DataFrame) -> DataFrame:
    """Per symbol its most frequent tier (ties: the smallest)."""
    counts = events.groupBy("symbol", "tier").agg(F.count("*").alias("c"))
    return counts.groupBy("symbol").agg(F.max_by("tier", F.struct("c", -F.col("tier"))).alias("tier"))


def tier_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("tier").agg(F.count("*").alias("n"), F.count_distinct("symbol").alias("n_symbols"))


def cap_brackets(details: DataFrame, edges: tuple[float, ...] = CAP_EDGES, names: tuple[str, ...] = CAP_NAMES) -> DataFrame:
    """(bracket, n, pct) over half-open brackets; empty ones are there with 0; unknown caps are left out."""
    bracket = F.lit(names[0])
    for e, name in zip(edges[1:], names[1:]):
        bracket = F.when(F.col("market_cap") >= e, name).otherwise(bracket)
    counts = details.where("market_cap is not null").groupBy(bracket.alias("bracket")).agg(F.count("*").alias("n"))
    every = details.sparkSession.createDataFrame([(n,) for n in names], "bracket string")
    out = every.join(counts, "bracket", "left").fillna(0, ["n"])
    return out.withColumn("pct", F.try_divide(F.col("n") * 100.0, F.sum("n").over(Window.partitionBy())))


def cap_summary(details: DataFrame, most: float = 2e9) -> DataFrame:
    c, median = F.col("market_cap"), quantile_columns(exact_quantiles(details, {"market_cap": (0.5,)}), "market_cap", ((0.5, "median"),))
    return details.agg(F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), *median, F.count_if(c < most).alias("n_small"), F.count_if(c.isNull()).alias("n_unknown"))


def score_report(events: DataFrame) -> DataFrame:
    s, events = F.col("score"), saved(events.select("score"), "scores")
    found = exact_quantiles(events, {"score": (0.25, 0.5, 0.75, 0.9)})
    return events.agg(
        F.min(s).alias("min"), F.max(s).alias("max"), F.avg(s).alias("mean"), *quantile_columns(found, "score", ((0.25, "p25"), (0.5, "median"), (0.75, "p75"), (0.9, "p90"))),
        *[F.avg((s >= t).cast("double")).alias(f"share_{int(t * 100)}") for t in (0.6, 0.7, 0.8)],
    )


def dividends(actions: DataFrame, n: int = 20) -> DataFrame:
    out = actions.where("type = 'dividend'").groupBy("symbol").agg(F.count("*").alias("n_dividends"), F.sum("cash_amount").alias("cash"))
    return out.orderBy(F.desc("cash"), "symbol").limit(n)


def describe(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(metric, count, mean, stddev, min, p25, p50, p75, max) of numeric columns."""
    df = saved(df.select(*columns), "described")
    found = exact_quantiles(df, {c: (0.25, 0.5, 0.75) for c in columns})
    arms = [F.struct(F.lit(c).alias("metric"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev(F.col(c).cast("double")).alias("stddev"), F.min(F.col(c).cast("double")).alias("min"), *quantile_columns(found, c, ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))), F.max(F.col(c).cast("double")).alias("max")) for c in columns]
    return df.agg(F.array(*arms).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def first_events(events: DataFrame) -> DataFrame:
    """The earliest event of each symbol (ties: by type)."""
    w = Window.partitionBy("symbol").orderBy("timestamp", "event_type")
    return events.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def coverage_span(events: DataFrame) -> DataFrame:
    us = F.unix_micros(F.max("timestamp")) - F.unix_micros(F.min("timestamp"))
    return events.groupBy("symbol").agg(F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"), F.count("*").alias("n"), (us / 86_400_000_000).alias("span_days"))


def file_completeness(files: DataFrame) -> DataFrame:
    """files (symbol, event_key, kind: trades or quotes): events per symbol with both files, or one only."""
    per = files.groupBy("symbol", "event_key").agg(F.count_distinct("kind").alias("k"))
    return per.groupBy("symbol").agg(F.count_if(F.col("k") >= 2).alias("complete"), F.count_if(F.col("k") == 1).alias("partial"))
