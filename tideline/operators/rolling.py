"""Rolling and analytic window columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tideline.functions.scalars import EPS, ratio

from .scans import running_sum


def by_symbol() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("timestamp")


def by_day() -> WindowSpec:
    return Window.partitionBy("symbol", "date").orderBy("timestamp")


def by_daily() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("date")


def last_rows(w: WindowSpec, n: int) -> WindowSpec:
    """The current row and the n - 1 before it."""
    return w.rowsBetween(-(n - 1), 0)


def rows_before(w: WindowSpec, n: int) -> WindowSpec:
    """The n rows before the current one."""
    return w.rowsBetween(-n, -1)


def mean_at_least(c: str | Column, w: WindowSpec, k: int) -> Column:
    """Mean over a frame, null below k values."""
    return F.when(F.count(c).over(w) >= k, F.avg(c).over(w))


def nearest_quantile(c: str, w: WindowSpec, q: float, k: int = 1) -> Column:
    """Quantile of nearest rank over a short frame (its values are gathered)."""
    values = F.sort_array(F.collect_list(c).over(w))
    n = F.size(values)
    return F.when(n >= k, F.try_element_at(values, (F.round(F.lit(q) * (n - 1)) + 1).cast("int")))


def daily_metrics(bars: DataFrame, atr_window: int = 21) -> DataFrame:
    """Daily bars with gap_pct, ire_pct, rvol, tr, atr, atr_pct, low5, high5, drawdowns, dollar_volume, ssr."""
    before = F.lag("close").over(by_daily())
    out = bars.withColumn("prev_close", before)
    out = out.withColumn("gap_pct", ratio(F.col("open") - F.col("prev_close"), F.col("prev_close")) * 100).withColumn("ire_pct", ratio(F.col("high") - F.col("low"), F.col("open")) * 100)
    out = out.withColumn("avg_volume", mean_at_least("volume", last_rows(by_daily(), 20), 5)).withColumn("rvol", ratio(F.col("volume"), F.col("avg_volume")))
    out = out.withColumn("tr", F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("prev_close")), F.abs(F.col("low") - F.col("prev_close"))))
    out = out.withColumn("atr", mean_at_least("tr", last_rows(by_daily(), atr_window), atr_window // 2)).withColumn("atr_pct", ratio(F.col("atr"), F.col("close")) * 100)
    out = out.withColumn("low5", F.min("low").over(last_rows(by_daily(), 5))).withColumn("high5", F.max("high").over(last_rows(by_daily(), 5)))
    out = out.withColumn("drawdown_low_pct", ratio(F.col("low5") - F.col("close"), F.col("low5")) * 100).withColumn("drawdown_high_pct", ratio(F.col("high5") - F.col("close"), F.col("high5")) * 100)
    return out.withColumn("dollar_volume", F.col("close") * F.col("volume")).withColumn("ssr", F.coalesce(F.col("low") <= 0.9 * F.col("prev_close"), F.lit(False)))


def anchored_vwap(bars: DataFrame, reference: str = "RTH", session: str = "session", compat: bool = False) -> DataFrame:
    """bars with vwap_ref: volume-weighted typical price from the first bar of the day, or of regular hours. compat: the bar's own typical price in RTH."""
    tp = (F.col("high") + F.col("low") + F.col("close")) / 3
    if compat and reference == "RTH":
        return bars.withColumn("vwap_ref", F.when(F.col(session) == "RTH", tp))
    on = F.lit(True)
    running = by_day().rowsBetween(Window.unboundedPreceding, 0)
    if reference == "RTH":
        bars = bars.withColumn("__on", F.max(F.when(F.col(session) == "RTH", 1).otherwise(0)).over(running) == 1)
        on = F.col("__on")
    money, volume = F.sum(F.when(on, tp * F.col("volume"))).over(running), F.sum(F.when(on, F.col("volume"))).over(running)
    return bars.withColumn("vwap_ref", ratio(money, volume)).drop("__on")


def spike(bars: DataFrame, window: int = 20, method: str = "median", by: WindowSpec | None = None) -> DataFrame:
    """bars with base_volume and spike_x = volume over it."""
    w = last_rows(by or by_day(), window)
    base = F.percentile("volume", F.lit(0.5)).over(w) if method == "median" else F.avg("volume").over(w)
    return bars.withColumn("base_volume", base).withColumn("spike_x", ratio(F.col("volume"), F.col("base_volume")))


def rvol_excluding_today(days: int = 20, k: int = 5, by: WindowSpec | None = None) -> Column:
    return F.col("volume") / (mean_at_least("volume", rows_before(by or by_daily(), days), k) + EPS)


def rvol_same_minute(bars: DataFrame, sessions: int = 60, k: int = 1) -> DataFrame:
    """bars with rvol_minute: volume over the mean of the same minute in earlier sessions."""
    keyed = bars.withColumn("__m", F.hour("timestamp") * 60 + F.minute("timestamp"))
    w = Window.partitionBy("symbol", "__m").orderBy("date").rowsBetween(-sessions, -1)
    return keyed.withColumn("rvol_minute", ratio(F.col("volume"), mean_at_least("volume", w, k))).drop("__m")


def rvol_day(daily: DataFrame, days: int = 20) -> DataFrame:
    """daily with rvol_day (dollar volume over the mean of the `days` days before, which must all be there) and rvol_day_missing."""
    mean = mean_at_least("dollar_volume", rows_before(by_daily(), days), days)
    return daily.withColumn("rvol_day", ratio(F.col("dollar_volume"), mean)).withColumn("rvol_day_missing", F.col("rvol_day").isNull())


def average_rank_cdf(df: DataFrame, score: str = "score", by: tuple[str, ...] = ("event_type", "session")) -> DataFrame:
    """df without null scores; `score` becomes (average rank - 1) / (largest - 1) within its group (0.5 for a group of one rank), score_raw keeps it.

    Ranks are running counts of the different scores, so a group may be spread over all tasks.
    """
    out = df.where(F.col(score).isNotNull()).withColumnRenamed(score, "score_raw")
    ties = out.groupBy(*by, "score_raw").agg(F.count("*").alias("__n"))
    ranks = running_sum(ties, by, ("score_raw",), "__n", "__below").withColumn("__rank", F.col("__below") + 1 + (F.col("__n") - 1) / 2)
    top = ranks.groupBy(*by).agg(F.max("__rank").alias("__top"))
    same = lambda a, b, names: reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names])
    scaled = ranks.alias("r").join(top.alias("t"), same("r", "t", by)).select(*[f"r.{c}" for c in (*by, "score_raw")], F.when(F.col("__top") <= 1, 0.5).otherwise((F.col("__rank") - 1) / (F.col("__top") - 1)).alias("__scaled"))
    joined = out.alias("o").join(scaled.alias("s"), same("o", "s", (*by, "score_raw")))
    return joined.select(*[F.col(f"o.`{c}`") for c in out.columns], F.col("s.__scaled").alias(score))


def forward_metrics(bars: DataFrame, n: int = 5, by: WindowSpec | None = None) -> DataFrame:
    """bars with ret_fwd (close n rows on over close - 1) and max_run (highest high of the next n rows over close - 1)."""
    return bars.withColumn("ret_fwd", ratio(F.lead("close", n).over(by or by_daily()), F.col("close")) - 1).withColumn("max_run", ratio(F.max("high").over((by or by_daily()).rowsBetween(1, n)), F.col("close")) - 1)


def flat_base(bars: DataFrame, atr_window: int = 14, rvol_window: int = 30, quiet_days: int = 15) -> DataFrame:
    """Daily bars with is_quiet and is_flat_base: at least quiet_days of the last 20 days with ATR % at or below its own lower quartile and volume at or below 0.8 of its mean."""
    out = daily_metrics(bars, atr_window).withColumn("rvol30", ratio(F.col("volume"), mean_at_least("volume", last_rows(by_daily(), rvol_window), 10)))
    out = out.withColumn("p25", nearest_quantile("atr_pct", last_rows(by_daily(), 20), 0.25, 10))
    out = out.withColumn("is_quiet", F.coalesce((F.col("atr_pct") <= F.col("p25")) & (F.col("rvol30") <= 0.8), F.lit(False)))
    quiet = F.when(F.count("is_quiet").over(last_rows(by_daily(), 20)) >= 10, F.sum(F.col("is_quiet").cast("int")).over(last_rows(by_daily(), 20)))
    return out.withColumn("n_quiet", quiet).withColumn("is_flat_base", F.coalesce(F.col("n_quiet") >= quiet_days, F.lit(False)))


def changed_quotes(quotes: DataFrame, by: WindowSpec | None = None) -> DataFrame:
    """Quotes that differ from the one before in price or size on either side; the first stays."""
    by, differs = by or by_symbol(), F.lit(False)
    for c in ("bid_price", "ask_price", "bid_size", "ask_size"):
        same = F.col(c).eqNullSafe(F.lag(c).over(by))
        differs = differs | ~same
    out = quotes.withColumn("__keep", differs | (F.row_number().over(by) == 1))
    return out.where("__keep").drop("__keep")


def downsampled(ticks: DataFrame, n: Column, by: tuple[str, ...] = ("symbol",), order: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """n evenly spaced rows of each group: places int(i * rows / n); groups of n rows or fewer stay whole."""
    w = Window.partitionBy(*by)
    out = ticks.withColumn("__i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("__m", F.count("*").over(w)).withColumn("__n", n.cast("long"))
    place = F.ceil(F.col("__i") * F.col("__n") / F.col("__m"))
    keep = (F.col("__m") <= F.col("__n")) | (F.floor(place * F.col("__m") / F.col("__n")) == F.col("__i")) & (place < F.col("__n"))
    return out.where(keep).drop("__i", "__m", "__n")


def bucket_repeats(events: DataFrame, width: str = "10 minutes") -> DataFrame:
    """Groups of more than one event by symbol, type and time bucket."""
    return events.groupBy("symbol", "event_type", F.window("timestamp", width).start.alias("bucket")).agg(F.count("*").alias("n")).where("n > 1")
