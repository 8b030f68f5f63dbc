"""Halts (inferred and official), short-sale restrictions and liquidity tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.config import LiquidityConfig
from tideline.functions.scalars import EPS, body_ratio, ratio
from tideline.functions.time import clock_session, market_time

from .joins import in_intervals
from .rolling import by_symbol, by_daily, last_rows, mean_at_least, nearest_quantile, rows_before


def with_inferred_halts(bars: DataFrame, gap: float = 0.20, volume_x: float = 10.0, drought: float = 0.1) -> DataFrame:
    """bars with halt_flat, halt_gap, halt_sequence, halt_drought and halt_like, any of them (three-valued)."""
    before, volume = F.lag("close").over(by_symbol()), F.lag("volume").over(by_symbol())
    out = bars.withColumn("halt_flat", (F.col("high") == F.col("low")) & (F.col("volume") == 0))
    out = out.withColumn("halt_gap", (F.abs(F.col("open") - before) / (before + EPS) > gap) & (F.col("volume") / (volume + EPS) > volume_x))
    three = last_rows(by_symbol(), 3)
    out = out.withColumn("halt_sequence", (F.count("*").over(three) == 3) & (F.sum(F.col("halt_flat").cast("int")).over(three) == 3))
    usual = mean_at_least("volume", rows_before(by_symbol(), 20), 5)
    out = out.withColumn("halt_drought", (F.col("volume") < drought * usual) & (usual > 0))
    return out.withColumn("halt_like", F.col("halt_flat") | F.col("halt_gap") | F.col("halt_sequence") | F.col("halt_drought"))


def with_official_halts(bars: DataFrame, halts: DataFrame) -> DataFrame:
    """bars with halt_official: the bar lies in a halt of its symbol, an open one lasting an hour; both ends count."""
    spans = halts.select("symbol", F.col("halt_timestamp").alias("start"), F.coalesce("resume_timestamp", F.col("halt_timestamp") + F.expr("interval 1 hour")).alias("end"))
    hit = in_intervals(bars.select("symbol", "timestamp").distinct(), spans).select("symbol", "timestamp", F.lit(True).alias("halt_official"))
    return bars.join(hit, ["symbol", "timestamp"], "left").withColumn("halt_official", F.coalesce("halt_official", F.lit(False)))


def with_halt_window(bars: DataFrame, flag: str, before: int = 15, after: int = 14) -> DataFrame:
    """bars with in_halt_window: a flagged bar stands within `after` rows before or `before` rows behind this one."""
    return bars.withColumn("in_halt_window", F.coalesce(F.max(F.col(flag)).over(by_symbol().rowsBetween(-after, before)), F.lit(False)))


def detect_halts(bars: DataFrame, halts: DataFrame | None = None) -> DataFrame:
    out = with_inferred_halts(bars)
    out = with_official_halts(out, halts) if halts is not None else out.withColumn("halt_official", F.lit(False))
    return with_halt_window(out.withColumn("is_halt", F.coalesce("halt_like", F.lit(False)) | F.col("halt_official")), "is_halt")


def with_previous_close(bars: DataFrame) -> DataFrame:
    """Intraday bars with the close of the symbol's day before."""
    last = bars.groupBy("symbol", "date").agg(F.max_by("close", "timestamp").alias("__c"))
    last = last.select("symbol", "date", F.lag("__c").over(by_daily()).alias("previous_close"))
    return bars.join(last, ["symbol", "date"], "left")


def ssr_intraday(bars: DataFrame, drop_pct: float = 10.0, rth_only: bool = True, compat: bool = False) -> DataFrame:
    """bars with ssr_trigger and ssr_active: from the trigger on, and on the next day the symbol trades. compat: for two calendar days."""
    out = with_previous_close(bars)
    trigger = F.col("close") <= (1 - drop_pct / 100) * F.col("previous_close")
    if rth_only:
        trigger = trigger & (clock_session(market_time(F.col("timestamp"))) == "rth")
    out = out.withColumn("ssr_trigger", F.coalesce(trigger, F.lit(False)))
    last = F.last(F.when(F.col("ssr_trigger"), F.col("timestamp")), ignorenulls=True).over(by_symbol().rowsBetween(Window.unboundedPreceding, 0))
    out = out.withColumn("ssr_since", last)
    if compat:
        return out.withColumn("ssr_active", F.coalesce(F.datediff("timestamp", "ssr_since") <= 2, F.lit(False)))
    days = out.groupBy("symbol", "date").agg(F.max("ssr_trigger").alias("__t")).select("symbol", "date", F.coalesce(F.lag("__t").over(by_daily()), F.lit(False)).alias("ssr_day_before"))
    out = out.join(days, ["symbol", "date"])
    return out.withColumn("ssr_active", F.coalesce(F.to_date("ssr_since") == F.col("date"), F.lit(False)) | F.col("ssr_day_before"))


def ssr_daily(daily: DataFrame, compat: bool = False) -> DataFrame:
    """daily with ssr_day and ssr_next (the day before triggered; compat: the day after does)."""
    hit = F.coalesce(F.col("low") <= 0.9 * F.lag("close").over(by_daily()), F.lit(False))
    out = daily.withColumn("ssr_day", hit)
    return out.withColumn("ssr_next", F.coalesce((F.lead if compat else F.lag)("ssr_day").over(by_daily()), F.lit(False)))


def dollar_volume_threshold(session: Column, price: Column, cfg: LiquidityConfig) -> Column:
    return F.when(session == "premarket", cfg.premarket).when(session == "postmarket", cfg.postmarket).when((session == "rth") & (price < cfg.low_price), cfg.rth_low_price).otherwise(cfg.rth)


def with_liquidity(bars: DataFrame, cfg: LiquidityConfig = LiquidityConfig(), halt: str | None = None, intraday_rvol: bool = False) -> DataFrame:
    """bars with pass_dollar_volume, pass_spread, pass_activity, pass_price, pass_halt (pass_rvol) and liquidity_pass, their AND."""
    out = bars.withColumn("liq_session", clock_session(market_time(F.col("timestamp"))))
    out = out.withColumn("dollar_volume", F.col("volume") * F.col("vwap"))
    out = out.withColumn("pass_dollar_volume", F.col("dollar_volume") >= dollar_volume_threshold(F.col("liq_session"), F.col("close"), cfg))
    out = out.withColumn("spread_proxy", (F.col("high") - F.col("low")) / (F.col("vwap") + EPS)).withColumn("spread_p95", nearest_quantile("spread_proxy", last_rows(by_symbol(), cfg.spread_window), cfg.spread_quantile))
    out = out.withColumn("body", body_ratio()).withColumn("wicky", (F.col("spread_p95") > cfg.max_spread) & (F.col("body") < cfg.min_body))
    out = out.withColumn("pass_spread", (F.col("spread_p95") <= cfg.max_spread) | ~F.col("wicky"))
    active = F.sum((F.col("volume") > 0).cast("int")).over(last_rows(by_symbol(), cfg.activity_window)) / cfg.activity_window
    out = out.withColumn("activity", active).withColumn("pass_activity", F.col("activity") >= cfg.min_activity)
    out = out.withColumn("pass_price", F.col("close").between(cfg.min_price, cfg.max_price)).withColumn("pass_halt", ~F.col(halt) if halt else F.lit(True))
    tests = ["pass_dollar_volume", "pass_spread", "pass_activity", "pass_price", "pass_halt"]
    if cfg.max_spread_z:  # the spread against its symbol's rows before, in deviations
        past = rows_before(by_symbol(), cfg.activity_window)
        out = out.withColumn("spread_z", ratio(F.col("spread_proxy") - F.avg("spread_proxy").over(past), F.stddev_pop("spread_proxy").over(past)))
        out = out.withColumn("pass_spread_z", F.coalesce(F.col("spread_z") <= cfg.max_spread_z, F.lit(True)))
        tests.append("pass_spread_z")
    if intraday_rvol:
        rvol = F.col("volume") / (mean_at_least("volume", rows_before(by_symbol(), cfg.rvol_bars), 10) + EPS)
        out = out.withColumn("rvol_intraday", rvol).withColumn("pass_rvol", F.col("rvol_intraday") >= cfg.min_rvol)
        tests.append("pass_rvol")
    ok = F.lit(True)
    for t in tests:
        ok = ok & F.col(t)
    return out.withColumn("liquidity_pass", ok)


def liquidity_breakdown(flagged: DataFrame) -> DataFrame:
    """One row: rows, those that pass, fail and are undecided (a null test), and how often each test fails."""
    tests = [c for c in flagged.columns if c.startswith("pass_")]
    return flagged.agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("liquidity_pass")).alias("n_pass"), F.count_if(~F.col("liquidity_pass")).alias("n_fail"), F.count_if(F.col("liquidity_pass").isNull()).alias("n_null"),
        *[F.count_if(~F.col(t)).alias(t.replace("pass_", "fail_")) for t in tests],
    )
