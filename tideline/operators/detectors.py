"""Event detectors on daily and intraday bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.config import DailyConfig, IntradayConfig
from tideline.functions.scalars import daily_event_id, ratio, with_labels
from tideline.functions.time import market_time, minute_of_day, session_of

from .rolling import by_day, by_symbol, anchored_vwap, daily_metrics, last_rows, rows_before, spike


def _yes(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def daily_events(bars: DataFrame, cfg: DailyConfig = DailyConfig()) -> DataFrame:
    """Every symbol-day with its metrics, the five branches, is_event and event_id; symbols with fewer days than cfg asks for go."""
    whole = Window.partitionBy("symbol")
    out = daily_metrics(bars, cfg.atr_window).withColumn("__days", F.count("*").over(whole)).where(F.col("__days") >= cfg.min_trading_days).drop("__days")
    p = F.when(F.count("atr_pct").over(whole) >= cfg.atr_min_values, F.percentile("atr_pct", F.lit(cfg.atr_percentile)).over(whole)).otherwise(F.lit(cfg.atr_fallback))
    out = out.withColumn("atr_p", p)
    rvol, gap = F.col("rvol"), F.col("gap_pct")
    drawdown = F.col("drawdown_low_pct" if cfg.compat else "drawdown_high_pct")
    branches = {
        "is_gap": (gap >= cfg.gap_pct) & (rvol >= cfg.rvol),
        "is_ire": (F.col("ire_pct") >= cfg.ire_pct) & (rvol >= cfg.rvol),
        "is_vswg": (rvol >= cfg.rvol_vswg) & (gap >= cfg.gap_vswg_min),
        "is_atr": (F.col("atr_pct") >= F.col("atr_p")) & (rvol >= cfg.rvol_alt),
        "is_flush": (F.col("close") > F.col("open")) & (rvol >= cfg.rvol_flush) & (drawdown >= cfg.drawdown_flush),
    }
    for name, rule in branches.items():
        out = out.withColumn(name, _yes(rule))
    hit = F.greatest(*[F.col(n) for n in branches]) & _yes(F.col("dollar_volume") >= cfg.min_dollar_volume)
    if cfg.bullish_only:
        hit = hit & _yes((F.col("close") > F.col("open")) & (gap >= 0))
    return out.withColumn("is_event", hit).withColumn("event_id", daily_event_id(F.col("is_event"), F.col("date")))


def two_branch_events(bars: DataFrame, gap: float = 5.0, rvol: float = 2.0, rvol_alt: float = 1.8, min_dollar_volume: float = 600_000, cfg: DailyConfig = DailyConfig()) -> DataFrame:
    """The older preset: a gap either way with volume, or ATR % over its percentile with volume; and dollar volume."""
    whole = Window.partitionBy("symbol")
    out = daily_metrics(bars, cfg.atr_window).withColumn("atr_p", F.percentile("atr_pct", F.lit(cfg.atr_percentile)).over(whole))
    rule = ((F.abs("gap_pct") >= gap) & (F.col("rvol") >= rvol)) | ((F.col("atr_pct") >= F.col("atr_p")) & (F.col("rvol") >= rvol_alt))
    return out.withColumn("is_event", _yes(rule) & _yes(F.col("dollar_volume") >= min_dollar_volume))


def premarket_dollar_volume(events: DataFrame, hourly: DataFrame, hours: tuple[int, ...] = (7, 8)) -> DataFrame:
    """events (symbol, date) with pm_dollar_volume: price times volume of the bars in those New York hours, 0 where there is none."""
    et = market_time(F.col("timestamp"))
    price = F.coalesce("vwap", "close") if "vwap" in hourly.columns else F.col("close")
    sums = hourly.where(F.hour(et).isin(*hours)).groupBy("symbol", F.to_date(et).alias("date")).agg(F.sum(price * F.col("volume")).alias("pm_dollar_volume"))
    return events.join(sums, ["symbol", "date"], "left").fillna(0.0, ["pm_dollar_volume"])


def premarket_gate(events: DataFrame, hourly: DataFrame, minimum: float = 50_000, hours: tuple[int, ...] = (7, 8)) -> DataFrame:
    """events (symbol, date, is_event) with pm_ok, and is_event only where it holds: enough premarket dollar volume, or no premarket bar at all."""
    et = market_time(F.col("timestamp"))
    price = F.coalesce("vwap", "close") if "vwap" in hourly.columns else F.col("close")
    flags = hourly.where(F.hour(et).isin(*hours)).groupBy("symbol", F.to_date(et).alias("date")).agg((F.sum(price * F.col("volume")) >= minimum).alias("pm_ok"))
    out = events.join(flags, ["symbol", "date"], "left").withColumn("pm_ok", F.coalesce("pm_ok", F.lit(True)))
    return out.withColumn("is_event", F.col("is_event") & F.col("pm_ok"))


def intraday_columns(bars: DataFrame, cfg: IntradayConfig = IntradayConfig()) -> DataFrame:
    """All columns the intraday detectors need: one exchange by symbol and day, one sort.

    Bars are (symbol, timestamp, date, open, high, low, close, volume). Symbol-days with fewer bars than cfg.min_bars go.
    """
    clock = F.col("timestamp") if cfg.compat else market_time(F.col("timestamp"))
    out = bars.withColumn("session", session_of(clock, "RTH" if cfg.compat else "CLOSED")).withColumn("minute", minute_of_day(clock))
    out = out.withColumn("__n", F.count("*").over(Window.partitionBy("symbol", "date"))).where(F.col("__n") >= cfg.min_bars).drop("__n")
    out = spike(out, cfg.spike_window, cfg.spike_method)
    out = anchored_vwap(out, cfg.vwap_reference, compat=cfg.compat)
    out = out.withColumn("range_pct", ratio(F.col("high") - F.col("low"), F.col("open")) * 100).withColumn("dollar_volume", F.col("close") * F.col("volume"))
    out = out.withColumn("volume_x", ratio(F.col("volume"), F.avg("volume").over(last_rows(by_day(), 20))))
    out = out.withColumn("vwap_dist_pct", ratio(F.col("close") - F.col("vwap_ref"), F.col("vwap_ref")) * 100)
    out = out.withColumn("ret_pct", (ratio(F.col("close"), F.lag("close", cfg.momentum_window).over(by_day())) - 1) * 100)
    span = last_rows(by_day(), 20) if cfg.compat else rows_before(by_day(), 20)
    out = out.withColumn("high20", F.max("high").over(span)).withColumn("low20", F.min("low").over(span))
    base = last_rows(by_day(), cfg.base_window)
    out = out.withColumn("base_high", F.max("high").over(base)).withColumn("base_low", F.min("low").over(base))
    typical = F.percentile(F.col("high") - F.col("low"), F.lit(0.5)).over(base)
    calm = ratio(F.col("base_high") - F.col("base_low"), F.col("open")) * 100 <= cfg.base_range_multiple * typical * 100
    out = out.withColumn("calm", _yes(calm))
    for c in ("calm", "base_high", "base_low"):
        out = out.withColumn(f"prev_{c}", F.lag(c).over(by_day()))
    whole, opening = Window.partitionBy("symbol", "date"), F.col("minute").between(570, 570 + cfg.or_minutes - 1)
    out = out.withColumn("or_high", F.max(F.when(opening, F.col("high"))).over(whole)).withColumn("or_low", F.min(F.when(opening, F.col("low"))).over(whole)).withColumn("in_or", opening)
    out = out.withColumn("day_high", F.max("high").over(by_day().rowsBetween(Window.unboundedPreceding, 0))).withColumn("drop_pct", ratio(F.col("day_high") - F.col("close"), F.col("day_high")) * 100)
    out = out.withColumn("red_bars", F.sum((F.col("close") < F.col("open")).cast("int")).over(last_rows(by_day(), cfg.flush_red_bars)))
    return _optional_columns(out, cfg)


def _optional_columns(out: DataFrame, cfg: IntradayConfig) -> DataFrame:
    """The columns of those options that cfg turns on, over the same partitions and order."""
    red, below = F.col("close") < F.col("open"), F.col("close") < F.col("vwap_ref")
    if cfg.flush_window:
        out = out.withColumn("day_high", F.max("high").over(last_rows(by_day(), cfg.flush_window))).withColumn("drop_pct", ratio(F.col("day_high") - F.col("close"), F.col("day_high")) * 100)
    if cfg.bearish_red_bars:
        out = out.withColumn("bearish", consecutive(red, cfg.bearish_red_bars))
    if cfg.vwap_up_bars > 1:
        out = out.withColumn("held_above", consecutive(F.col("close") > F.col("vwap_ref"), cfg.vwap_up_bars))
    if cfg.vwap_down_bars > 1:
        out = out.withColumn("held_below", consecutive(below, cfg.vwap_down_bars))
    if cfg.failed_reclaim_bars:
        touched = F.max((below & (F.col("high") >= F.col("vwap_ref"))).cast("int")).over(last_rows(by_day(), cfg.failed_reclaim_bars))
        out = out.withColumn("failed_reclaim", _yes(touched == 1))
    if cfg.min_acceleration:
        out = out.withColumn("acceleration", ratio(F.abs("ret_pct"), F.abs(F.lag("ret_pct", cfg.momentum_window).over(by_day()))))
    if cfg.tape_transactions:
        usual = F.percentile("transactions", F.lit(0.5)).over(last_rows(by_day(), cfg.spike_window))
        out = out.withColumn("tape_x", ratio(F.col("transactions"), usual))
    if cfg.full_score:
        three = last_rows(by_day(), 3)
        ups = F.sum((F.col("close") > F.col("open")).cast("int")).over(three)
        out = out.withColumn("same_bars", F.when(F.col("close") > F.col("open"), ups).otherwise(F.count("*").over(three) - ups))
    return out


def rules(cfg: IntradayConfig) -> list[tuple[str, str, Column]]:
    """(event type, direction, condition) over the columns of intraday_columns."""
    rth = F.col("session") == "RTH"
    spiked = (F.col("spike_x") >= F.when(rth, cfg.rth_spike).otherwise(cfg.ext_spike)) & (F.col("volume") >= F.when(rth, cfg.rth_volume).otherwise(cfg.ext_volume))
    spiked &= (F.col("dollar_volume") >= F.when(rth, cfg.rth_dollar_volume).otherwise(cfg.ext_dollar_volume)) & (F.col("range_pct") >= cfg.min_range_pct)
    up = F.col("close") > F.col("open")
    after_or = ~F.col("in_or") & (F.col("minute") < 960) & (F.lit(True) if cfg.compat else F.col("minute") >= 570 + cfg.or_minutes)
    broke_or = after_or & (F.col("volume_x") >= cfg.or_volume)
    calm = F.col("prev_calm") & (F.col("volume_x") >= cfg.base_volume)
    on = F.lit(True)
    bearish = F.col("bearish") & (F.col("drop_pct") >= cfg.bearish_drop_pct) if cfg.bearish_red_bars else on
    above, under = F.col("held_above") if cfg.vwap_up_bars > 1 else on, F.col("held_below") if cfg.vwap_down_bars > 1 else on
    if cfg.failed_reclaim_bars:
        under = under & F.col("failed_reclaim")
    faster = F.col("acceleration") >= cfg.min_acceleration if cfg.min_acceleration else on
    tape = [("tape_speed", d, (F.col("transactions") >= cfg.tape_transactions) & (F.col("tape_x") >= cfg.tape_spike) & w) for d, w in (("up", up), ("down", ~up))] if cfg.tape_transactions else []
    return tape + [
        ("volume_spike", "up", spiked & up),
        ("volume_spike", "down", spiked & ~up & bearish),
        ("vwap_break", "up", (F.col("vwap_dist_pct") >= cfg.vwap_up_pct) & (F.col("volume_x") >= cfg.vwap_up_volume) & above),
        ("vwap_break", "down", (F.col("vwap_dist_pct") <= -cfg.vwap_down_pct) & (F.col("volume_x") >= cfg.vwap_down_volume) & under),
        ("price_momentum", "up", (F.col("ret_pct") >= cfg.momentum_up_pct) & (F.col("volume_x") >= cfg.momentum_volume) & (F.col("close") > F.col("high20"))),
        ("price_momentum", "down", (F.col("ret_pct") <= -cfg.momentum_down_pct) & (F.col("volume_x") >= cfg.momentum_volume) & (F.col("close") < F.col("low20")) & faster),
        ("consolidation_break", "up", calm & (ratio(F.col("close") - F.col("prev_base_high"), F.col("prev_base_high")) * 100 >= cfg.base_break_pct)),
        ("consolidation_break", "down", calm & (ratio(F.col("prev_base_low") - F.col("close"), F.col("prev_base_low")) * 100 >= cfg.base_break_pct)),
        ("opening_range_break", "up", broke_or & (ratio(F.col("close") - F.col("or_high"), F.col("or_high")) * 100 >= cfg.or_break_pct)),
        ("opening_range_break", "down", broke_or & (ratio(F.col("or_low") - F.col("close"), F.col("or_low")) * 100 >= cfg.or_break_pct)),
        ("flush", "down", (F.col("drop_pct") >= cfg.flush_drop_pct) & (F.col("volume_x") >= cfg.flush_volume) & (F.col("red_bars") >= cfg.flush_red_bars)),
    ]


def score(full: bool = False) -> Column:
    """0.3 of the spike, 0.25 of the range in percent, and 0.2; full: also 0.15 of the last three bars' count that went the same way,
    and 0.1 of the distance from the VWAP in percent."""
    out = 0.3 * F.coalesce("spike_x", F.lit(1.0)) + 0.25 * F.coalesce("range_pct", F.lit(0.0)) + 0.2
    return out + 0.15 * F.col("same_bars") + 0.1 * F.coalesce(F.abs("vwap_dist_pct"), F.lit(0.0)) if full else out


def detected(bars: DataFrame, cfg: IntradayConfig = IntradayConfig(), types: tuple[str, ...] | None = None) -> DataFrame:
    """One row per bar and rule it meets: all rules on one scan of the shared columns."""
    chosen = [r for r in rules(cfg) if types is None or r[0] in types]
    hits = F.filter(F.array(*[F.when(_yes(rule), F.struct(F.lit(t).alias("event_type"), F.lit(d).alias("direction"))) for t, d, rule in chosen]), lambda x: x.isNotNull())
    out = intraday_columns(bars, cfg).withColumn("__hit", F.explode(hits)).select("*", "__hit.event_type", "__hit.direction").drop("__hit")
    return out.withColumn("score", score(cfg.full_score))


def global_filters(bars: DataFrame, min_price: float = 1.0, max_price: float = 500.0, min_dollar_volume_day: float = 0.0, sessions: tuple[str, ...] | None = None) -> DataFrame:
    """Bars within the price range, of symbol-days with enough dollar volume, in the given sessions (New York time)."""
    day = F.sum(F.col("close") * F.col("volume")).over(Window.partitionBy("symbol", "date"))
    out = bars.withColumn("__dv", day).where(F.col("close").between(min_price, max_price) & (F.col("__dv") >= min_dollar_volume_day)).drop("__dv")
    return out.where(session_of(market_time(F.col("timestamp"))).isin(*sessions)) if sessions else out


def consecutive(condition: Column, n: int) -> Column:
    """Whether a condition held in the last n bars of the symbol-day."""
    w = last_rows(by_day(), n)
    return (F.sum(_yes(condition).cast("int")).over(w) == n) & (F.count("*").over(w) == n)


def best_per_bucket(events: DataFrame, minutes: int = 10, compat: bool = False, keep_within_pct: float = 0.0) -> DataFrame:
    """The highest score of each symbol, type and time bucket (ties: earliest, then up before down). compat: of each symbol, type and day.

    keep_within_pct: rows that come within so many percent of their bucket's best stay as well.
    """
    bucket = F.col("date") if compat else F.floor(F.unix_timestamp("timestamp") / (60 * minutes))
    w = Window.partitionBy("symbol", "event_type", "__b").orderBy(F.desc_nulls_last("score"), "timestamp", F.desc("direction"))
    return events.withColumn("__b", bucket).withColumn("__r", F.row_number().over(w)).withColumn("__top", F.max("score").over(Window.partitionBy("symbol", "event_type", "__b"))).where((F.col("__r") == 1) | (F.lit(keep_within_pct > 0) & (F.col("score") >= F.col("__top") * (1 - keep_within_pct / 100)))).drop("__b", "__r", "__top")


def with_cooldown(events: DataFrame, minutes: int) -> DataFrame:
    """Events that come at least `minutes` after the last accepted one of their symbol, day and type: a fold over each day's sorted times."""
    step = minutes * 60
    times = F.sort_array(F.collect_set(F.unix_timestamp("timestamp")))
    fold = F.aggregate(times, F.array().cast("array<bigint>"), lambda kept, t: F.when((F.size(kept) == 0) | (t - F.element_at(kept, -1) >= step), F.concat(kept, F.array(t))).otherwise(kept))
    kept = events.groupBy("symbol", "date", "event_type").agg(fold.alias("__kept"))
    out = events.join(kept, ["symbol", "date", "event_type"])
    return out.where(F.array_contains("__kept", F.unix_timestamp("timestamp"))).drop("__kept")


def intraday_events(bars: DataFrame, cfg: IntradayConfig = IntradayConfig()) -> DataFrame:
    """All detectors, scored, one per bucket, labelled; with cooldown and a cap per symbol-day where cfg asks for them."""
    out = best_per_bucket(detected(bars, cfg), cfg.dedup_minutes, cfg.compat)
    if cfg.cooldown_minutes:
        out = with_cooldown(out, cfg.cooldown_minutes)
    if cfg.max_per_symbol_day:
        w = Window.partitionBy("symbol", "date").orderBy(F.desc_nulls_last("score"), "timestamp", "event_type", "direction")
        out = out.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= cfg.max_per_symbol_day).drop("__r")
    return with_labels(out)


def first_half(bars: DataFrame, window: int = 20) -> DataFrame:
    """Spikes per symbol-day: how many bars reach twice their rolling median volume, and the largest ratio."""
    out = spike(bars, window, "median", by_symbol())
    return out.groupBy("symbol", "date").agg(F.count_if(F.col("spike_x") >= 2).alias("n_spikes"), F.max("spike_x").alias("max_spike"))
