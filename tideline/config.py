"""Thresholds of the operators. The defaults are the reference values of the domain; every query passes its own where its data differ."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class DailyConfig:
    """Five daily branches and their global limits. compat: the flush branch against a low that holds the same day (it can't fire)."""

    gap_pct: float = 5.0
    rvol: float = 2.0
    ire_pct: float = 30.0
    rvol_vswg: float = 5.0
    gap_vswg_min: float = 2.0
    rvol_alt: float = 1.8
    atr_window: int = 21
    atr_percentile: float = 0.88
    atr_fallback: float = 5.0
    atr_min_values: int = 30
    rvol_flush: float = 2.5
    drawdown_flush: float = 20.0
    min_dollar_volume: float = 600_000
    bullish_only: bool = True
    min_trading_days: int = 120
    compat: bool = False


@dataclass(frozen=True)
class IntradayConfig:
    """Six intraday detectors. compat reproduces literal readings where the intended rule differs."""

    min_bars: int = 30
    spike_window: int = 20
    spike_method: str = "median"
    min_range_pct: float = 1.5
    rth_spike: float = 6.0
    rth_volume: int = 10_000
    rth_dollar_volume: float = 50_000
    ext_spike: float = 8.0
    ext_volume: int = 15_000
    ext_dollar_volume: float = 75_000
    vwap_reference: str = "RTH"
    vwap_up_pct: float = 0.6
    vwap_up_volume: float = 2.0
    vwap_down_pct: float = 0.8
    vwap_down_volume: float = 2.5
    momentum_window: int = 5
    momentum_up_pct: float = 3.0
    momentum_down_pct: float = 3.5
    momentum_volume: float = 1.8
    base_window: int = 30
    base_range_multiple: float = 0.5
    base_break_pct: float = 1.0
    base_volume: float = 2.0
    or_minutes: int = 15
    or_break_pct: float = 0.5
    or_volume: float = 0.0
    flush_drop_pct: float = 8.0
    flush_volume: float = 4.0
    flush_red_bars: int = 3
    dedup_minutes: int = 10
    cooldown_minutes: int = 0
    max_per_symbol_day: int = 0
    # Off unless set: more confirmation of single detectors, a detector of trade speed, and two further parts of the score.
    bearish_red_bars: int = 0
    bearish_drop_pct: float = 0.0
    vwap_up_bars: int = 1
    vwap_down_bars: int = 1
    failed_reclaim_bars: int = 0
    min_acceleration: float = 0.0
    flush_window: int = 0
    tape_transactions: int = 0
    tape_spike: float = 3.0
    full_score: bool = False
    compat: bool = False


@dataclass(frozen=True)
class SessionLimits:
    dollar_volume_bar: float = 100_000
    volume_bar: float = 10_000
    dollar_volume_day: float = 500_000
    rvol_day: float = 1.5
    spread: float = 0.05


@dataclass(frozen=True)
class ManifestConfig:
    min_score: float = 0.60
    limits: dict = field(default_factory=lambda: {"RTH": SessionLimits(), "PM": SessionLimits(30_000, 3_000, 300_000, 1.0, 0.08), "AH": SessionLimits(30_000, 3_000, 300_000, 1.0, 0.08)})
    per_symbol_month: int = 20
    per_symbol_day: int = 2
    per_symbol: int = 18
    max_events: int = 10_000
    quotas: dict = field(default_factory=lambda: {"PM": (0.10, 0.20), "RTH": (0.75, 0.85), "AH": (0.03, 0.10)})
    price_min: float = 1.0
    price_max: float = 200.0
    events_range: tuple = (8000, 12000)
    min_symbols: int = 400
    min_score_median: float = 0.70
    min_rvol_median: float = 2.0
    max_top20: float = 0.25
    storage_mb_p90: float = 37.0
    max_storage_gb: float = 250.0
    seconds_p90: float = 33.0
    max_days: float = 3.0


@dataclass(frozen=True)
class LiquidityConfig:
    premarket: float = 300_000
    postmarket: float = 300_000
    rth: float = 1_000_000
    rth_low_price: float = 2_000_000
    low_price: float = 2.0
    spread_window: int = 10
    spread_quantile: float = 0.95
    max_spread: float = 0.06
    min_body: float = 0.5
    rvol_days: int = 20
    rvol_bars: int = 60
    min_rvol: float = 2.0
    activity_window: int = 60
    min_activity: float = 0.70
    min_price: float = 0.50
    max_price: float = 50.0
    max_spread_z: float = 0.0
