"""Queries on ticks and intraday bars."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.config import IntradayConfig, LiquidityConfig
from tideline.functions import scalars as C
from tideline.functions import time as M
from tideline.functions.scalars import ratio
from tideline.operators import aggregates as A
from tideline.operators import detectors as D
from tideline.operators import features as X
from tideline.operators import halts as H
from tideline.operators import joins as J
from tideline.operators import rolling as R
from tideline.sources import adapters as S
from tideline.streaming import alerts as AL

from .catalog import BARS, TICKS, et, minute, query, session

CFG = IntradayConfig(
    min_bars=20, min_range_pct=1.0, rth_spike=1.5, rth_volume=20, rth_dollar_volume=500, ext_spike=2.0, ext_volume=20, ext_dollar_volume=500, vwap_up_pct=20.0, vwap_up_volume=1.2, vwap_down_pct=20.0, vwap_down_volume=1.2,
    momentum_up_pct=20.0, momentum_down_pct=20.0, momentum_volume=1.0, base_window=6, base_range_multiple=12.0, base_break_pct=1.0, base_volume=1.0, or_minutes=30, or_break_pct=5.0, or_volume=1.0, flush_drop_pct=30.0, flush_volume=1.2, flush_red_bars=2, dedup_minutes=60,
)
COLUMNS = BARS + f""",
i0 as (select *, {session()} as session, {minute()} as minute, count(*) over (partition by symbol, date) as nbars from bars),
i1 as (select *, quantile_cont(volume, 0.5) over w20 as base_volume, max((session = 'RTH')::int) over run as on_, (high - low) / nullif(open, 0) * 100 as range_pct, close * volume as dollar_volume,
  volume / nullif(avg(volume) over w20, 0) as volume_x, (close / nullif(lag(close, 5) over d, 0) - 1) * 100 as ret_pct, max(high) over p20 as high20, min(low) over p20 as low20, max(high) over b as base_high, min(low) over b as base_low,
  quantile_cont(high - low, 0.5) over b as typical, max(case when minute between 570 and 599 then high end) over g as or_high, min(case when minute between 570 and 599 then low end) over g as or_low, minute between 570 and 599 as in_or,
  max(high) over run as day_high, sum((close < open)::int) over (d rows between 1 preceding and current row) as red_bars from i0 where nbars >= 20
  window g as (partition by symbol, date), d as (partition by symbol, date order by timestamp), w20 as (d rows between 19 preceding and current row), p20 as (d rows between 20 preceding and 1 preceding), b as (d rows between 5 preceding and current row), run as (d rows between unbounded preceding and current row)),
i2 as (select *, volume / nullif(base_volume, 0) as spike_x, sum(case when on_ = 1 then (high + low + close) / 3 * volume end) over run / nullif(sum(case when on_ = 1 then volume end) over run, 0) as vwap_ref,
  coalesce((base_high - base_low) / nullif(open, 0) * 100 <= 12.0 * typical * 100, false) as calm, (day_high - close) / nullif(day_high, 0) * 100 as drop_pct from i1 window run as (partition by symbol, date order by timestamp rows between unbounded preceding and current row)),
i3 as (select *, (close - vwap_ref) / nullif(vwap_ref, 0) * 100 as vwap_dist_pct, lag(calm) over d as prev_calm, lag(base_high) over d as prev_base_high, lag(base_low) over d as prev_base_low from i2 window d as (partition by symbol, date order by timestamp)),
r as (select *, unnest([
  struct_pack(event_type := 'volume_spike', direction := case when close > open then 'up' else 'down' end, hit := spike_x >= case when session = 'RTH' then 1.5 else 2.0 end and volume >= 20 and dollar_volume >= 500 and range_pct >= 1.0),
  struct_pack(event_type := 'vwap_break', direction := 'up', hit := vwap_dist_pct >= 20 and volume_x >= 1.2),
  struct_pack(event_type := 'vwap_break', direction := 'down', hit := vwap_dist_pct <= -20 and volume_x >= 1.2),
  struct_pack(event_type := 'price_momentum', direction := 'up', hit := ret_pct >= 20 and volume_x >= 1.0 and close > high20),
  struct_pack(event_type := 'price_momentum', direction := 'down', hit := ret_pct <= -20 and volume_x >= 1.0 and close < low20),
  struct_pack(event_type := 'consolidation_break', direction := 'up', hit := prev_calm and volume_x >= 1.0 and (close - prev_base_high) / nullif(prev_base_high, 0) * 100 >= 1.0),
  struct_pack(event_type := 'consolidation_break', direction := 'down', hit := prev_calm and volume_x >= 1.0 and (prev_base_low - close) / nullif(prev_base_low, 0) * 100 >= 1.0),
  struct_pack(event_type := 'opening_range_break', direction := 'up', hit := not in_or and minute < 960 and minute >= 600 and volume_x >= 1.0 and (close - or_high) / nullif(or_high, 0) * 100 >= 5.0),
  struct_pack(event_type := 'opening_range_break', direction := 'down', hit := not in_or and minute < 960 and minute >= 600 and volume_x >= 1.0 and (or_low - close) / nullif(or_low, 0) * 100 >= 5.0),
  struct_pack(event_type := 'flush', direction := 'down', hit := drop_pct >= 30 and volume_x >= 1.2 and red_bars >= 2)]) as h from i3),
hits as (select * exclude (h), h.event_type as event_type, h.direction as direction, 0.3 * coalesce(spike_x, 1.0) + 0.25 * coalesce(range_pct, 0.0) + 0.2 as score from r where h.hit),
events_ as (select * from hits qualify row_number() over (partition by symbol, event_type, floor(epoch(timestamp) / 3600) order by score desc nulls last, timestamp, direction desc) = 1)"""
OUT = ("symbol", "timestamp", "event_type", "direction", "session", "spike_x", "score")


def detected(spark, d, *types):
    return D.detected(S.bars(spark, d), CFG, types or None).select(*OUT)


@query(BARS + "\n---\nselect * from bars", "open high low close vwap", "date", "timestamp")
def bars_15m(spark, d):
    return S.bars(spark, d)


@query(BARS + ",\nf as (select symbol, date, volume / nullif(quantile_cont(volume, 0.5) over (partition by symbol order by timestamp rows between 19 preceding and current row), 0) as spike_x from bars)\n---\nselect symbol, date, count_if(spike_x >= 2)::bigint as n_spikes, max(spike_x) as max_spike from f group by 1, 2", "max_spike", "date")
def spikes_per_day(spark, d):
    return D.first_half(S.bars(spark, d))


for _name in ("volume_spike", "vwap_break", "price_momentum", "consolidation_break", "opening_range_break", "flush"):

    def _one(spark, d, kind=_name):
        return detected(spark, d, kind)

    _one.__name__ = f"detect_{_name}"
    query(COLUMNS + f"\n---\nselect symbol, timestamp, event_type, direction, session, spike_x, score from hits where event_type = '{_name}'", "spike_x score", "", "timestamp")(_one)


@query(COLUMNS + "\n---\nselect symbol, timestamp, event_type, direction, session, spike_x, score, case direction when 'up' then 'bullish' else 'bearish' end as event_bias, case when close > open then 'green' else 'red' end as close_vs_open, 1 as tier from events_", "spike_x score", "", "timestamp")
def intraday_events(spark, d):
    return D.intraday_events(S.bars(spark, d), CFG).select(*OUT, "event_bias", "close_vs_open", "tier")


@query("recursive " + COLUMNS + """,
cd as (select symbol, date, event_type, min(epoch(timestamp)) as t from events_ group by all
  union all select symbol, date, event_type, min(x) from (select cd.symbol, cd.date, cd.event_type, cd.t, epoch(e.timestamp) as x from cd join events_ e on e.symbol = cd.symbol and e.date = cd.date and e.event_type = cd.event_type and epoch(e.timestamp) - cd.t >= 7200) group by symbol, date, event_type, t)
---
select symbol, timestamp, event_type, direction, session, spike_x, score from events_ e where exists (from cd where cd.symbol = e.symbol and cd.date = e.date and cd.event_type = e.event_type and cd.t = epoch(e.timestamp))
qualify row_number() over (partition by symbol, date order by score desc nulls last, timestamp, event_type, direction) <= 5""", "spike_x score", "", "timestamp")
def intraday_events_cooldown(spark, d):
    from dataclasses import replace

    return D.intraday_events(S.bars(spark, d), replace(CFG, cooldown_minutes=120, max_per_symbol_day=5)).select(*OUT)


@query(TICKS + f"\n---\nselect event_id, strftime({et()}, '%Y-%m-%d %H:%M:%S') as et, hour({et()})::int as hour_et, minute({et()})::int as minute_et, hour({et()}) + minute({et()}) / 60.0 as time_decimal, case {session()} when 'PM' then 'premarket' when 'RTH' then 'rth' when 'AH' then 'postmarket' else 'closed' end as session, {session()} = 'RTH' as is_market_hours, {session()} in ('PM', 'AH') as is_extended_hours from ticks", "time_decimal")
def market_time(spark, d):
    out = M.with_market_time(S.ticks(spark, d))
    return out.select("event_id", F.date_format("timestamp_et", "yyyy-MM-dd HH:mm:ss").alias("et"), "hour_et", "minute_et", "time_decimal", "session", "is_market_hours", "is_extended_hours")


@query(TICKS + f"\n---\nselect symbol, {session()} as session, count(*) as n from ticks where {session()} <> 'CLOSED' group by 1, 2")
def recalculated_sessions(spark, d):
    return M.recalculated_sessions(S.ticks(spark, d)).groupBy("symbol", "session").agg(F.count("*").alias("n"))


@query(TICKS + f"\n---\nselect event_id, price from ticks where {minute()} between 570 and 615", "price")
def clock_slice(spark, d):
    return S.ticks(spark, d).where(M.in_clock_range(M.market_time(F.col("timestamp")), "09:30", "10:15")).select("event_id", "price")


@query(TICKS + "\n---\nselect event_id, symbol || '_' || 'tick' || '_' || strftime(timestamp, '%Y%m%d_%H%M%S') || '_' || sha1(symbol || '|tick|' || strftime(timestamp, '%Y-%m-%dT%H:%M:%S'))[1:8] as id from ticks")
def canonical_ids(spark, d):
    return S.ticks(spark, d).select("event_id", C.event_id(F.col("symbol"), F.lit("tick"), F.col("timestamp")).alias("id"))


@query(BARS + "\n---\nselect symbol, timestamp, (high + low + close) / 3 as vwap_min, volume * (high + low + close) / 3 as dollar_volume_bar, (high - low) / nullif((high + low + close) / 3, 0) as spread_proxy, greatest(least(close, 80), 5) as price_clipped, abs(close - open) / (high - low + 1e-9) as body from bars", "vwap_min dollar_volume_bar spread_proxy price_clipped body", "", "timestamp")
def bar_scalars(spark, d):
    return C.with_derived(S.bars(spark, d)).select("symbol", "timestamp", "vwap_min", "dollar_volume_bar", "spread_proxy", C.clipped(F.col("close"), 5.0, 80.0).alias("price_clipped"), C.body_ratio().alias("body"))


@query(BARS + """,
h1 as (select *, high = low and volume = 0 as halt_flat, abs(open - lag(close) over s) / (lag(close) over s + 1e-9) > 0.5 and volume / (lag(volume) over s + 1e-9) > 3 as halt_gap,
  case when count(volume) over w >= 5 then avg(volume) over w end as usual from bars window s as (partition by symbol order by timestamp), w as (s rows between 20 preceding and 1 preceding)),
h2 as (select *, count(*) over t = 3 and sum(halt_flat::int) over t = 3 as halt_sequence, volume < 0.1 * usual and usual > 0 as halt_drought from h1 window t as (partition by symbol order by timestamp rows between 2 preceding and current row)),
h3 as (select *, coalesce(halt_flat or halt_gap or halt_sequence or halt_drought, false) as is_halt from h2)
---
select symbol, timestamp, halt_flat, halt_gap, halt_sequence, halt_drought, is_halt, bool_or(is_halt) over (partition by symbol order by timestamp rows between 14 preceding and 15 following) as in_halt_window from h3""", "", "", "timestamp")
def inferred_halts(spark, d):
    out = H.with_inferred_halts(S.bars(spark, d), gap=0.5, volume_x=3.0).withColumn("is_halt", F.coalesce("halt_like", F.lit(False)))
    return H.with_halt_window(out, "is_halt").select("symbol", "timestamp", "halt_flat", "halt_gap", "halt_sequence", "halt_drought", "is_halt", "in_halt_window")


@query(TICKS + ",\nh as (select user_id, timestamp as a, case when event_id % 2 = 1 then timestamp + interval 20 minutes else timestamp + interval 1 hour end as b from ticks where symbol = 'error')\n---\nselect event_id, exists (select 1 from h where h.user_id = t.user_id and t.timestamp between a and b) as halt_official from ticks t where symbol <> 'error'")
def official_halts(spark, d):
    t = S.ticks(spark, d).where("symbol <> 'error'").select(F.col("user_id").alias("symbol"), "timestamp", "event_id")
    return H.with_official_halts(t, S.halts(spark, d)).select("event_id", "halt_official")


@query(BARS + f""",
c as (select symbol, date, lag(arg_max(close, timestamp)) over (partition by symbol order by date) as pc from bars group by 1, 2),
t as (select b.*, coalesce(close <= 0.5 * pc and {session()} = 'RTH', false) as ssr_trigger from bars b left join c using (symbol, date)),
l as (select *, max(case when ssr_trigger then timestamp end) over (partition by symbol order by timestamp rows between unbounded preceding and current row) as since from t),
d as (select symbol, date, coalesce(lag(bool_or(ssr_trigger)) over (partition by symbol order by date), false) as before_ from t group by 1, 2)
---
select symbol, timestamp, ssr_trigger, coalesce(since::date = date, false) or before_ as ssr_active from l join d using (symbol, date)""", "", "", "timestamp")
def ssr_intraday(spark, d):
    return H.ssr_intraday(S.bars(spark, d), drop_pct=50.0).select("symbol", "timestamp", "ssr_trigger", "ssr_active")


LIQ = LiquidityConfig(premarket=1000, postmarket=1000, rth=2000, rth_low_price=4000, low_price=20.0, max_spread=0.5, min_activity=0.5, activity_window=10, min_price=5.0, max_price=120.0)
LIQUIDITY = BARS + f""",
l1 as (select *, {session()} as s, volume * vwap as dv, (high - low) / (vwap + 1e-9) as spread_proxy, abs(close - open) / (high - low + 1e-9) as body, sum((volume > 0)::int) over (partition by symbol order by timestamp rows between 9 preceding and current row) / 10.0 as activity from bars),
l2 as (select *, list_sort(list(spread_proxy) filter (spread_proxy is not null) over (partition by symbol order by timestamp rows between 9 preceding and current row)) as xs from l1),
l3 as (select *, xs[(round(0.95 * (len(xs) - 1)) + 1)::int] as p95 from l2),
l4 as (select *, dv >= case s when 'PM' then 1000 when 'AH' then 1000 when 'RTH' then case when close < 20 then 4000 else 2000 end else 2000 end as pass_dollar_volume, p95 <= 0.5 or not (p95 > 0.5 and body < 0.5) as pass_spread, activity >= 0.5 as pass_activity, close between 5 and 120 as pass_price, true as pass_halt from l3),
liq as (select *, pass_dollar_volume and pass_spread and pass_activity and pass_price and pass_halt as liquidity_pass from l4)"""


@query(LIQUIDITY + "\n---\nselect symbol, timestamp, p95 as spread_p95, activity, pass_dollar_volume, pass_spread, pass_activity, pass_price, liquidity_pass from liq", "spread_p95 activity", "", "timestamp")
def liquidity_flags(spark, d):
    return H.with_liquidity(S.bars(spark, d), LIQ).select("symbol", "timestamp", "spread_p95", "activity", "pass_dollar_volume", "pass_spread", "pass_activity", "pass_price", "liquidity_pass")


@query(LIQUIDITY + "\n---\nselect count(*) as n_rows, count_if(liquidity_pass)::bigint as n_pass, count_if(not liquidity_pass)::bigint as n_fail, count_if(liquidity_pass is null)::bigint as n_null, count_if(not pass_dollar_volume)::bigint as fail_dollar_volume, count_if(not pass_spread)::bigint as fail_spread, count_if(not pass_activity)::bigint as fail_activity, count_if(not pass_price)::bigint as fail_price, count_if(not pass_halt)::bigint as fail_halt from liq")
def liquidity_breakdown(spark, d):
    return H.liquidity_breakdown(H.with_liquidity(S.bars(spark, d), LIQ))


@query(BARS + "\n---\nselect symbol, timestamp, volume / nullif(avg(volume) over (partition by symbol, hour(timestamp) * 60 + minute(timestamp) order by date rows between 60 preceding and 1 preceding), 0) as rvol_minute from bars", "rvol_minute", "", "timestamp")
def rvol_same_minute(spark, d):
    return R.rvol_same_minute(S.bars(spark, d)).select("symbol", "timestamp", "rvol_minute")


@query(BARS + """,
z as (select symbol, timestamp, close * volume as dv, list_sort(list(close * volume) over (partition by symbol, hour(timestamp) * 60 + minute(timestamp) order by timestamp rows between 60 preceding and 1 preceding)) as p from bars),
z2 as (select *, list_transform(p, lambda x: greatest(least(x, quantile_hi), quantile_lo)) as w from (select *, list_aggregate(p, 'quantile_cont', 0.01) as quantile_lo, list_aggregate(p, 'quantile_cont', 0.99) as quantile_hi from z)),
z3 as (select *, list_aggregate(w, 'quantile_cont', 0.5) as med from z2), z4 as (select *, list_aggregate(list_transform(w, lambda x: abs(x - med)), 'quantile_cont', 0.5) as mad from z3)
---
select symbol, timestamp, case when len(p) >= 5 then (dv - med) / nullif(1.4826 * mad, 0) end as dv_z from z4""", "dv_z", "", "timestamp")
def dollar_volume_z(spark, d):
    return X.dollar_volume_z(S.bars(spark, d), k=5).select("symbol", "timestamp", "dv_z")


@query(BARS + """,
s1 as (select *, greatest(high - low, abs(high - lag(close) over s), abs(low - lag(close) over s)) as tr from bars window s as (partition by symbol order by timestamp)),
s2 as (select *, avg(tr) over (partition by symbol order by timestamp rows between 4 preceding and current row) as atr5, 10000 / nullif(10 * close * volume, 0) as size_ratio from s1)
---
select symbol, timestamp, (high - low) / nullif(vwap, 0) / nullif(atr5, 0) as spread_vol_adj, (close - open) / nullif(high - low, 0) as imbalance, size_ratio, case when size_ratio < 0.01 then 'low' when size_ratio < 0.05 then 'medium' when size_ratio < 0.1 then 'high' else 'extreme' end as friction from s2""", "spread_vol_adj imbalance size_ratio", "", "timestamp")
def spread_features(spark, d):
    return X.spread_features(S.bars(spark, d)).select("symbol", "timestamp", "spread_vol_adj", "imbalance", "size_ratio", "friction")


@query(BARS + """,
t as (select symbol, timestamp, (high - low) / nullif(vwap, 0) / nullif(volume / nullif(avg(volume) over (partition by symbol order by timestamp rows between 19 preceding and current row), 0), 0) as difficulty from bars), u as (select * from t where difficulty is not null)
---
select symbol, timestamp, difficulty, ntile(4) over (partition by symbol order by difficulty, timestamp)::int as quartile, difficulty < quantile_cont(difficulty, 0.75) over (partition by symbol) as tradable from u""", "difficulty", "", "timestamp")
def trade_difficulty(spark, d):
    return X.trade_difficulty(S.bars(spark, d)).select("symbol", "timestamp", "difficulty", "quartile", "tradable")


@query(BARS + f""",
c as (select *, case when close < 2 then 0.0075 when close <= 10 then 0.005 else 0.0035 end as base, greatest(0, (high - low) / nullif(vwap, 0) - 0.01) * 0.6 as sp, greatest(0, 1000 / nullif(close * volume, 0) - 0.01) * 0.1 as sz, case when {minute()} between 570 and 574 then 0.004 else 0.0 end as cx, least(1.0, coalesce(close * volume / 10000.0, 0)) as fill_ratio from bars)
---
select symbol, timestamp, base + sp + sz + cx as slippage, fill_ratio, close * (1 + base + sp + sz + cx) as fill_price, case when base + sp + sz + cx < 0.01 and fill_ratio >= 0.9 then 'good' when base + sp + sz + cx < 0.03 and fill_ratio >= 0.5 then 'fair' else 'poor' end as quality from c""", "slippage fill_ratio fill_price", "", "timestamp")
def execution_cost(spark, d):
    return X.execution_cost(S.bars(spark, d), position_usd=1000).select("symbol", "timestamp", "slippage", "fill_ratio", "fill_price", "quality")


TQ = TICKS + ",\ntr as (select user_id as symbol, timestamp, event_id, price, size from ticks where symbol = 'purchase'), qu as (select user_id as symbol, timestamp, event_id, price * 0.99 as bid_price, price * 1.01 as ask_price, size as bid_size, 100 - size as ask_size from ticks where symbol = 'view')"


@query(TQ + "\n---\nselect tr.event_id, tr.price, qu.bid_price, qu.ask_price from tr asof left join qu on tr.symbol = qu.symbol and tr.timestamp >= qu.timestamp", "price bid_price ask_price")
def trades_as_of_quotes(spark, d):
    return J.as_of(S.trades(spark, d), S.quotes(spark, d), ["bid_price", "ask_price"]).select("event_id", "price", "bid_price", "ask_price")


@query(TQ + ",\na as (select tr.*, qu.bid_price, qu.ask_price from tr asof left join qu on tr.symbol = qu.symbol and tr.timestamp >= qu.timestamp), g as (select symbol, count(*) as n_trades, count(bid_price) as n_quoted, sum(case when price >= ask_price then size else 0 end)::bigint as buy_size, sum(case when price <= bid_price then size else 0 end)::bigint as sell_size, sum(size)::bigint as total_size from a group by 1)\n---\nselect *, buy_size - sell_size as delta, (buy_size - sell_size)::double / nullif(total_size, 0) as delta_ratio from g", "delta_ratio")
def aggressor_delta(spark, d):
    return X.aggressor_delta(S.trades(spark, d), S.quotes(spark, d))


@query(TQ + """,
q as (select symbol, avg(ask_price - bid_price) as mean_spread, avg((bid_price >= ask_price)::int) as cross_rate from qu group by 1),
t as (select symbol, count_if(s > 0)::bigint as upticks, count_if(s < 0)::bigint as downticks from (select symbol, price - lag(price) over (partition by symbol order by timestamp, event_id) as s from tr) group by 1),
n as (select symbol, var_pop(c) / nullif(avg(c), 0) as burstiness from (select symbol, date_trunc('hour', timestamp) as h, count(*) as c from tr group by 1, 2) group by 1)
---
select symbol, upticks, downticks, mean_spread, cross_rate, burstiness, upticks::double / nullif(downticks, 0) as tick_ratio from t left join q using (symbol) left join n using (symbol)""", "mean_spread cross_rate burstiness tick_ratio")
def l2_metrics(spark, d):
    return X.l2_metrics(S.trades(spark, d), S.quotes(spark, d))


@query(TQ + "\n---\nselect event_id, coalesce(size > avg(size) over w + 3 * stddev_samp(size) over w, false) as large_print, size > 3 * avg(size) over o as volume_burst, quantile_cont(size, 0.5) over w as size_p50, quantile_cont(size, 0.95) over w as size_p95 from tr window w as (partition by symbol), o as (partition by symbol order by timestamp, event_id rows between 19 preceding and current row)", "size_p50 size_p95")
def trade_features(spark, d):
    return X.trade_features(S.trades(spark, d)).select("event_id", "large_print", "volume_burst", "size_p50", "size_p95")


@query(TQ + ",\nf as (select *, ask_price - bid_price as spread, (ask_price + bid_price) / 2 as mid from qu)\n---\nselect event_id, spread, spread / nullif(mid, 0) as spread_pct, spread / nullif(lag(spread) over s, 0) as expansion, (bid_size - ask_size)::double / nullif(bid_size + ask_size, 0) as imbalance, stddev_pop(mid) over w / nullif(avg(mid) over w, 0) as mid_stability from f window s as (partition by symbol order by timestamp, event_id), w as (s rows between 19 preceding and current row)", "spread spread_pct expansion imbalance mid_stability")
def quote_features(spark, d):
    return X.quote_features(S.quotes(spark, d)).select("event_id", "spread", "spread_pct", "expansion", "imbalance", "mid_stability")


@query(TQ + ",\nf as (select *, row_number() over s as rn, bid_price is distinct from lag(bid_price) over s or ask_price is distinct from lag(ask_price) over s or bid_size is distinct from lag(bid_size) over s or ask_size is distinct from lag(ask_size) over s as diff from (select symbol, timestamp, event_id, round(bid_price / 40) as bid_price, round(ask_price / 40) as ask_price, bid_size // 50 as bid_size, ask_size // 50 as ask_size from qu) window s as (partition by symbol order by timestamp))\n---\nselect event_id from f where diff or rn = 1")
def changed_quotes(spark, d):
    q = S.quotes(spark, d)
    q = q.select("symbol", "timestamp", "event_id", F.round(F.col("bid_price") / 40).alias("bid_price"), F.round(F.col("ask_price") / 40).alias("ask_price"), F.expr("bid_size div 50").alias("bid_size"), F.expr("ask_size div 50").alias("ask_size"))
    return R.changed_quotes(q).select("event_id")


@query(TQ + ",\nf as (select event_id, symbol, row_number() over (partition by symbol order by timestamp) - 1 as i, count(*) over (partition by symbol) as m from qu), k as (select symbol, any_value(m) as m, unnest(range(7)) as j from f group by symbol)\n---\nselect event_id from f where m <= 7 or exists (select 1 from k where k.symbol = f.symbol and (k.j * f.m) // 7 = f.i)")
def downsampled_quotes(spark, d):
    return R.downsampled(S.quotes(spark, d), F.lit(7)).select("event_id")


@query(BARS + """,
p as (select *, high - low as r, row_number() over d as i from bars window d as (partition by symbol, date order by timestamp))
---
select symbol, timestamp, (close - vwap) / nullif(vwap, 0) as vwap_dev, r / nullif(avg(r) over (d rows between 20 preceding and 1 preceding), 0) as range_expansion, close / nullif(first(open) over (d rows between unbounded preceding and current row), 0) - 1 as day_return,
  coalesce(close > max(high) over (d rows between unbounded preceding and 1 preceding), false) as hod_break, coalesce(close < min(low) over (d rows between unbounded preceding and 1 preceding), false) as lod_break, close / nullif(lag(close, 3) over d, 0) - 1 as velocity, regr_slope(close, i) over (d rows between 14 preceding and current row) as slope
from p window d as (partition by symbol, date order by timestamp)""", "vwap_dev range_expansion day_return velocity slope", "", "timestamp")
def price_features(spark, d):
    return X.price_features(S.bars(spark, d)).select("symbol", "timestamp", "vwap_dev", "range_expansion", "day_return", "hod_break", "lod_break", "velocity", "slope")


@query(BARS + ",\nr as (select symbol, date, volume, row_number() over (partition by symbol, date order by volume, timestamp) as i from bars)\n---\nselect symbol, date, 2.0 * sum(i * volume) / nullif(count(*) * sum(volume), 0) - (count(*) + 1) / count(*) as gini from r group by 1, 2", "gini", "date")
def volume_gini(spark, d):
    return X.volume_gini(S.bars(spark, d))


@query(BARS + "\n---\nselect symbol, timestamp, lead(close, 3) over w / nullif(close, 0) - 1 as fwd_return, case when lead(close, 3) over w / nullif(close, 0) - 1 >= 0.02 then 1 when lead(close, 3) over w / nullif(close, 0) - 1 <= -0.02 then -1 when lead(close, 3) over w / nullif(close, 0) is not null then 0 end::int as fwd_label from bars window w as (partition by symbol, date order by timestamp)", "fwd_return", "", "timestamp")
def forward_label(spark, d):
    return X.forward_label(S.bars(spark, d), 3).select("symbol", "timestamp", "fwd_return", "fwd_label")


@query(BARS + """,
c as (select *, close / nullif(lag(close) over d, 0) - 1 as r, lead(close, 4) over d / nullif(close, 0) - 1 as exit_return, coalesce(min(low) over (d rows unbounded preceding) <= 0.9 * first_value(open) over d, false) as ssr from bars window d as (partition by symbol, date order by timestamp)),
s as (select *, stddev_samp(r) over (partition by symbol, date order by timestamp rows between 19 preceding and current row) as sigma from c),
k as (select *, (2 * 0.003 + 0.0000278 * close * (1 + exit_return)) / nullif(close, 0) as fees, 2 * (greatest(case when ssr then 2.0 else 0.5 end * (high - low), 0.01) + 0.2 * coalesce(sigma, 0) * close) / nullif(close, 0) as slip from s)
---
select symbol, timestamp, exit_return, fees, slip, exit_return - fees - slip as net_return, case when exit_return - fees - slip > 0 then 1 when exit_return - fees - slip < 0 then -1 else 0 end as net_label from k where exit_return is not null""", "exit_return fees slip net_return", "", "timestamp")
def net_labels(spark, d):
    """The return of the next four bars, less fees and slippage by spread, volatility and short-sale restriction."""
    bars = S.bars(spark, d)
    day = R.by_day()
    start = day.rowsBetween(Window.unboundedPreceding, 0)
    out = X.intraday_sigma(bars, 20).withColumn("exit_return", ratio(F.lead("close", 4).over(day), F.col("close")) - 1)
    out = out.withColumn("ssr", F.coalesce(F.min("low").over(start) <= 0.9 * F.first("open").over(start), F.lit(False))).withColumn("spread", F.col("high") - F.col("low")).withColumn("entry", F.col("close"))
    out = X.net_of_costs(out.where("exit_return is not null"))
    return out.select("symbol", "timestamp", "exit_return", "fees", "slip", "net_return", "net_label")


@query(BARS + """,
g as (select *, coalesce(epoch(timestamp) - epoch(lag(timestamp) over s) <= 1800, false) as valid_step, close - lag(close) over s as c from bars window s as (partition by symbol order by timestamp))
---
select symbol, timestamp, valid_step, case when sum(valid_step::int) over w = 14 then 100 * sum(greatest(c, 0)) over w / nullif(sum(greatest(c, 0)) over w + sum(greatest(-c, 0)) over w, 0) end as rsi from g window w as (partition by symbol order by timestamp rows between 13 preceding and current row)""", "rsi", "", "timestamp")
def gap_aware_rsi(spark, d):
    return X.gap_aware(S.bars(spark, d), 900).select("symbol", "timestamp", "valid_step", "rsi")


@query(BARS + ",\nn as (select symbol, close, volume, timestamp as t, lead(timestamp) over (partition by symbol order by timestamp) as nx from bars), e as (select *, unnest(case when nx is null then [t] else generate_series(t, greatest(t, least(nx - interval 15 minutes, t + interval 45 minutes)), interval 15 minutes) end) as at_ from n)\n---\nselect symbol, at_ as timestamp, close, case when at_ = t then volume else 0 end as volume, at_ <> t as is_filled from e", "close", "", "timestamp")
def filled_forward(spark, d):
    return X.filled_forward(S.bars(spark, d), 900, 2700)


@query(BARS + f""",
q as (select *, {minute()} as m, max(case when {minute()} between 240 and 569 then high end) over (partition by symbol, date) as pm_high, sum((high + low + close) / 3 * volume) over r / nullif(sum(volume) over r, 0) as v from bars window r as (partition by symbol, date order by timestamp rows between unbounded preceding and current row)),
o as (select *, coalesce(m between 570 and 959 and close > pm_high, false) as o, close > v as a from q)
---
select symbol, timestamp, o and not coalesce(bool_or(o) over (d rows between unbounded preceding and 1 preceding), false) as pm_high_break, coalesce(a and not lag(a) over d, false) as vwap_reclaim from o window d as (partition by symbol, date order by timestamp)""", "", "", "timestamp")
def intraday_screens(spark, d):
    return X.intraday_screens(S.bars(spark, d)).select("symbol", "timestamp", "pm_high_break", "vwap_reclaim")


def tape_events(spark, d):
    """Every signup is an event of its user."""
    return S.ticks(spark, d).where("symbol = 'signup'").select(F.col("user_id").alias("symbol"), F.col("event_id").alias("event_key"), F.col("timestamp").alias("event_time"), F.col("price").alias("entry"))


TAPE = TQ + ",\nev as (select user_id as symbol, event_id as event_key, timestamp as event_time, price as entry from ticks where symbol = 'signup')"


@query(TAPE + "\n---\nselect event_key, count(*) as n, sum(size)::bigint as size from ev join tr using (symbol) where timestamp between event_time - interval 180 minutes and event_time + interval 420 minutes group by 1")
def event_windows(spark, d):
    return J.in_event_windows(S.trades(spark, d), tape_events(spark, d), 180, 420, width=36_000).groupBy("event_key").agg(F.count("*").alias("n"), F.sum("size").alias("size"))


@query(TAPE + ",\nh as (select event_key, count(distinct floor((epoch(timestamp) - epoch(event_time)) / 60)) as m from ev join tr using (symbol) where timestamp between event_time - interval 180 minutes and event_time + interval 420 minutes group by 1)\n---\nselect event_key, coalesce(m, 0) / 601 as continuity from ev left join h using (event_key)", "continuity")
def tick_continuity(spark, d):
    return X.tick_continuity(S.trades(spark, d), tape_events(spark, d), 180, 420)


@query(TAPE + """,
f as (select event_key, entry, timestamp, price, case when price <= entry * 0.9 then -1 when price >= entry * 1.15 then 1 end as side from ev join tr using (symbol) where timestamp > event_time and timestamp <= event_time + interval 600 minutes),
x as (select event_key, arg_min(side, timestamp) filter (side is not null) as label, arg_max(price, timestamp) as last from f group by 1)
---
select event_key, coalesce(label, 0)::int as label, case coalesce(label, 0) when 1 then 0.15 when -1 then -0.1 else last / entry - 1 end as exit_return from ev left join x using (event_key)""", "exit_return")
def triple_barrier(spark, d):
    t = S.trades(spark, d)
    b = t.select("symbol", "timestamp", F.col("price").alias("high"), F.col("price").alias("low"), F.col("price").alias("close"))
    return X.triple_barrier(b, tape_events(spark, d), minutes=600).select("event_key", "label", "exit_return")


@query(BARS + f""",
e as (select symbol || '@' || date as event_key, symbol, date from (select distinct symbol, date from bars)), s(o, a, b) as (values (-1, 960, 1199), (0, 570, 659), (1, 240, 569)),
w as (select event_key, symbol, date + o::int as date, o, a, b from e, s)
---
select event_key, o as "offset", count(*) as n, sum(volume)::bigint as volume from bars b join w on b.symbol = w.symbol and ({et('timestamp')})::date = w.date where {minute()} between a and b group by 1, 2""")
def session_slices(spark, d):
    b = S.bars(spark, d)
    e = b.select("symbol", "date").distinct().withColumn("event_key", F.concat_ws("@", "symbol", "date"))
    out = J.session_slices(e, b, [(-1, "16:00", "19:59"), (0, "09:30", "10:59"), (1, "04:00", "09:29")])
    return out.groupBy("event_key", "offset").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))


@query(TICKS + ",\nn as (select user_id as symbol, timestamp as published, event_id as nid from ticks where symbol = 'click'), ev as (select user_id as symbol, event_id as event_key, timestamp as event_time from ticks where symbol = 'signup')\n---\nselect event_key, count(*) as n_news from ev join n using (symbol) where abs(floor(epoch(published)) - floor(epoch(event_time))) <= 86400 group by 1")
def news_near_events(spark, d):
    n = S.ticks(spark, d).where("symbol = 'click'").select(F.col("user_id").alias("symbol"), F.col("timestamp").alias("published"))
    return J.within_days(tape_events(spark, d).drop("entry"), n).groupBy("event_key").agg(F.count("*").alias("n_news"))


@query(TICKS + ",\nn as (select user_id as symbol, timestamp as published, event_id as nid from ticks where symbol = 'click'), ev as (select user_id as symbol, event_id as event_key, timestamp as event_time from ticks where symbol = 'signup')\n---\nselect event_key, count(*) as n_news, max(published) as last_news from ev join n using (symbol) where abs(floor(epoch(published)) - floor(epoch(event_time))) <= 86400 and published <= event_time group by 1", "", "", "last_news")
def news_known_in_time(spark, d):
    """News near events that was out when the event came: nothing from the future."""
    n = S.ticks(spark, d).where("symbol = 'click'").select(F.col("user_id").alias("symbol"), F.col("timestamp").alias("published"))
    return J.within_days(tape_events(spark, d).drop("entry"), n, as_of_time=F.col("event_time")).groupBy("event_key").agg(F.count("*").alias("n_news"), F.max("published").alias("last_news"))


@query("recursive " + COLUMNS + """,
u as (select c_custkey as user, (c_custkey % 7)::bigint as rule_id, ['volume_spike', 'vwap_break', 'price_momentum', 'consolidation_break', 'opening_range_break', 'flush'][(c_custkey % 6 + 1)::int] as kind, case c_nationkey % 3 when 0 then 'up' when 1 then 'down' end as direction, c_acctbal / 2000 as min_score, case when c_nationkey % 2 = 0 then c_acctbal / 100 end as max_price from customer),
m as (select u.user, u.rule_id, e.symbol, e.timestamp, e.date, e.event_type, e.direction, e.score from events_ e join u on u.kind = e.event_type where (u.direction is null or e.direction = u.direction) and e.score >= u.min_score and (u.max_price is null or e.close <= u.max_price))
---
select user, rule_id, symbol, timestamp, date, event_type, direction, score, row_number() over (partition by user, date order by score desc nulls last, timestamp, symbol, event_type, direction)::int as rank from m
qualify row_number() over (partition by user, date order by score desc nulls last, timestamp, symbol, event_type, direction) <= 3""", "score", "date", "timestamp")
def user_alerts(spark, d):
    """Each customer's rule on one type of event, with limits from its balance and nation: its three best alerts a day."""
    c, text, number = S.table(spark, d, "customer"), F.lit(None).cast("array<string>"), F.lit(None).cast("double")
    kind = F.element_at(F.array(*map(F.lit, AL.TYPES[:6])), (F.col("c_custkey") % 6 + 1).cast("int"))
    way = F.when(F.col("c_nationkey") % 3 == 0, "up").when(F.col("c_nationkey") % 3 == 1, "down")
    rules = c.select(
        (F.col("c_custkey") % 7).alias("rule_id"), F.col("c_custkey").alias("user"), F.array(kind).alias("event_types"), text.alias("sessions"), text.alias("symbols"), way.alias("direction"), number.alias("min_price"),
        F.when(F.col("c_nationkey") % 2 == 0, F.col("c_acctbal") / 100).alias("max_price"), (F.col("c_acctbal") / 2000).alias("min_score"), number.alias("min_spike"),
    )
    return AL.best(D.intraday_events(S.bars(spark, d), CFG), rules, 3)


@query(COLUMNS + "\n---\nselect symbol, count(distinct event_type) as n_types, count(*) as n from events_ where timestamp >= (select max(timestamp) from events_) - interval 24 hours and direction = 'up' group by 1 having count(distinct event_type) >= 2")
def multi_event_symbols(spark, d):
    return X.multi_event_symbols(D.intraday_events(S.bars(spark, d), CFG), 24, 2)


@query(BARS + "\n---\nselect symbol, max(timestamp) as timestamp, arg_max(close, timestamp) as close, arg_max(volume, timestamp) as volume from bars group by 1", "close", "", "timestamp")
def latest_features(spark, d):
    return X.latest_features(S.bars(spark, d))


@query(BARS + f"\n---\nselect symbol, date, max(high) as or_high, min(low) as or_low from bars where {minute()} between 570 and 599 group by 1, 2", "or_high or_low", "date")
def opening_range(spark, d):
    return A.opening_range(S.bars(spark, d), 30)


@query(BARS + f",\npm as (select symbol, ({et('timestamp')})::date as date, sum(vwap * volume) as s from bars where hour({et('timestamp')}) in (7, 8) group by 1, 2), k as (select distinct symbol, date from bars)\n---\nselect symbol, date, coalesce(s, 0) as pm_dollar_volume from k left join pm using (symbol, date)", "pm_dollar_volume", "date")
def premarket_dollar_volume(spark, d):
    b = S.bars(spark, d)
    return D.premarket_dollar_volume(b.select("symbol", "date").distinct(), b)


@query(BARS + ",\nl as (select symbol, timestamp, close, lag(close, 5) over s as middle, lag(close, 10) over s as first from bars window s as (partition by symbol order by timestamp))\n---\nselect symbol, timestamp, close, middle, first from l where middle >= first * 1.02 and close <= middle * 0.98 and abs(close - first) <= 0.05 * first", "close middle first", "", "timestamp")
def double_bottoms(spark, d):
    return X.double_bottoms(S.bars(spark, d)).select("symbol", "timestamp", "close", "middle", "first")


@query(COLUMNS + ",\nn as (select symbol, timestamp, event_type, min(case when event_type = 'vwap_break' then timestamp end) over (partition by symbol order by timestamp range between current row and unbounded following) as next_time from events_)\n---\nselect symbol, timestamp, next_time from n where event_type = 'volume_spike' and epoch(next_time) - epoch(timestamp) <= 7200", "", "", "timestamp next_time")
def event_sequences(spark, d):
    e = D.intraday_events(S.bars(spark, d), CFG)
    return X.event_sequences(e, "volume_spike", "vwap_break", 120).select("symbol", "timestamp", "next_time")


@query(BARS + f",\nd as (select *, sum(close * volume) over (partition by symbol, date) as dv from bars)\n---\nselect symbol, count(*) as n, sum(volume)::bigint as volume from d where close between 5 and 150 and dv >= 100000 and {session()} in ('PM', 'RTH') group by 1")
def global_filters(spark, d):
    out = D.global_filters(S.bars(spark, d), 5.0, 150.0, 100_000, ("PM", "RTH"))
    return out.groupBy("symbol").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))


@query(COLUMNS + ",\nw as (select symbol, timestamp, event_type, case when spike_x >= 2.5 then 10 else 3 end as b, case when spike_x >= 2.5 then 20 else 7 end as a from events_)\n---\nselect symbol, timestamp, event_type, coalesce(b, 3)::int as window_before_min, coalesce(a, 7)::int as window_after_min from w", "", "", "timestamp")
def tape_windows(spark, d):
    return X.tape_windows(D.intraday_events(S.bars(spark, d), CFG), spike=2.5).select("symbol", "timestamp", "event_type", "window_before_min", "window_after_min")


@query(COLUMNS + ",\nb as (select *, floor(epoch(timestamp) / 3600) as bk, max(score) over (partition by symbol, event_type, floor(epoch(timestamp) / 3600)) as top_, row_number() over (partition by symbol, event_type, floor(epoch(timestamp) / 3600) order by score desc nulls last, timestamp, direction desc) as rn from hits)\n---\nselect symbol, timestamp, event_type, direction, score from b where rn = 1 or score >= top_ * 0.8", "score", "", "timestamp")
def near_best_per_bucket(spark, d):
    return D.best_per_bucket(D.detected(S.bars(spark, d), CFG), 60, keep_within_pct=20.0).select("symbol", "timestamp", "event_type", "direction", "score")


def flagship(spark, d):
    """intraday_events on symbol-days of any length: the smallest tables have few ticks a day."""
    from dataclasses import replace

    return D.intraday_events(S.bars(spark, d), replace(CFG, min_bars=1)).select(*OUT, "event_bias", "close_vs_open", "tier")
