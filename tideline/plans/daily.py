"""Queries on daily bars."""

from pyspark.sql import functions as F

from tideline.config import DailyConfig
from tideline.operators import aggregates as A
from tideline.operators import detectors as D
from tideline.operators import features as X
from tideline.operators import halts as H
from tideline.operators import quality as Q
from tideline.operators import rolling as R
from tideline.sources import adapters as S

from .catalog import DAILY, METRICS, query

CFG = DailyConfig(min_dollar_volume=20_000, rvol=1.2, rvol_alt=1.1, rvol_vswg=1.5, rvol_flush=1.0, drawdown_flush=20.0, gap_pct=5.0)
EVENTS = METRICS + """,
ev0 as (select *, case when count(atr_pct) over g >= 30 then quantile_cont(atr_pct, 0.88) over g else 5.0 end as atr_p from metrics where days >= 120 window g as (partition by symbol)),
ev1 as (select *, coalesce(gap_pct >= 5 and rvol >= 1.2, false) as is_gap, coalesce(ire_pct >= 30 and rvol >= 1.2, false) as is_ire, coalesce(rvol >= 1.5 and gap_pct >= 2, false) as is_vswg,
  coalesce(atr_pct >= atr_p and rvol >= 1.1, false) as is_atr, coalesce(close > open and rvol >= 1.0 and drawdown_high_pct >= 20, false) as is_flush from ev0),
ev as (select *, (is_gap or is_ire or is_vswg or is_atr or is_flush) and coalesce(dollar_volume >= 20000, false) and coalesce(close > open and gap_pct >= 0, false) as is_event from ev1)"""
BRANCHES = ("is_gap", "is_ire", "is_vswg", "is_atr", "is_flush")


def events(spark, d):
    return D.daily_events(S.daily_bars(spark, d), CFG)


@query(METRICS + "\n---\nselect symbol, date, prev_close, gap_pct, ire_pct, avg_volume, rvol, tr, atr, atr_pct, drawdown_low_pct, drawdown_high_pct, dollar_volume, ssr from metrics", "prev_close gap_pct ire_pct avg_volume rvol tr atr atr_pct drawdown_low_pct drawdown_high_pct dollar_volume", "date")
def daily_metrics(spark, d):
    m = R.daily_metrics(S.daily_bars(spark, d))
    return m.select("symbol", "date", "prev_close", "gap_pct", "ire_pct", "avg_volume", "rvol", "tr", "atr", "atr_pct", "drawdown_low_pct", "drawdown_high_pct", "dollar_volume", "ssr")


@query(EVENTS + "\n---\nselect symbol, date, is_gap, is_ire, is_vswg, is_atr, is_flush, is_event, case when is_event then strftime(date, '%Y%m%d') end as event_id, atr_p from ev", "atr_p", "date")
def daily_events(spark, d):
    return events(spark, d).select("symbol", "date", *BRANCHES, "is_event", "event_id", "atr_p")


@query(METRICS + ",\np as (select *, quantile_cont(atr_pct, 0.88) over (partition by symbol) as p from metrics)\n---\nselect symbol, date, coalesce(abs(gap_pct) >= 20 and rvol >= 1.3 or atr_pct >= p and rvol >= 1.2, false) and coalesce(dollar_volume >= 20000, false) as is_event from p", "", "date")
def daily_two_branch(spark, d):
    return D.two_branch_events(S.daily_bars(spark, d), gap=20, rvol=1.3, rvol_alt=1.2, min_dollar_volume=20_000).select("symbol", "date", "is_event")


@query(EVENTS + """,
e as (select symbol, count(*) as n_events, sum(ssr::int)::bigint as n_ssr_events, avg(gap_pct) as mean_gap, max(gap_pct) as max_gap, avg(rvol) as mean_rvol, max(rvol) as max_rvol, avg(atr_pct) as mean_atr, avg(dollar_volume) as mean_dollar_volume from ev where is_event group by 1),
t as (select symbol, count(*) as total_days from ev group by 1), j as (select *, n_events * 100.0 / total_days as event_rate_pct from e left join t using (symbol))
---
select *, row_number() over (order by n_events desc, event_rate_pct desc, symbol)::int as rank from j order by rank limit 8""", "mean_gap max_gap mean_rvol max_rvol mean_atr mean_dollar_volume event_rate_pct")
def symbol_ranking(spark, d):
    return A.symbol_ranking(events(spark, d), 8)


@query(EVENTS + "\n---\nselect strftime(date, '%Y-%m') as month, count(*) as n_events from ev where is_event group by 1")
def monthly_density(spark, d):
    return A.monthly_density(events(spark, d).where("is_event"))


@query(EVENTS + ",\nu as (select unnest(['is_gap','is_ire','is_vswg','is_atr','is_flush']) as branch, unnest([is_gap,is_ire,is_vswg,is_atr,is_flush]) as hit from ev where is_event)\n---\nselect branch, count_if(hit)::bigint as n, count_if(hit) * 100.0 / nullif(count(*), 0) as pct from u group by 1", "pct")
def branch_breakdown(spark, d):
    return A.branch_breakdown(events(spark, d))


@query(EVENTS + "\n---\nselect symbol, count(*) as n_events from ev where is_event group by 1 order by 2 desc, 1 limit 5")
def top_symbols(spark, d):
    return A.top_symbols(events(spark, d).where("is_event"), 5)


@query(METRICS + ",\nv as (select *, case when count(dollar_volume) over w >= 20 then avg(dollar_volume) over w end as mean_ from metrics window w as (partition by symbol order by date rows between 20 preceding and 1 preceding))\n---\nselect symbol, date, dollar_volume / nullif(mean_, 0) as rvol_day, mean_ is null or mean_ = 0 or dollar_volume is null as rvol_day_missing from v", "rvol_day", "date")
def rvol_day(spark, d):
    return R.rvol_day(R.daily_metrics(S.daily_bars(spark, d))).select("symbol", "date", "rvol_day", "rvol_day_missing")


@query(DAILY + ",\nv as (select *, case when count(volume) over w >= 5 then avg(volume) over w end as mean_ from daily window w as (partition by symbol order by date rows between 20 preceding and 1 preceding))\n---\nselect symbol, date, volume / (mean_ + 1e-9) as rvol from v", "rvol", "date")
def rvol_excluding_today(spark, d):
    return S.daily_bars(spark, d).select("symbol", "date", R.rvol_excluding_today().alias("rvol"))


@query(DAILY + ",\ns as (select symbol, date, coalesce(low <= 0.9 * lag(close) over w, false) as ssr_day from daily window w as (partition by symbol order by date))\n---\nselect *, coalesce(lag(ssr_day) over (partition by symbol order by date), false) as ssr_next from s", "", "date")
def ssr_daily(spark, d):
    return H.ssr_daily(S.daily_bars(spark, d)).select("symbol", "date", "ssr_day", "ssr_next")


@query(DAILY + "\n---\nselect symbol, date, lead(close, 5) over w / close - 1 as ret_fwd, max(high) over (w rows between 1 following and 5 following) / close - 1 as max_run from daily window w as (partition by symbol order by date)", "ret_fwd max_run", "date")
def forward_metrics(spark, d):
    return R.forward_metrics(S.daily_bars(spark, d)).select("symbol", "date", "ret_fwd", "max_run")


FLAT = METRICS.replace("rows between 20 preceding", "rows between 13 preceding").replace(">= 10 then avg(tr)", ">= 7 then avg(tr)") + """,
f1 as (select symbol, date, atr_pct, volume / nullif(case when count(volume) over w30 >= 10 then avg(volume) over w30 end, 0) as rvol30, list_sort(list(atr_pct) filter (atr_pct is not null) over w20) as xs
  from metrics window w30 as (partition by symbol order by date rows between 29 preceding and current row), w20 as (partition by symbol order by date rows between 19 preceding and current row)),
f2 as (select *, coalesce(atr_pct <= case when len(xs) >= 10 then xs[(round(0.25 * (len(xs) - 1)) + 1)::int] end and rvol30 <= 0.8, false) as is_quiet from f1),
flat as (select symbol, date, is_quiet, case when count(*) over w >= 10 then sum(is_quiet::int) over w end::bigint as n_quiet, coalesce(case when count(*) over w >= 10 then sum(is_quiet::int) over w end >= 4, false) as is_flat_base from f2
window w as (partition by symbol order by date rows between 19 preceding and current row))"""


@query(FLAT + "\n---\nselect * from flat", "", "date")
def flat_base(spark, d):
    return R.flat_base(S.daily_bars(spark, d), quiet_days=4).select("symbol", "date", "is_quiet", "n_quiet", "is_flat_base")


@query(DAILY + ",\ni as (select *, avg(close) over w as bb_mid, stddev_pop(close) over w as sd, close - lag(close) over s as c from daily window s as (partition by symbol order by date), w as (s rows between 19 preceding and current row))\n---\nselect symbol, date, bb_mid, bb_mid + 2 * sd as bb_up, bb_mid - 2 * sd as bb_low, case when count(c) over r = 14 then 100 * sum(greatest(c, 0)) over r / nullif(sum(greatest(c, 0)) over r + sum(greatest(-c, 0)) over r, 0) end as rsi14 from i window r as (partition by symbol order by date rows between 13 preceding and current row)", "bb_mid bb_up bb_low rsi14", "date")
def indicator_bands(spark, d):
    return X.indicators(S.daily_bars(spark, d)).select("symbol", "date", "bb_mid", "bb_up", "bb_low", "rsi14")


@query("recursive " + DAILY + """,
n as (select *, row_number() over (partition by symbol order by date) as i, volume / nullif(avg(volume) over (partition by symbol order by date rows between 20 preceding and 1 preceding), 0) as volume_ratio from daily),
e as (select symbol, i, close as fast, close as slow from n where i = 1 union all select n.symbol, n.i, e.fast * 11 / 13 + n.close * 2 / 13, e.slow * 25 / 27 + n.close * 2 / 27 from e join n on n.symbol = e.symbol and n.i = e.i + 1)
---
select symbol, date, volume_ratio, fast - slow as macd from n join e using (symbol, i)""", "volume_ratio macd", "date")
def indicator_macd(spark, d):
    return X.indicators(S.daily_bars(spark, d)).select("symbol", "date", "volume_ratio", "macd")


@query(METRICS + ",\nr as (select symbol, avg((high - low) / close * 100) as range, avg(abs(gap_pct)) as gap, avg(rvol) as rvol from metrics group by 1)\n---\nselect symbol, range, gap, rvol, (rank() over (order by range desc) + rank() over (order by gap desc) + rank() over (order by rvol desc))::int as total_rank from r order by total_rank, symbol limit 5", "range gap rvol")
def volatility_ranking(spark, d):
    return X.volatility_ranking(R.daily_metrics(S.daily_bars(spark, d)), 5)


@query(DAILY + ",\np as (select *, lag(close) over s as b, (close > open)::int as g from daily window s as (partition by symbol order by date)),\nq as (select *, sum(g) over w as past, count(*) over w as k from p window w as (partition by symbol order by date rows between 3 preceding and 1 preceding))\n---\nselect symbol, date, coalesce(open < b and close > b, false) as red_to_green, coalesce(open > b and close < b, false) as green_to_red, coalesce(k = 3 and past = 0 and g = 1, false) as first_green, coalesce(k = 3 and past = 3 and g = 0, false) as first_red from q", "", "date")
def pattern_screens(spark, d):
    out = X.pattern_screens(S.daily_bars(spark, d))
    return out.select("symbol", "date", "red_to_green", "green_to_red", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("first_green", "first_red")])


@query(DAILY + "\n---\nselect 'close' as metric, count(close) as count, avg(close) as mean, stddev_samp(close) as stddev, min(close) as min, quantile_cont(close, 0.25) as p25, quantile_cont(close, 0.5) as p50, quantile_cont(close, 0.75) as p75, max(close) as max from daily union all select 'volume', count(volume), avg(volume), stddev_samp(volume), min(volume), quantile_cont(volume, 0.25), quantile_cont(volume, 0.5), quantile_cont(volume, 0.75), max(volume) from daily", "mean stddev min p25 p50 p75 max")
def describe_daily(spark, d):
    return A.describe(S.daily_bars(spark, d), ("close", "volume"))


@query(DAILY + """,
s as (select symbol, min(date) as a, max(date) as b, count(*) as n, count_if(isodow(date) < 6) as have, count_if(close is null) as nulls, avg(close) as m, stddev_samp(close) as sd from daily group by 1),
e as (select symbol, count(*) as expected from (select symbol, unnest(generate_series(a, b, interval 1 day)) as x from s) where isodow(x) < 6 group by 1),
o as (select symbol, count(*) as n_outliers from daily join s using (symbol) where abs(close - m) > 4 * sd group by 1),
f as (select symbol, greatest(0.0, (expected - have) * 100.0 / nullif(expected, 0)) as missing_pct, nulls * 100.0 / n as null_pct, coalesce(n_outliers, 0) as n_outliers from s join e using (symbol) left join o using (symbol))
---
select *, missing_pct > 5 or null_pct > 1 or n_outliers > 0 as fail from f""", "missing_pct null_pct")
def dq_thresholds(spark, d):
    return Q.dq_thresholds(S.daily_bars(spark, d), sigma=4.0)


@query(DAILY + ",\nd as (select distinct date from daily), m as (select date, datediff('month', min(date_trunc('month', date)) over (), date_trunc('month', date)) as m from d), l as (select *, max(m) over () as last from m)\n---\nselect date, fold::int as fold, case when m - fold < 6 then 'train' when m - fold < 7 then 'valid' else 'test' end as part from (select date, m, last, unnest(range(greatest(0, m - 7), m + 1)) as fold from l) where fold + 7 <= last", "", "date")
def walk_forward(spark, d):
    return X.walk_forward(S.daily_bars(spark, d))


@query(DAILY + ",\nd as (select date, ntile(5) over (order by date) - 1 as own from (select distinct date from daily)), s as (select own as fold, min(date) as a, max(date) as b from d group by 1)\n---\nselect date, fold::int as fold, case when own = fold then 'test' else 'train' end as part from d cross join s where own = fold or not (date between a - 1 and b + 3)", "", "date")
def purged_folds(spark, d):
    return X.purged_folds(S.daily_bars(spark, d))


def splits(spark, d):
    """Each order as a split of its customer's symbol: those that are filled are reverse ones."""
    o = S.table(spark, d, "orders")
    odd = F.col("o_orderstatus") == "F"
    return o.select(F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("date"), F.when(odd, 10).otherwise(1).alias("split_from"), F.when(odd, 1).otherwise(3).alias("split_to"))


SPLITS = DAILY + ",\nsplits as (select o_custkey as symbol, o_orderdate::date as date, case when o_orderstatus = 'F' then 10 else 1 end as split_from, case when o_orderstatus = 'F' then 1 else 3 end as split_to from orders)"


@query(SPLITS + "\n---\nselect d.symbol, d.date, coalesce(exp(sum(case when s.date > d.date then ln(split_from / split_to) else 0 end)), 1) as factor, coalesce(bool_or(s.date = d.date and split_from > split_to), false) as is_reverse_day from daily d left join splits s on d.symbol = s.symbol group by 1, 2", "factor", "date")
def split_adjusted(spark, d):
    return X.split_adjusted(S.daily_bars(spark, d), splits(spark, d)).select("symbol", "date", "factor", "is_reverse_day")


@query(SPLITS + "\n---\nselect d.symbol, d.date, min(case when split_from > split_to and d.date >= s.date then datediff('day', s.date, d.date) end)::int as days_since_reverse_split, coalesce(count_if(datediff('day', s.date, d.date) between 0 and 365), 0)::bigint as splits_12m, coalesce(bool_or(abs(datediff('day', s.date, d.date)) <= 5), false) as action_nearby from daily d left join splits s on d.symbol = s.symbol group by 1, 2", "", "date")
def corporate_features(spark, d):
    return X.corporate_features(S.daily_bars(spark, d), splits(spark, d))


@query("q as (select o_custkey % 50 as symbol, date_trunc('quarter', o_orderdate)::date as period, sum(o_totalprice) as revenue, max(o_totalprice) as cash, min(o_totalprice) as debt, avg(o_totalprice) as equity, date_trunc('quarter', o_orderdate)::date + 45 as filed from orders group by 1, 2)\n---\nselect symbol, period, revenue / nullif(lag(revenue) over w, 0) - 1 as qoq, revenue / nullif(lag(revenue, 4) over w, 0) - 1 as yoy, lag(cash) over w - cash as burn, debt / nullif(equity, 0) as debt_to_equity, datediff('day', period, filed)::int as lag_days from q window w as (partition by symbol order by period)", "qoq yoy burn debt_to_equity", "period")
def fundamentals(spark, d):
    o = S.table(spark, d, "orders")
    q = o.groupBy((F.col("o_custkey") % 50).alias("symbol"), F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("period")).agg(F.sum("o_totalprice").alias("revenue"), F.max("o_totalprice").alias("cash"), F.min("o_totalprice").alias("debt"), F.avg("o_totalprice").alias("equity"))
    return X.fundamentals(q.withColumn("filed", F.date_add("period", 45))).select("symbol", "period", "qoq", "yoy", "burn", "debt_to_equity", "lag_days")


@query("t as (select o_orderpriority as pattern, o_orderdate as closed, o_orderkey as trade_id, o_totalprice - 200000 as pnl from orders), e as (select *, sum(pnl) over (partition by pattern order by closed, trade_id) as e from t), x as (select *, max(e) over (partition by pattern order by closed, trade_id) - e as dd from e)\n---\nselect pattern, count(*) as n, avg((pnl > 0)::int) as hit_rate, avg(pnl) as expectancy, sum(greatest(pnl, 0)) / nullif(sum(greatest(-pnl, 0)), 0) as profit_factor, avg(pnl) / nullif(stddev_samp(pnl), 0) as sharpe, round(max(dd), 2) as max_drawdown, quantile_cont(pnl, 0.05) as loss_p95 from x group by 1", "hit_rate expectancy profit_factor sharpe max_drawdown loss_p95")
def trade_metrics(spark, d):
    t = S.table(spark, d, "orders").select(F.col("o_orderpriority").alias("pattern"), F.col("o_orderdate").alias("closed"), F.col("o_orderkey").alias("trade_id"), (F.col("o_totalprice") - 200000).alias("pnl"))
    return X.trade_metrics(t).withColumn("max_drawdown", F.round("max_drawdown", 2))


@query("det as (select s_suppkey as ticker, case when s_suppkey % 7 <> 0 then s_acctbal * 1000000 end as market_cap from supplier), n as (select unnest(['nano', 'micro', 'small', 'mid', 'large']) as bracket), c as (select case when market_cap >= 1e10 then 'large' when market_cap >= 2e9 then 'mid' when market_cap >= 3e8 then 'small' when market_cap >= 5e7 then 'micro' else 'nano' end as bracket, count(*) as n from det where market_cap is not null group by 1)\n---\nselect bracket, coalesce(c.n, 0) as n, coalesce(c.n, 0) * 100.0 / sum(coalesce(c.n, 0)) over () as pct from n left join c using (bracket)", "pct")
def cap_brackets(spark, d):
    return A.cap_brackets(S.details(spark, d))


@query("det as (select case when s_suppkey % 7 <> 0 then s_acctbal * 1000000 end as c from supplier)\n---\nselect min(c) as min, max(c) as max, avg(c) as mean, quantile_cont(c, 0.5) as median, count_if(c < 2e9)::bigint as n_small, count_if(c is null)::bigint as n_unknown from det", "min max mean median")
def cap_summary(spark, d):
    return A.cap_summary(S.details(spark, d))


# Both metrics tables are called the same, so the breakouts' SQL takes the flat days from a table of its own.
FLAT_DAYS = EVENTS + ",\n" + FLAT[len(DAILY) + 2 :].replace("m1 as", "g1 as").replace("from m1", "from g1").replace("m2 as", "g2 as").replace("from m2", "from g2").replace("metrics as", "gmetrics as").replace("from metrics", "from gmetrics")


@query(FLAT_DAYS + ",\nz as (select f.symbol, f.date, coalesce(lag(is_flat_base) over (partition by f.symbol order by f.date), false) as had, (max(high) over (partition by f.symbol order by f.date rows between 1 following and 5 following) / close - 1) * 100 as run from flat f join daily using (symbol, date))\n---\nselect symbol, date, had as had_flat_base, run as max_run_pct, coalesce(run >= 100, false) as big_run, had and (is_ire or is_vswg) as is_flat_base_breakout from ev join z using (symbol, date) where is_event", "max_run_pct", "date")
def flat_base_breakouts(spark, d):
    base = R.flat_base(S.daily_bars(spark, d), quiet_days=4)
    return X.flat_base_breakouts(events(spark, d).where("is_event"), base).select("symbol", "date", "had_flat_base", "max_run_pct", "big_run", "is_flat_base_breakout")
