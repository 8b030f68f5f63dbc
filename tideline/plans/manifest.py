"""Queries on enrichment, deduplication, normalisation and the selection cascade."""

from pyspark.sql import functions as F

from tideline.config import ManifestConfig, SessionLimits
from tideline.operators import detectors as D
from tideline.operators import features as X
from tideline.operators import joins as J
from tideline.operators import rolling as R
from tideline.operators import selection as L
from tideline.sources import adapters as S
from tideline.sources import bars as B

from .catalog import et, minute, query, session
from .intraday import CFG, COLUMNS

LOW = SessionLimits(300, 20, 5000, 0.8, 1.5)
MANIFEST = ManifestConfig(min_score=0.3, limits={"RTH": SessionLimits(500, 30, 8000, 0.9, 1.2), "PM": LOW, "AH": LOW}, per_symbol_month=60, per_symbol_day=6, per_symbol=50, max_events=180, events_range=(100, 400), min_symbols=3, min_rvol_median=1.0)


def events(spark, d):
    return D.intraday_events(S.bars(spark, d), CFG)


def day_metrics(spark, d):
    """Daily dollar volume of the intraday bars by New York day, with rvol_day over 5 days."""
    b = S.bars(spark, d).withColumn("date", F.to_date(F.from_utc_timestamp("timestamp", "America/New_York")))
    daily = b.groupBy("symbol", "date").agg(F.sum(F.col("close") * F.col("volume")).alias("dollar_volume"))
    return R.rvol_day(daily, 5)


def scored(spark, d):
    return R.average_rank_cdf(L.enriched(events(spark, d), day_metrics(spark, d)))


DAYS = COLUMNS + f""",
dd as (select symbol, ({et('timestamp')})::date as date, sum(close * volume) as dollar_volume from bars group by 1, 2),
dm as (select *, dollar_volume / nullif(case when count(*) over w >= 5 then avg(dollar_volume) over w end, 0) as rvol_day from dd window w as (partition by symbol order by date rows between 5 preceding and 1 preceding)),
en as (select e.* exclude (dollar_volume, date), e.date, ({et('e.timestamp')})::date as date_et, dm.dollar_volume as dollar_volume_day, dm.rvol_day, dm.rvol_day is null as rvol_day_missing, (high + low + close) / 3 as vwap_min, volume * (high + low + close) / 3 as dollar_volume_bar, (high - low) / nullif((high + low + close) / 3, 0) as spread_proxy
  from events_ e left join dm on e.symbol = dm.symbol and ({et('e.timestamp')})::date = dm.date),
rk as (select * exclude (score), score as score_raw, rank() over (partition by event_type, session order by score) + (count(*) over (partition by event_type, session, score) - 1) / 2 as rk from en where score is not null),
sc as (select *, case when max(rk) over g <= 1 then 0.5 else (rk - 1) / (max(rk) over g - 1) end as score from rk window g as (partition by event_type, session))"""
ORDER = "score desc nulls first, rvol_day desc nulls first, dollar_volume_bar desc nulls first, timestamp, symbol, event_type"


def _tests(x: SessionLimits) -> str:
    return f"(dollar_volume_bar >= {x.dollar_volume_bar} and volume >= {x.volume_bar} and dollar_volume_day >= {x.dollar_volume_day} and coalesce(rvol_day >= {x.rvol_day}, true) and spread_proxy <= {x.spread})"


_WHY = "case session " + " ".join(f"when '{s}' then case when {_tests(x)} then null when not {_tests(x)} then '{s}_liquidity' else 'null_metric' end" for s, x in MANIFEST.limits.items()) + " else 'unknown_session' end"
CASCADE = DAYS + f""",
c0 as (select *, {_WHY} as why from sc),
c1 as (select *, case when not coalesce(score >= 0.3, false) then 'stage1_quality' when why is not null then 'stage2_liquidity' end as st, case when not coalesce(score >= 0.3, false) then 'low_score' else why end as re from c0),
c2 as (select *, case when st is null then row_number() over (partition by symbol, year(timestamp), month(timestamp), st is null order by {ORDER}) end as r1 from c1),
c3 as (select * replace (case when st is null and r1 > 60 then 'stage3_month_cap' else st end as st, case when st is null and r1 > 60 then 'cap_symbol_month' else re end as re) from c2),
c4 as (select *, case when st is null then row_number() over (partition by symbol, timestamp::date, st is null order by {ORDER}) end as r2 from c3),
c5 as (select * replace (case when st is null and r2 > 6 then 'stage3b_day_cap' else st end as st, case when st is null and r2 > 6 then 'cap_symbol_day' else re end as re) from c4),
c6 as (select *, case when st is null then row_number() over (partition by symbol, st is null order by {ORDER}) end as r3 from c5),
c7 as (select * replace (case when st is null and r3 > 50 then 'stage5_symbol_cap' else st end as st, case when st is null and r3 > 50 then 'cap_symbol_total' else re end as re) from c6),
c8 as (select *, case when st is null then row_number() over (partition by st is null order by {ORDER}) end as r4 from c7),
cascade_ as (select * replace (case when st is null and r4 > 180 then 'stage5_global_cap' else st end as st, case when st is null and r4 > 180 then 'global_cap' else re end as re) from c8),
kept as (select * from cascade_ where st is null)"""


def flagged(spark, d):
    return L.cascade(scored(spark, d), MANIFEST)


def kept(spark, d):
    return flagged(spark, d).where("descarte_stage is null")


@query(DAYS + "\n---\nselect symbol, timestamp, event_type, dollar_volume_day, rvol_day, rvol_day_missing, vwap_min, dollar_volume_bar, spread_proxy from en", "dollar_volume_day rvol_day vwap_min dollar_volume_bar spread_proxy", "", "timestamp")
def enriched_events(spark, d):
    return L.enriched(events(spark, d), day_metrics(spark, d)).select("symbol", "timestamp", "event_type", "dollar_volume_day", "rvol_day", "rvol_day_missing", "vwap_min", "dollar_volume_bar", "spread_proxy")


@query(DAYS + "\n---\nselect symbol, timestamp, event_type, score_raw, score from sc", "score_raw score", "", "timestamp")
def normalised_scores(spark, d):
    return scored(spark, d).select("symbol", "timestamp", "event_type", "score_raw", "score")


@query(CASCADE + "\n---\nselect symbol, timestamp, event_type, r1::int as rank_symbol_month, r2::int as rank_symbol_day, r3::int as rank_symbol_total, st as descarte_stage, re as descarte_reason from cascade_", "", "", "timestamp")
def manifest_cascade(spark, d):
    return flagged(spark, d).select("symbol", "timestamp", "event_type", "rank_symbol_month", "rank_symbol_day", "rank_symbol_total", "descarte_stage", "descarte_reason")


@query(CASCADE + "\n---\nselect coalesce(st, 'kept') as stage, coalesce(re, '') as reason, count(*) as n from cascade_ group by 1, 2")
def discard_attribution(spark, d):
    return L.attribution(flagged(spark, d))


@query(CASCADE + "\n---\nselect symbol, timestamp, event_type, descarte_stage, margin from (select *, st as descarte_stage, case when re = 'low_score' then 0.3 - score end as margin from cascade_) where descarte_stage is not null", "margin", "", "timestamp")
def discard_margins(spark, d):
    return L.discard_margin(flagged(spark, d), MANIFEST).select("symbol", "timestamp", "event_type", "descarte_stage", "margin")


@query(CASCADE + ",\nq(session, low, high) as (values ('PM', 0.10, 0.20), ('RTH', 0.75, 0.85), ('AH', 0.03, 0.10)), s as (select q.session, coalesce(c.n, 0) as n, low, high, coalesce(c.n / nullif((select count(*) from kept), 0), 0.0) as share from q left join (select session, count(*) as n from kept group by 1) c using (session))\n---\nselect session, n, share, low, high, case when share < low then 'below' when share > high then 'above' else 'ok' end as verdict from s", "share low high")
def session_quotas(spark, d):
    return L.session_quotas(kept(spark, d), MANIFEST)


@query(CASCADE + """,
k as (select count(*)::double as n, count(distinct symbol) as symbols, quantile_cont(score, 0.5) as score, quantile_cont(rvol_day, 0.5) as rvol, coalesce(avg((session = 'PM')::int), 0) as pm, coalesce(avg((session = 'RTH')::int), 0) as rth, coalesce(avg((session = 'AH')::int), 0) as ah, coalesce((select sum(c) from (select count(*) as c from kept group by symbol order by c desc, symbol limit 20)) / nullif(count(*), 0)::double, 0.0) as top from kept)
---
select unnest(['total_events', 'symbols', 'score_median', 'rvol_median', 'top20_share', 'share_PM', 'share_RTH', 'share_AH', 'storage_gb_p90', 'time_days_p90']) as name,
  unnest([n, symbols, score, rvol, top, pm, rth, ah, n * 37.0 / 1024, n * 33.0 / 86400]) as value,
  unnest([n between 100 and 400, symbols >= 3, coalesce(score >= 0.7, false), coalesce(rvol >= 1.0, false), top <= 0.25, pm between 0.10 and 0.20, rth between 0.75 and 0.85, ah between 0.03 and 0.10, n * 37.0 / 1024 <= 250, n * 33.0 / 86400 <= 3]) as ok from k""", "value")
def sanity_checks(spark, d):
    return L.sanity_checks(kept(spark, d), MANIFEST)


@query(CASCADE + "\n---\nselect 'event_type' as section, event_type as value, count(*) as n from kept group by 2 union all select 'session', session, count(*) from kept group by 2 union all (select 'top20', symbol, count(*) as n from kept group by 2 order by 3 desc, 2 limit 20)")
def manifest_summary(spark, d):
    return L.manifest_summary(kept(spark, d))


@query(CASCADE + "\n---\nselect count(*) as n_events, count(distinct symbol) as n_symbols, min(timestamp) as first_ts, max(timestamp) as last_ts, quantile_cont(score, 0.5) as score_median, avg((session = 'PM')::int) as share_pm, avg((session = 'RTH')::int) as share_rth, avg((session = 'AH')::int) as share_ah, count(*) * 37.0 / 1024 as storage_gb_p90 from kept", "score_median share_pm share_rth share_ah storage_gb_p90", "", "first_ts last_ts")
def freeze_metadata(spark, d):
    return L.freeze_metadata(kept(spark, d), MANIFEST)


DUPES = COLUMNS + """,
du as (select symbol, time_bucket(interval 6 hours, timestamp) as timestamp, event_type, direction, session, case when volume % 5 > 0 then score end as score, case when volume % 3 > 0 then spike_x end as spike_x from hits)"""


def dupes(spark, d):
    """Events with their times truncated to six hours: many share a key; some have no score or no spike."""
    h = D.detected(S.bars(spark, d), CFG)
    return h.select("symbol", F.window("timestamp", "6 hours").start.alias("timestamp"), "event_type", "direction", "session", F.when(F.col("volume") % 5 > 0, F.col("score")).alias("score"), F.when(F.col("volume") % 3 > 0, F.col("spike_x")).alias("spike_x"))


@query(DUPES + ",\nx as (select *, (direction is null)::int + (session is null)::int + (score is null)::int + (spike_x is null)::int as nulls_ from du)\n---\nselect symbol, timestamp, event_type, direction, score, spike_x from x qualify row_number() over (partition by symbol, timestamp, event_type order by score desc nulls last, nulls_, direction, spike_x) = 1", "score spike_x", "", "timestamp")
def exact_dedup(spark, d):
    return L.exact_dedup(dupes(spark, d), tie=("direction", "spike_x")).select("symbol", "timestamp", "event_type", "direction", "score", "spike_x")


@query(DUPES + ",\na as (select count(*) as n_before, count(distinct (symbol, timestamp, event_type)) as k, count(distinct symbol) as n_symbols from du)\n---\nselect n_before, k as n_after, k as n_keys, n_symbols, n_before - k as removed, (n_before - k) * 100.0 / nullif(n_before, 0) as removed_pct, k - (select count(*) from (select distinct symbol, timestamp, event_type from (select * from du qualify row_number() over (partition by symbol, timestamp, event_type order by score desc nulls last) = 1))) as residual from a", "removed_pct")
def dedup_stats(spark, d):
    x = dupes(spark, d)
    return L.dedup_stats(x, L.exact_dedup(x))


@query(DUPES + ",\nu as (select symbol, timestamp, event_type, direction, score, spike_x, session from du union all select symbol, timestamp, event_type, direction, score, spike_x, null from du), x as (select *, (direction is null)::int + (session is null)::int + (score is null)::int + (spike_x is null)::int as nulls_ from u), rr as (select * from x qualify row_number() over (partition by symbol, timestamp, event_type order by score desc nulls last, nulls_, direction, spike_x) = 1)\n---\nselect event_type, count(*) as n, count(session) as n_session, sum(score) as score from rr group by 1", "score")
def consolidated_runs(spark, d):
    """Two runs with different columns: a diagonal union, then exact dedup."""
    x = dupes(spark, d)
    out = L.exact_dedup(B.aligned_union(x, x.drop("session")), tie=("direction", "spike_x"))
    return out.groupBy("event_type").agg(F.count("*").alias("n"), F.count("session").alias("n_session"), F.sum("score").alias("score"))


PRIORITY = ("volume_spike", "vwap_break", "opening_range_break", "price_momentum", "consolidation_break", "flush")
_BEST = "score desc nulls last, timestamp, event_type, direction"
PROFILE = COLUMNS + f""",
p0 as (select * from events_ where session in ('PM', 'RTH', 'AH') and score >= 1.0 and dollar_volume >= 300 and volume >= 20 and (high - low) / nullif(close, 0) * 100 <= 150),
p1 as (select * from p0 qualify row_number() over (partition by symbol, date order by {_BEST}) <= 4),
p2 as (select * from p1 qualify row_number() over (partition by symbol order by {_BEST}) <= 60)"""


def profile(spark, d, most, buckets=None):
    return L.profile_manifest(events(spark, d), ("PM", "RTH", "AH"), 1.0, SessionLimits(300, 20, 0, 0, 1.5), 4, 60, PRIORITY, most, buckets)


@query(PROFILE + f"\n---\nselect symbol, timestamp, event_type, score, coalesce(list_position(['volume_spike', 'vwap_break', 'opening_range_break', 'price_momentum', 'consolidation_break', 'flush'], event_type), 7)::bigint as priority from p2 order by 5, {_BEST}, symbol limit 100", "score", "", "timestamp")
def profile_manifest(spark, d):
    return profile(spark, d, 100).select("symbol", "timestamp", "event_type", "score", F.col("priority").cast("long").alias("priority"))


@query(PROFILE + f""",
b as (select *, case when {minute()} between 570 and 614 then '0930-1015' when {minute()} between 615 and 839 then '1015-1400' when {minute()} between 840 and 959 then '1400-1600' when {minute()} between 240 and 569 then '0400-0930' when {minute()} between 960 and 1199 then '1600-2000' end as bucket from p2)
---
select symbol, timestamp, event_type, bucket from b where bucket is not null qualify row_number() over (partition by bucket order by score desc nulls last, timestamp, symbol, event_type, direction) <= case bucket when '0930-1015' then 20 when '1015-1400' then 28 when '1400-1600' then 20 when '0400-0930' then 8 else 4 end""", "", "", "timestamp")
def bucket_quotas(spark, d):
    return profile(spark, d, 80, {"0930-1015": 0.25, "1015-1400": 0.35, "1400-1600": 0.25, "0400-0930": 0.10, "1600-2000": 0.05}).select("symbol", "timestamp", "event_type", "bucket")


@query(PROFILE + f"\n---\nselect symbol, date, event_type, row_number() over (partition by symbol, date order by {_BEST})::int as rank from events_ qualify row_number() over (partition by symbol, date order by {_BEST}) <= 3", "", "date")
def top_per_day(spark, d):
    return L.top_per_group(events(spark, d), ("symbol", "date"), 3, [F.desc_nulls_last("score"), F.asc("timestamp"), F.asc("event_type"), F.asc("direction")]).select("symbol", "date", "event_type", "rank")


_DRAWN = "md5(concat_ws('|', 42, symbol, epoch_us(timestamp), event_type))"


@query(COLUMNS + f""",
rk_ as (select symbol, row_number() over (order by count(*) desc, symbol) - 1 as rank from events_ group by 1), st_ as (select symbol, case when rank < 2 then 'top' when rank < 5 then 'rest' end as stratum from rk_ where rank < 5)
---
select stratum, symbol, timestamp, event_type from events_ join st_ using (symbol) qualify row_number() over (partition by stratum order by {_DRAWN}, symbol, timestamp, event_type) <= 10""", "", "", "timestamp")
def stratified_sample(spark, d):
    e = events(spark, d)
    ranking = e.groupBy("symbol").agg(F.count("*").alias("n")).selectExpr("symbol", "row_number() over (order by n desc, symbol) - 1 as rank")
    return L.stratified_sample(e, ranking, [("top", 0, 2), ("rest", 2, 5)], 10).select("stratum", "symbol", "timestamp", "event_type")


@query(DAYS + """,
n as (select coalesce(count_if(dollar_volume_bar >= 4000 and spread_proxy <= 0.5), 0) as a, coalesce(count_if(dollar_volume_bar >= 3600 and spread_proxy <= 0.5), 0) as b, coalesce(count_if(dollar_volume_bar >= 3600 and spread_proxy <= 1.0), 0) as c from en where session = 'PM')
---
select case when a >= 40 then 0 when b >= 40 then 1 else 2 end::int as level, case when a >= 40 then a when b >= 40 then b else c end::bigint as n from n""")
def relaxed_level(spark, d):
    levels = [SessionLimits(dollar_volume_bar=4000, spread=0.5), SessionLimits(dollar_volume_bar=3600, spread=0.5), SessionLimits(dollar_volume_bar=3600, spread=1.0)]
    return L.relaxed_level(L.enriched(events(spark, d), day_metrics(spark, d)), "PM", 40, levels)


@query(DAYS + ",\nq as (select quantile_cont(dollar_volume_bar, 0.6) as a, quantile_cont(rvol_day, 0.6) as b from en)\n---\nselect symbol, timestamp, event_type, row_number() over (partition by strftime(timestamp, '%Y-%m') order by dollar_volume_bar desc, symbol, timestamp, event_type)::int as rank_month from en, q where dollar_volume_bar > a and rvol_day > b and dollar_volume_day > 5000 qualify row_number() over (partition by strftime(timestamp, '%Y-%m') order by dollar_volume_bar desc, symbol, timestamp, event_type) <= 30", "", "", "timestamp")
def l2_selection(spark, d):
    e = L.enriched(events(spark, d), day_metrics(spark, d)).withColumn("liquidity_score", F.col("dollar_volume_bar"))
    return X.l2_selection(e, 0.6, 5000, 30).select("symbol", "timestamp", "event_type", "rank_month")


@query(CASCADE + f""",
lim(session, dvb, vol, dvd, rv, sp) as (values {", ".join(f"('{s}', {x.dollar_volume_bar}, {x.volume_bar}, {x.dollar_volume_day}, {x.rvol_day}, {x.spread})" for s, x in MANIFEST.limits.items())}),
mi as (select c.*, case when re = 'low_score' then 'score' when st = 'stage2_liquidity' then case when dollar_volume_bar < dvb then 'dollar_volume_bar' when volume < vol then 'volume' when dollar_volume_day < dvd then 'dollar_volume_day' when rvol_day < rv then 'rvol_day' when spread_proxy > sp then 'spread_proxy' end
  when st = 'stage3_month_cap' then 'rank_symbol_month' when st = 'stage3b_day_cap' then 'rank_symbol_day' when st = 'stage5_symbol_cap' then 'rank_symbol_total' end as miss_field, lim.* exclude (session) from cascade_ c left join lim using (session) where st is not null)
---
select symbol, timestamp, event_type, miss_field, case miss_field when 'score' then score when 'dollar_volume_bar' then dollar_volume_bar when 'volume' then volume when 'dollar_volume_day' then dollar_volume_day when 'rvol_day' then rvol_day when 'spread_proxy' then spread_proxy when 'rank_symbol_month' then r1 when 'rank_symbol_day' then r2 when 'rank_symbol_total' then r3 end as miss_value,
  case miss_field when 'score' then 0.3 when 'dollar_volume_bar' then dvb when 'volume' then vol when 'dollar_volume_day' then dvd when 'rvol_day' then rv when 'spread_proxy' then sp when 'rank_symbol_month' then 60 when 'rank_symbol_day' then 6 when 'rank_symbol_total' then 50 end as miss_limit from mi""", "miss_value miss_limit", "", "timestamp")
def stage_margins(spark, d):
    return L.stage_margins(flagged(spark, d), MANIFEST).select("symbol", "timestamp", "event_type", "miss_field", "miss_value", "miss_limit")


@query(CASCADE + f""",
di as (select * from cascade_ where st is not null), si as (select event_type, session, ceil(count(*) * 200.0 / (select count(*) from di)) as quota from di group by 1, 2)
---
select symbol, timestamp, event_type, session, st as descarte_stage from di join si using (event_type, session) qualify row_number() over (partition by event_type, session order by {_DRAWN}, symbol, timestamp, event_type) <= quota""", "", "", "timestamp")
def discard_sample(spark, d):
    """A sample of the discarded events, each type and session with its share."""
    out = L.proportional_sample(flagged(spark, d).where("descarte_stage is not null"), ("event_type", "session"), 200)
    return out.select("symbol", "timestamp", "event_type", "session", "descarte_stage")


@query(COLUMNS + "\n---\nselect symbol, n, rank from (select symbol, count(*) as n, row_number() over (order by count(*) desc, symbol)::int as rank from events_ group by 1) where rank between 2 and 4")
def rank_slice(spark, d):
    n = events(spark, d).groupBy("symbol").agg(F.count("*").alias("n")).selectExpr("symbol", "n", "row_number() over (order by n desc, symbol) as rank")  # one row per symbol
    return L.rank_slice(n, 1, 3)


@query(DAYS + f""",
b0 as (select coalesce(count_if(session is distinct from {session('timestamp')}), 0)::double as tz, quantile_cont(dollar_volume_bar, 0.5) as dv, quantile_cont(spread_proxy, 0.5) as sp, avg((spike_x is not null)::int) as ssr, avg(close) as price, avg(rvol_day) as rvol from en)
---
select unnest(['timezone', 'dollar_volume_median', 'spread_median', 'ssr_present', 'price_mean', 'rvol_mean']) as name, unnest([tz, dv, sp, ssr, price, rvol]) as value, unnest([tz = 0, coalesce(dv >= 3000, false), coalesce(sp <= 0.9, false), coalesce(ssr = 1, false), coalesce(price between 5 and 100, false), coalesce(rvol >= 1.2, false)]) as ok from b0""", "value")
def recommended_checks(spark, d):
    from tideline.operators import quality as Q

    return Q.recommended_checks(L.enriched(events(spark, d), day_metrics(spark, d)), ssr="spike_x", min_dollar_volume=3000, max_spread=0.9, min_rvol=1.2)


DETAILS = "det as (select s_suppkey as ticker, case when s_suppkey % 7 <> 0 then s_acctbal * 1000000 end as market_cap from supplier), li as (select distinct l_suppkey as ticker from lineitem)"


@query(DETAILS + "\n---\nselect ticker, market_cap from li left join det using (ticker) where market_cap is null or market_cap < 2e9", "market_cap")
def small_caps(spark, d):
    return J.with_market_cap(S.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("ticker")).distinct(), S.details(spark, d))


@query("u as (select distinct o_custkey as symbol from orders where o_orderstatus = 'P')\n---\nselect c_custkey as symbol from customer where c_custkey not in (select symbol from u)")
def missing_symbols(spark, d):
    return J.missing(S.table(spark, d, "customer").select(F.col("c_custkey").alias("symbol")), S.table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("symbol")), "symbol")


@query("a as (select distinct c_custkey as symbol from customer where c_acctbal > 0), b as (select distinct o_custkey as symbol from orders where o_orderstatus = 'P')\n---\nselect case when a.symbol is null then 'right_only' when b.symbol is null then 'left_only' else 'both' end as side, count(*) as n from a full join b using (symbol) group by 1")
def coverage_sides(spark, d):
    a = S.table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("symbol"))
    return J.coverage(a, S.table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("symbol")), "symbol")


@query("e as (select o_custkey as symbol, count(*) as expected from orders group by 1), f as (select o_custkey as symbol, count(*) as done from orders where o_orderstatus = 'F' group by 1)\n---\nselect symbol, expected, coalesce(done, 0) as done, coalesce(done, 0) * 100.0 / expected as pct, coalesce(done, 0) >= expected as is_complete from e left join f using (symbol)", "pct")
def completeness(spark, d):
    o = S.table(spark, d, "orders").withColumnRenamed("o_custkey", "symbol")
    return J.completeness(o, o.where("o_orderstatus = 'F'"))


_PROXY = "case session " + " ".join(f"when '{s}' then case when {{0}} then null when not {{0}} then '{s}_liquidity' else 'null_metric' end".format(f"(dollar_volume_bar >= {x.dollar_volume_bar} and volume >= {x.volume_bar} and spread_proxy <= {x.spread})") for s, x in MANIFEST.limits.items()) + " else 'unknown_session' end"


@query(CASCADE.replace(_WHY, _PROXY) + "\n---\nselect coalesce(st, 'kept') as stage, coalesce(re, '') as reason, count(*) as n from cascade_ group by 1, 2")
def proxy_cascade(spark, d):
    """The cascade without daily metrics: three tests."""
    return L.attribution(L.cascade(scored(spark, d), MANIFEST, ("dollar_volume_bar", "volume", "spread_proxy")))
