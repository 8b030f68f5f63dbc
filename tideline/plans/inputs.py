"""Queries on inputs as vendors deliver them, on restricted universes, and on options that are off by default."""

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from tideline.functions import scalars as C
from tideline.functions import time as M
from tideline.operators import detectors as D
from tideline.operators import features as X
from tideline.operators import halts as H
from tideline.operators import joins as J
from tideline.operators import quality as Q
from tideline.sources import adapters as S
from tideline.sources import bars as B
from tideline.sources.ledger import Ledger
from tideline.storage import saved, shared_folder

from . import audit, intraday
from .catalog import BARS, DAILY, TICKS, et, query
from .intraday import COLUMNS


@query(BARS + "\n---\nselect symbol, timestamp, open::float as open, high::float as high, low::float as low, close::float as close, vwap::float as vwap, volume, date from bars", "open high low close vwap", "date", "timestamp")
def normalised_bars(spark, d):
    """Bars under the vendor's names and epoch milliseconds."""
    b = S.bars(spark, d)
    raw = b.select("symbol", F.unix_millis("timestamp").alias("t"), *[F.col(c).alias(v) for v, c in B.BAR_NAMES.items() if v not in ("t", "n")])
    return B.normalised_bars(raw).select("symbol", "timestamp", "open", "high", "low", "close", "vwap", "volume", "date")


@query(TICKS + "\n---\nselect event_id, epoch_us(timestamp) * 1000 as timestamp_ns, epoch_us(timestamp) * 1000 + 7 as exchange_timestamp_ns, timestamp, price, size from ticks where symbol = 'purchase'", "price", "", "timestamp")
def normalised_trades(spark, d):
    t = S.trades(spark, d)
    raw = t.select("event_id", (F.unix_micros("timestamp") * 1000).alias("sip_timestamp"), (F.unix_micros("timestamp") * 1000 + 7).alias("participant_timestamp"), "price", "size")
    return B.normalised_ticks(raw).select("event_id", "timestamp_ns", "exchange_timestamp_ns", "timestamp", "price", "size")


@query(TICKS + "\n---\nselect event_id, epoch_us(timestamp) * 1000 as timestamp_ns, timestamp, price * 0.99 as bid_price, price * 1.01 as ask_price, size as bid_size, 100 - size as ask_size, null::varchar as conditions from ticks where symbol = 'view'", "bid_price ask_price", "", "timestamp")
def normalised_quotes(spark, d):
    q = S.quotes(spark, d)
    raw = q.select("event_id", (F.unix_micros("timestamp") * 1000).alias("sip_timestamp"), "bid_price", "ask_price", "bid_size", "ask_size")
    return B.normalised_quotes(raw).select("event_id", "timestamp_ns", "timestamp", "bid_price", "ask_price", "bid_size", "ask_size", "conditions")


def halt_lines(spark, d):
    """Halts as the pipe-delimited text of an exchange, with its header."""
    h = S.halts(spark, d)
    day, clock = (lambda c: F.date_format(c, "MM/dd/yyyy")), (lambda c: F.date_format(c, "HH:mm:ss"))
    line = F.concat_ws("|", day("halt_timestamp"), clock("halt_timestamp"), F.concat(F.lit(" u"), F.col("symbol")), F.lit("a name"), F.lit("NASDAQ"), F.when(F.col("resume_timestamp").isNull(), "t1").otherwise("LUDP"), F.lit(""), F.coalesce(day("resume_timestamp"), F.lit("")), F.coalesce(clock("resume_timestamp"), F.lit("")))
    header = spark.createDataFrame([("Halt Date|Halt Time|Issue Symbol|Issue Name|Market|Reason Codes|Pause Threshold Price|Resumption Date|Resumption Time",)], "value string")
    return h.select(line.alias("value")).unionByName(header)


HALTS = TICKS + ",\nhl as (select 'U' || user_id as symbol, date_trunc('second', timestamp) as a, case when event_id % 2 = 1 then date_trunc('second', timestamp + interval 20 minutes) end as b from ticks where symbol = 'error')"


@query(HALTS + "\n---\nselect symbol, a as halt_timestamp, b is null as is_open, case when b is null then 'T1' else 'LUDP' end as reason_code, (epoch(b) - epoch(a)) / 60 as halt_duration_minutes from hl", "halt_duration_minutes", "", "halt_timestamp")
def official_halt_lines(spark, d):
    return B.official_halts(halt_lines(spark, d)).select("symbol", "halt_timestamp", F.col("resume_timestamp").isNull().alias("is_open"), "reason_code", "halt_duration_minutes")


@query(HALTS + "\n---\nselect case when b is null then 'T1' else 'LUDP' end as reason_code, count(*) as n_halts, avg((epoch(b) - epoch(a)) / 60) as mean_minutes from hl group by 1", "mean_minutes")
def halt_summary(spark, d):
    return B.halt_summary(B.official_halts(halt_lines(spark, d)))


@query("select o_custkey as symbol, o_orderkey as k, o_orderdate::date as settlement_date, o_orderdate::date + 7 as publish_date, o_totalprice as short_interest from orders", "short_interest", "settlement_date publish_date")
def short_interest(spark, d):
    o = S.table(spark, d, "orders").select(F.col("o_custkey").alias("symbol"), F.col("o_orderkey").alias("k"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("settlement_date"), F.col("o_totalprice").alias("short_interest"))
    return B.short_interest(o).select("symbol", "k", "settlement_date", "publish_date", "short_interest")


@query("select l_suppkey as symbol, l_shipdate::date as date, sum(l_quantity)::bigint as short_volume, null::bigint as total_volume from lineitem group by 1, 2", "", "date")
def short_volume(spark, d):
    v = S.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("symbol"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("date")).agg(F.sum("l_quantity").cast("long").alias("short_volume"))
    return B.short_volume(v).select("symbol", "date", "short_volume", "total_volume")


@query("select c_name as ticker from customer where c_mktsegment <> 'MACHINERY' and c_nationkey % 5 <> 0 and not contains(upper(c_name), 'ADR')")
def universe_filter(spark, d):
    """Customers as securities: one segment is no common stock, some nations trade over the counter."""
    c = S.table(spark, d, "customer")
    x = c.select(F.col("c_name").alias("ticker"), F.col("c_name").alias("name"), F.when(F.col("c_mktsegment") == "MACHINERY", "ETF").otherwise("CS").alias("type"), F.when(F.col("c_nationkey") % 5 == 0, "otc").otherwise("stocks").alias("market"))
    return C.universe(x).select("ticker")


@query("select count(*) as n_rows, sum(('0x' || md5(strlen(o_orderkey::varchar) || ':' || o_orderkey || strlen(o_custkey::varchar) || ':' || o_custkey || strlen(o_orderstatus) || ':' || o_orderstatus)[1:15])::bigint)::varchar as fingerprint from orders")
def data_fingerprint(spark, d):
    return C.data_fingerprint(S.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")).withColumn("fingerprint", F.col("fingerprint").cast("string"))


@query("x as (select distinct o_custkey as s from orders where o_orderstatus = 'F')\n---\nselect c_custkey as symbol, c_acctbal as revenue from customer where c_custkey in (select s from x)", "revenue")
def manifest_fundamentals(spark, d):
    """Fundamentals of the symbols that a manifest names."""
    f = S.table(spark, d, "customer").select(F.col("c_custkey").alias("symbol"), F.col("c_acctbal").alias("revenue"))
    return J.restricted(f, S.table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("symbol")), "symbol")


_ID = "symbol || '_' || 'tick' || '_' || strftime(timestamp, '%Y%m%d_%H%M%S') || '_' || sha1(symbol || '|tick|' || strftime(timestamp, '%Y-%m-%dT%H:%M:%S'))[1:8]"


@query(TICKS + f",\ni as (select event_id, size, {_ID} as id from ticks)\n---\nselect event_id, id from i where id not in (select id from i where size > 50)")
def pending_events(spark, d):
    """Events whose canonical id is not among those that are done."""
    t = S.ticks(spark, d).withColumn("id", C.event_id(F.col("symbol"), F.lit("tick"), F.col("timestamp")))
    return J.missing(t, t.where("size > 50").select("id"), "id").select("event_id", "id")


@query("det as (select s_suppkey as ticker, case when s_suppkey % 7 <> 0 then s_acctbal * 1000000 end as market_cap from supplier), li as (select distinct l_suppkey as ticker from lineitem)\n---\nselect count(*) as n_symbols, count(market_cap) as n_with, coalesce(count_if(market_cap is null), 0)::bigint as n_without, coalesce(count_if(market_cap < 2e9), 0)::bigint as n_under, coalesce(count_if(market_cap >= 2e9), 0)::bigint as n_over from li left join det using (ticker)")
def small_cap_audit(spark, d):
    return J.cap_audit(S.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("ticker")).distinct(), S.details(spark, d))


@query(BARS + f""",
pm as (select symbol, ({et('timestamp')})::date as date, sum(coalesce(vwap, close) * volume) >= 2000 as ok from bars where hour({et('timestamp')}) in (7, 8) group by 1, 2),
k as (select symbol, date, max(high) > 100 as is_event from bars group by 1, 2)
---
select symbol, date, coalesce(ok, true) as pm_ok, is_event and coalesce(ok, true) as is_event from k left join pm using (symbol, date)""", "", "date")
def premarket_gate(spark, d):
    b = S.bars(spark, d)
    return D.premarket_gate(b.groupBy("symbol", "date").agg((F.max("high") > 100).alias("is_event")), b, 2000)


@query(BARS + """,
u as (select *, case when count(volume) over w >= 10 then avg(volume) over w end as usual, avg((high - low) / (vwap + 1e-9)) over z as m, stddev_pop((high - low) / (vwap + 1e-9)) over z as sd from bars window w as (partition by symbol order by timestamp rows between 60 preceding and 1 preceding), z as (partition by symbol order by timestamp rows between 10 preceding and 1 preceding))
---
select symbol, timestamp, volume / (usual + 1e-9) as rvol_intraday, volume / (usual + 1e-9) >= 1.2 as pass_rvol, ((high - low) / (vwap + 1e-9) - m) / nullif(sd, 0) as spread_z, coalesce(((high - low) / (vwap + 1e-9) - m) / nullif(sd, 0) <= 2, true) as pass_spread_z from u""", "rvol_intraday spread_z", "", "timestamp")
def rvol_intraday(spark, d):
    out = H.with_liquidity(S.bars(spark, d), replace(intraday.LIQ, min_rvol=1.2, max_spread_z=2.0), intraday_rvol=True)
    return out.select("symbol", "timestamp", "rvol_intraday", "pass_rvol", "spread_z", "pass_spread_z")


@query(BARS + """,
h1 as (select *, high = low and volume = 0 as halt_flat, abs(open - lag(close) over s) / (lag(close) over s + 1e-9) > 0.2 and volume / (lag(volume) over s + 1e-9) > 10 as halt_gap,
  case when count(volume) over w >= 5 then avg(volume) over w end as usual from bars window s as (partition by symbol order by timestamp), w as (s rows between 20 preceding and 1 preceding)),
h2 as (select *, count(*) over t = 3 and sum(halt_flat::int) over t = 3 as halt_sequence, volume < 0.1 * usual and usual > 0 as halt_drought from h1 window t as (partition by symbol order by timestamp rows between 2 preceding and current row)),
oh as (select symbol, timestamp + interval 5 minutes as a, case when volume % 2 = 1 then timestamp + interval 40 minutes else timestamp + interval 65 minutes end as b from bars where volume > 250),
h3 as (select *, exists (select 1 from oh where oh.symbol = h2.symbol and h2.timestamp between a and b) as halt_official from h2),
h4 as (select *, coalesce(halt_flat or halt_gap or halt_sequence or halt_drought, false) or halt_official as is_halt from h3)
---
select symbol, timestamp, halt_official, is_halt, bool_or(is_halt) over (partition by symbol order by timestamp rows between 14 preceding and 15 following) as in_halt_window from h4""", "", "", "timestamp")
def all_halts(spark, d):
    """Inferred and official halts together: bars of high volume are followed by an official one."""
    b = S.bars(spark, d)
    spans = b.where("volume > 250").select("symbol", (F.col("timestamp") + F.expr("interval 5 minutes")).alias("halt_timestamp"), F.when(F.col("volume") % 2 == 1, F.col("timestamp") + F.expr("interval 40 minutes")).alias("resume_timestamp"))
    return H.detect_halts(b, spans).select("symbol", "timestamp", "halt_official", "is_halt", "in_halt_window")


_BARRIERS = """,
f as (select event_key, entry, take, stop, timestamp, price, case when price <= entry * (1 - stop) then -1 when price >= entry * (1 + take) then 1 end as side from bv join tr using (symbol) where timestamp > event_time and timestamp <= event_time + interval 600 minutes),
x as (select event_key, arg_min(side, timestamp) filter (side is not null) as label, arg_max(price, timestamp) as last from f group by 1)
---
select event_key, coalesce(label, 0)::int as label, case coalesce(label, 0) when 1 then take when -1 then -stop else last / entry - 1 end as exit_return from bv left join x using (event_key)"""


def tape_bars(spark, d):
    t = S.trades(spark, d)
    return t.select("symbol", "timestamp", F.col("price").alias("high"), F.col("price").alias("low"), F.col("price").alias("close"))


@query(intraday.TAPE + """,
ra as (select symbol, timestamp, case when count(tr_) over w >= 3 then avg(tr_) over w end as atr from (select symbol, timestamp, abs(price - lag(price) over (partition by symbol order by timestamp)) as t0, coalesce(greatest(0, abs(price - lag(price) over (partition by symbol order by timestamp))), 0) as tr_ from tr) window w as (partition by symbol order by timestamp rows between 2 preceding and current row)),
la as (select event_key, arg_max(atr, ra.timestamp) filter (atr is not null) as atr from ev join ra on ra.symbol = ev.symbol and ra.timestamp <= event_time group by 1),
bv as (select ev.*, coalesce(2.0 * atr / nullif(entry, 0), 0.15) as take, coalesce(1.0 * atr / nullif(entry, 0), 0.1) as stop from ev left join la using (event_key))""" + _BARRIERS, "exit_return")
def triple_barrier_atr(spark, d):
    b = tape_bars(spark, d)
    return X.triple_barrier(b, X.atr_barriers(intraday.tape_events(spark, d), b, period=3), minutes=600).select("event_key", "label", "exit_return")


@query(intraday.TAPE + ",\nbv as (select *, 0.02 + event_key % 5 * 0.03 as stop, 1.5 * (0.02 + event_key % 5 * 0.03) as take from ev)" + _BARRIERS, "exit_return")
def triple_barrier_risk(spark, d):
    e = intraday.tape_events(spark, d).withColumn("risk", 0.02 + F.col("event_key") % 5 * 0.03)
    return X.triple_barrier(tape_bars(spark, d), X.risk_barriers(e, "risk"), minutes=600).select("event_key", "label", "exit_return")


@query(DAILY + """,
q as (select o_custkey as symbol, date_trunc('quarter', o_orderdate)::date as period, date_trunc('quarter', o_orderdate)::date + 45 as filed, sum(o_totalprice) as revenue from orders group by 1, 2)
---
select d.symbol, d.date, arg_max(revenue, filed) as revenue from daily d left join q on q.symbol = d.symbol and q.filed <= d.date group by 1, 2""", "revenue", "date")
def fundamentals_as_of(spark, d):
    o = S.table(spark, d, "orders")
    q = o.groupBy(F.col("o_custkey").alias("symbol"), F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("period")).agg(F.sum("o_totalprice").alias("revenue")).withColumn("filed", F.date_add("period", 45))
    return X.fundamentals_as_of(S.daily_bars(spark, d).select("symbol", "date"), q, ("revenue",))


@query(BARS + """,
g as (select *, coalesce(epoch(timestamp) - epoch(lag(timestamp) over s) <= 1800, false)::int as ok, greatest(high - low, abs(high - lag(close) over s), abs(low - lag(close) over s)) as tr from bars window s as (partition by symbol order by timestamp))
---
select symbol, timestamp, case when sum(ok) over w = 14 then avg(tr) over w end as atr from g window w as (partition by symbol order by timestamp rows between 13 preceding and current row)""", "atr", "", "timestamp")
def gap_aware_atr(spark, d):
    return X.gap_aware_atr(S.bars(spark, d), 900).select("symbol", "timestamp", "atr")


@query("""q as (select vec_id as query_id, label, embedding from embeddings where vec_id % 100 = 0), s as (select query_id, vec_id, list_cosine_similarity(e.embedding::double[], q.embedding::double[]) as cosine from embeddings e join q using (label) where vec_id <> query_id),
t as (select * from s qualify row_number() over (partition by query_id order by cosine desc, vec_id) <= 10), o as (select doc_id as vec_id, n_chars::double as outcome from documents where doc_id % 3 <> 0)
---
select query_id, count(*) as n, count(outcome) as n_known, avg(outcome) as mean_outcome, sum(cosine * outcome) / nullif(sum(case when outcome is not null then cosine end), 0) as weighted_outcome from t left join o using (vec_id) group by 1""", "mean_outcome weighted_outcome")
def similar_outcomes(spark, d):
    out = S.table(spark, d, "documents").where("doc_id % 3 <> 0").select(F.col("doc_id").alias("vec_id"), F.col("n_chars").cast("double").alias("outcome"))
    return X.similar_outcomes(audit.similar_vectors(spark, d), out)


@query("select unnest(['ERROR', 'FAILED']) as class, unnest([(select count(*) from events where event_type = 'error'), (select count(*) from events where event_type = 'error' and event_id % 2 = 0)]) as n")
def log_error_types(spark, d):
    """Log lines of the ticks: every second error has failed; clicks are retries, purchases heartbeats with a place."""
    t = S.ticks(spark, d)
    body = F.when(F.col("symbol") == "error", F.concat(F.lit("Error in request "), F.when(F.col("event_id") % 2 == 0, "failed").otherwise("later"))).when(F.col("symbol") == "click", F.lit("ERROR, Retrying")).when(F.col("symbol") == "purchase", F.concat(F.lit("error ["), F.col("event_id"), F.lit("/99999999]"))).otherwise(F.lit("Failed: 0"))
    return Q.log_error_types(t.select(body.alias("value")))


OPTIONS = replace(intraday.CFG, bearish_red_bars=2, bearish_drop_pct=10.0, vwap_up_bars=2, vwap_down_bars=2, failed_reclaim_bars=6, min_acceleration=1.0, flush_window=6, tape_transactions=3, tape_spike=1.5, full_score=True)


@query(COLUMNS + """,
o1 as (select * replace ((max(high) over l6 - close) / nullif(max(high) over l6, 0) * 100 as drop_pct), sum((close < open)::int) over l2 = 2 and count(*) over l2 = 2 as bearish, sum((close > vwap_ref)::int) over l2 = 2 and count(*) over l2 = 2 as above, sum((close < vwap_ref)::int) over l2 = 2 and count(*) over l2 = 2 as under,
  coalesce(max((close < vwap_ref and high >= vwap_ref)::int) over l6 = 1, false) as reclaim, abs(ret_pct) / nullif(abs(lag(ret_pct, 5) over d), 0) as acc, transactions / nullif(quantile_cont(transactions, 0.5) over w20, 0) as tape_x,
  case when close > open then sum((close > open)::int) over l3 else count(*) over l3 - sum((close > open)::int) over l3 end as same_bars from i3
  window d as (partition by symbol, date order by timestamp), l2 as (d rows between 1 preceding and current row), l3 as (d rows between 2 preceding and current row), l6 as (d rows between 5 preceding and current row), w20 as (d rows between 19 preceding and current row)),
o2 as (select *, unnest([
  struct_pack(event_type := 'tape_speed', direction := case when close > open then 'up' else 'down' end, hit := transactions >= 3 and tape_x >= 1.5),
  struct_pack(event_type := 'volume_spike', direction := case when close > open then 'up' else 'down' end, hit := spike_x >= case when session = 'RTH' then 1.5 else 2.0 end and volume >= 20 and dollar_volume >= 500 and range_pct >= 1.0 and (close > open or (bearish and drop_pct >= 10))),
  struct_pack(event_type := 'vwap_break', direction := 'up', hit := vwap_dist_pct >= 20 and volume_x >= 1.2 and above),
  struct_pack(event_type := 'vwap_break', direction := 'down', hit := vwap_dist_pct <= -20 and volume_x >= 1.2 and under and reclaim),
  struct_pack(event_type := 'price_momentum', direction := 'down', hit := ret_pct <= -20 and volume_x >= 1.0 and close < low20 and acc >= 1.0),
  struct_pack(event_type := 'flush', direction := 'down', hit := drop_pct >= 30 and volume_x >= 1.2 and red_bars >= 2)]) as h from o1)
---
select symbol, timestamp, h.event_type as event_type, h.direction as direction, 0.3 * coalesce(spike_x, 1.0) + 0.25 * coalesce(range_pct, 0.0) + 0.2 + 0.15 * same_bars + 0.1 * coalesce(abs(vwap_dist_pct), 0) as score from o2 where h.hit""", "score", "", "timestamp")
def detector_options(spark, d):
    """The detectors with the options that are off by default; those that no option touches are left out."""
    out = D.detected(S.bars(spark, d), OPTIONS, ("tape_speed", "volume_spike", "vwap_break", "price_momentum", "flush"))
    return out.where("not (event_type = 'price_momentum' and direction = 'up')").select("symbol", "timestamp", "event_type", "direction", "score")


@query(BARS + "\n---\nselect symbol, timestamp, date, close, volume from bars", "close", "date", "timestamp")
def scanned_bars(spark, d):
    """Bars written by date and scanned back."""
    path = f"{shared_folder(spark)}/bars"
    B.write_bars(S.bars(spark, d), path)
    return B.scan_bars(spark, path).select("symbol", "timestamp", "date", "close", "volume")


@query(BARS + "\n---\nselect symbol, timestamp, close, case when transactions > 1 then volume end as volume from bars", "close", "", "timestamp")
def scanned_shards(spark, d):
    """Two shards below one folder, one of them without a column."""
    path, bars = shared_folder(spark), S.bars(spark, d).select("symbol", "timestamp", "close", "volume", "transactions")
    bars.where("transactions > 1").drop("transactions").write.parquet(f"{path}/worker=1/a")
    bars.where("transactions <= 1").drop("volume", "transactions").write.parquet(f"{path}/worker=2/b")
    return B.scan_shards(spark, path).select("symbol", "timestamp", "close", "volume")


@query(BARS + ",\nf as (select symbol, date, volume / nullif(quantile_cont(volume, 0.5) over (partition by symbol order by timestamp rows between 19 preceding and current row), 0) as spike_x from bars)\n---\nselect symbol, date, count_if(spike_x >= 2)::bigint as n_spikes, max(spike_x) as max_spike from f group by 1, 2", "max_spike", "date")
def clustered_spikes(spark, d):
    """Windows by symbol over a table of bars in buckets by symbol: no exchange between scan and window."""
    name = f"bars_{uuid.uuid4().hex}"
    return D.first_half(B.write_clustered(S.bars(spark, d), name, f"{shared_folder(spark)}/{name}", buckets=8))


@query(COLUMNS + "\n---\nselect symbol, timestamp, event_type, direction, session, score from events_", "score", "", "timestamp")
def ledger_events(spark, d):
    """Events committed as a shard per session, one of them twice, beside a write that died; then merged into one shard."""
    events = saved(D.intraday_events(S.bars(spark, d), intraday.CFG).select("symbol", "timestamp", "event_type", "direction", "session", "score"), "events")
    ledger = Ledger(spark, f"{shared_folder(spark)}/events")
    for session in ("PM", "RTH", "AH", "RTH", "CLOSED"):
        ledger.append(events.where(F.col("session") == session), f"run-{session}")
    ledger.write(events)
    ledger.compact()
    return ledger.read()


@query(
    "select o_orderkey, case when o_orderkey % 3 <> 0 then o_orderdate end as timestamp, o_orderstatus as event_type, null::int as window_before_min, null::int as window_after_min from orders", "", "", "timestamp",
)
def lenient_manifest(spark, d):
    """Times as text, some unreadable, under a vendor's name for the type: read leniently, with the columns that the contract asks for."""
    o = S.table(spark, d, "orders")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.lit("no time")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    raw = o.select("o_orderkey", text.alias("timestamp"), F.col("o_orderstatus").alias("type"))
    return B.checked_manifest(raw.withColumn("timestamp", M.parsed_timestamp(raw, "timestamp")), ("o_orderkey", "timestamp", "event_type"))


@query("select n_nationkey, n_name, n_regionkey from nation")
def csv_sidecar(spark, d):
    """A table written as CSV and as JSON, and read back."""
    path, rows = shared_folder(spark), S.table(spark, d, "nation")
    B.write_csv(rows.select("n_nationkey", "n_name"), f"{path}/csv")
    B.write_stats(rows.select("n_nationkey", "n_regionkey"), f"{path}/json")
    named = spark.read.schema("n_nationkey int, n_name string").option("header", True).csv(f"{path}/csv")
    return named.join(spark.read.schema("n_nationkey int, n_regionkey int").json(f"{path}/json"), "n_nationkey")
