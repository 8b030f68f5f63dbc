"""Queries on streams: the events table is read as a stream, and what the stream has written is the result."""

from pyspark.sql import functions as F

from tideline.operators import detectors as D
from tideline.sources import adapters as S
from tideline.streaming import ordered, stream

from . import intraday
from .catalog import TICKS, query

#: Windows that the watermark has closed: they end at least {0} minutes before the last event.
CLOSED = "epoch_ms({1}) <= (select max(epoch_ms(timestamp)) from ticks) - {0} * 60000"
GROUPED = TICKS + ",\ng as (select symbol as event_type, symbol || '-' || (user_id // 150) as stock, 'u' || (user_id // 150) as users, timestamp, event_id, price, size from ticks)"


def ticks(spark, d):
    """The ticks as a stream, under the symbols of the bars (symbol) and those of their users alone (users)."""
    table = S.table(spark, d, "events")
    raw = spark.readStream.schema(table.schema).parquet(f"{d}/events.parque[t]")  # a pattern: a stream takes one file by that only
    group = F.floor(F.col("user_id") / 150)
    return S.ticks_of(raw).select(F.concat_ws("-", "symbol", group).alias("symbol"), F.concat(F.lit("u"), group).alias("users"), F.col("symbol").alias("event_type"), "timestamp", "event_id", "price", "size")


@query(
    GROUPED + f""",
w as (select *, time_bucket(interval 15 minutes, timestamp) as start from g)
---
select stock as symbol, start as timestamp, start::date as date, arg_min(price, timestamp) as open, max(price) as high, min(price) as low, arg_max(price, timestamp) as close, sum(size)::bigint as volume, count(*) as transactions
from w where {CLOSED.format(5, "start + interval 15 minutes")} group by stock, start""", "open high low close", "date", "timestamp",
)
def stream_bars(spark, d):
    return stream.finished(stream.minute_bars(ticks(spark, d), "15 minutes"))


@query(
    GROUPED + f""",
w as (select users, event_type, unnest([time_bucket(interval 30 minutes, timestamp), time_bucket(interval 30 minutes, timestamp) - interval 30 minutes]) as start from g)
---
select users as symbol, start as window_start, start + interval 1 hour as window_end from w where {CLOSED.format(10, "start + interval 1 hour")}
group by users, start having count(distinct event_type) filter (event_type in ('view', 'purchase')) = 2""", "", "", "window_start window_end",
)
def stream_screener(spark, d):
    """Users who view and buy within an hour."""
    events = ticks(spark, d).withColumn("symbol", F.col("users"))
    return stream.finished(stream.screener(events, ("view", "purchase"), "1 hour", "30 minutes"))


@query(GROUPED + "\n---\nselect distinct users as symbol, date_trunc('hour', timestamp) as timestamp, event_type from g", "", "", "timestamp")
def stream_deduplicated(spark, d):
    events = ticks(spark, d).select(F.col("users").alias("symbol"), F.date_trunc("hour", "timestamp").alias("timestamp"), "event_type")
    return stream.finished(stream.deduplicated(events))


@query(GROUPED + ",\nm as (select event_type, avg(size) as mean_size from g group by 1)\n---\nselect event_id, event_type, size, mean_size from g left join m using (event_type)", "mean_size")
def stream_enriched(spark, d):
    """Each tick of the stream beside the usual size of its kind in the table."""
    usual = S.ticks(spark, d).groupBy(F.col("symbol").alias("event_type")).agg(F.avg("size").alias("mean_size"))
    return stream.finished(stream.enriched_stream(ticks(spark, d), usual, ["event_type"]).select("event_id", "event_type", "size", "mean_size"))


@query(intraday.COLUMNS + "\n---\nselect symbol, timestamp, event_type, direction, session, spike_x, score from events_", "spike_x score", "", "timestamp")
def stream_detectors(spark, d):
    """The detectors on bars as they arrive: the same events as from all bars at once."""
    folder = stream.shared_folder(spark)
    bars = S.bars(spark, d)
    bars.write.parquet(f"{folder}/in")
    step = stream.live_detectors(spark, f"{folder}/bars", f"{folder}/events", intraday.CFG)
    arriving = spark.readStream.schema(bars.schema).parquet(f"{folder}/in")
    arriving.writeStream.foreachBatch(step).option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(D.intraday_events(bars, intraday.CFG).schema).parquet(f"{folder}/events").select(*intraday.OUT)


@query(intraday.COLUMNS + "\n---\nselect symbol, timestamp, event_type, direction, session, spike_x, score from events_", "spike_x score", "", "timestamp")
def stream_live_detectors(spark, d):
    """The detectors with rolling state, on bars that arrive up to an hour late over several runs of the query."""
    return stream.replayed(S.bars(spark, d), lambda bars: ordered.live_events(bars, intraday.CFG, "1 hour"), 3600).select(*intraday.OUT)


@query(intraday.COLUMNS + "\n---\nselect symbol, timestamp, event_type, direction, session, spike_x, score from hits", "spike_x score", "", "timestamp")
def stream_live_hits(spark, d):
    """Every hit as soon as the watermark has reached its bar."""
    return stream.replayed(S.bars(spark, d), lambda bars: ordered.live_events(bars, intraday.CFG, "1 hour", best=False), 3600, slices=2).select(*intraday.OUT)


COOLDOWN = (
    "recursive " + GROUPED + """,
e as (select users, event_type, timestamp, timestamp::date as date, floor(epoch(timestamp))::bigint as s from g),
cd as (select users, date, event_type, min(s) as t from e group by all
  union all select users, date, event_type, min(x) from (select cd.users, cd.date, cd.event_type, cd.t, e.s as x from cd join e on e.users = cd.users and e.date = cd.date and e.event_type = cd.event_type and e.s - cd.t >= 7200) group by users, date, event_type, t)
---
select users as symbol, event_type, timestamp from e where exists (from cd where cd.users = e.users and cd.date = e.date and cd.event_type = e.event_type and cd.t = e.s)"""
)


@query(COOLDOWN, "", "", "timestamp")
def stream_cooldown(spark, d):
    return stream.finished(stream.cooldown(ticks(spark, d).withColumn("symbol", F.col("users")), 120))


@query(COOLDOWN, "", "", "timestamp")
def stream_ordered_cooldown(spark, d):
    """The cooldown in event time, on events that arrive up to an hour late over several runs of the query."""
    group = F.concat(F.lit("u"), F.floor(F.col("user_id") / 150))
    rows = S.ticks(spark, d).select(group.alias("symbol"), F.col("symbol").alias("event_type"), "timestamp")
    return stream.replayed(rows, lambda events: ordered.cooldown(events, 120, "1 hour"), 3600)
