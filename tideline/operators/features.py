"""Features, labels and screens that the domain specifies by formula."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.quantiles import exact_quantiles
from tideline.functions.scalars import ratio
from tideline.functions.time import market_time, minute_of_day
from tideline.storage import saved

from .joins import as_of, in_event_windows
from .rolling import by_day, by_symbol, by_daily, last_rows, mean_at_least, rows_before


def dollar_volume_z(bars: DataFrame, days: int = 60, k: int = 20) -> DataFrame:
    """bars with dv_z: dollar volume against the same minute of the `days` days before, winsorised at p1 and p99: (dv - median) / (1.4826 MAD); null below k days."""
    out = bars.withColumn("dv", F.col("close") * F.col("volume")).withColumn("__m", F.hour("timestamp") * 60 + F.minute("timestamp"))
    w = Window.partitionBy("symbol", "__m").orderBy("timestamp").rowsBetween(-days, -1)
    past = F.sort_array(F.collect_list("dv").over(w))
    out = out.withColumn("__p", past).withColumn("__n", F.size("__p"))

    def quantile(xs: Column, q: float) -> Column:  # linear interpolation between neighbours
        at = F.lit(q) * (F.size(xs) - 1)
        lo = F.get(xs, F.floor(at).cast("int"))
        return lo + (at - F.floor(at)) * (F.get(xs, F.ceil(at).cast("int")) - lo)

    out = out.withColumn("__lo", quantile(F.col("__p"), 0.01)).withColumn("__hi", quantile(F.col("__p"), 0.99))
    out = out.withColumn("__p", F.transform("__p", lambda x: F.greatest(F.least(x, F.col("__hi")), F.col("__lo")))).withColumn("__med", quantile(F.col("__p"), 0.5))
    out = out.withColumn("__mad", quantile(F.sort_array(F.transform("__p", lambda x: F.abs(x - F.col("__med")))), 0.5))
    z = ratio(F.col("dv") - F.col("__med"), 1.4826 * F.col("__mad"))
    return out.withColumn("dv_z", F.when(F.col("__n") >= k, z)).drop("__m", "__p", "__n", "__lo", "__hi", "__med", "__mad")


def spread_features(bars: DataFrame, position_usd: float = 10_000, flow: float = 10.0) -> DataFrame:
    """bars with spread_vol_adj (spread over ATR of 5 rows, as shares of the price), spread_anomaly, imbalance, size_ratio, friction."""
    before = F.lag("close").over(by_symbol())
    tr = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))
    out = bars.withColumn("__tr", tr).withColumn("atr5", F.avg("__tr").over(last_rows(by_symbol(), 5))).drop("__tr")
    out = out.withColumn("spread_vol_adj", ratio(ratio(F.col("high") - F.col("low"), F.col("vwap")), F.col("atr5"))).withColumn("spread_anomaly", F.col("spread_vol_adj") > 1.5)
    out = out.withColumn("imbalance", ratio(F.col("close") - F.col("open"), F.col("high") - F.col("low"))).withColumn("size_ratio", ratio(F.lit(position_usd), flow * F.col("close") * F.col("volume")))
    return out.withColumn("friction", F.when(F.col("size_ratio") < 0.01, "low").when(F.col("size_ratio") < 0.05, "medium").when(F.col("size_ratio") < 0.10, "high").otherwise("extreme"))


def trade_difficulty(bars: DataFrame) -> DataFrame:
    """bars with difficulty (spread over volume ratio), its quartile per symbol, and tradable (below the symbol's p75)."""
    x = ratio(ratio(F.col("high") - F.col("low"), F.col("vwap")), ratio(F.col("volume"), F.avg("volume").over(last_rows(by_symbol(), 20))))
    w = Window.partitionBy("symbol")
    out = bars.withColumn("difficulty", x).where("difficulty is not null")
    return out.withColumn("quartile", F.ntile(4).over(w.orderBy("difficulty", "timestamp"))).withColumn("tradable", F.col("difficulty") < F.percentile("difficulty", F.lit(0.75)).over(w))


def execution_cost(events: DataFrame, position_usd: float = 10_000, halt: str | None = None, ssr: str | None = None) -> DataFrame:
    """events with base, spread, size and context slippage, their sum, fill_ratio, fill_price and quality."""
    price, dv = F.col("close"), F.col("close") * F.col("volume")
    base = F.when(price < 2, 0.0075).when(price <= 10, 0.0050).otherwise(0.0035)
    spread = F.greatest(F.lit(0.0), ratio(F.col("high") - F.col("low"), F.col("vwap")) - 0.01) * 0.6
    size = F.greatest(F.lit(0.0), ratio(F.lit(position_usd), dv) - 0.01) * 0.10
    m = minute_of_day(market_time(F.col("timestamp")))
    near = F.col(halt) if halt else F.lit(False)
    context = F.when(m.between(570, 574), 0.004).otherwise(0.0) + F.when(near, 0.010).otherwise(0.0)
    out = events.withColumn("slip_base", base).withColumn("slip_spread", spread).withColumn("slip_size", size).withColumn("slip_context", context)
    total = F.col("slip_base") + F.col("slip_spread") + F.col("slip_size") + F.col("slip_context")
    if ssr:
        total = total * F.when(F.col(ssr), 2.0).otherwise(1.0)
    fill = F.least(F.when(near, 0.25).otherwise(1.0), F.coalesce(ratio(dv, F.lit(10 * position_usd)), F.lit(0.0)))
    out = out.withColumn("slippage", total).withColumn("fill_ratio", fill).withColumn("fill_price", price * (1 + F.col("slippage")))
    return out.withColumn("quality", F.when((F.col("slippage") < 0.01) & (F.col("fill_ratio") >= 0.9), "good").when((F.col("slippage") < 0.03) & (F.col("fill_ratio") >= 0.5), "fair").otherwise("poor"))


def l2_selection(events: DataFrame, q: float = 0.90, min_day: float = 5_000_000, per_month: int = 200) -> DataFrame:
    """Events over the q quantiles of liquidity_score and rvol_day with dollar_volume_day over min_day; the best of each month."""
    events = saved(events, "candidates")
    least = exact_quantiles(events, {"liquidity_score": (q,), "rvol_day": (q,)})
    above = [F.col(c) > F.lit(x).cast("double") for (c, _), x in least.items()]
    out = events.where(above[0] & above[1] & (F.col("dollar_volume_day") > min_day))
    w = Window.partitionBy(F.date_format("timestamp", "yyyy-MM")).orderBy(F.desc("liquidity_score"), "symbol", "timestamp", "event_type")
    return out.withColumn("rank_month", F.row_number().over(w)).where(F.col("rank_month") <= per_month)


def aggressor_delta(trades: DataFrame, quotes: DataFrame) -> DataFrame:
    """Per symbol: size at or over the ask less size at or under the bid, as of each trade, and its ratio to all."""
    t = as_of(trades, quotes, ["bid_price", "ask_price"])
    buy, sell = F.sum(F.when(F.col("price") >= F.col("ask_price"), F.col("size")).otherwise(0)), F.sum(F.when(F.col("price") <= F.col("bid_price"), F.col("size")).otherwise(0))
    out = t.groupBy("symbol").agg(F.count("*").alias("n_trades"), F.count("bid_price").alias("n_quoted"), buy.alias("buy_size"), sell.alias("sell_size"), F.sum("size").alias("total_size"))
    return out.withColumn("delta", F.col("buy_size") - F.col("sell_size")).withColumn("delta_ratio", F.try_divide(F.col("delta").cast("double"), F.col("total_size")))


def l2_metrics(trades: DataFrame, quotes: DataFrame) -> DataFrame:
    """Per symbol: mean NBBO spread, share of crossed quotes, upticks to downticks, and burstiness (variance of trades a minute over their mean).

    Spreads are added up in the order of events, so that the mean's last bits, and how it rounds, don't depend on how rows are dealt over tasks.
    """
    so_far = F.avg(F.col("ask_price") - F.col("bid_price")).over(Window.partitionBy("symbol").orderBy("event_id", "timestamp").rowsBetween(Window.unboundedPreceding, 0))
    q = quotes.withColumn("__m", so_far).groupBy("symbol").agg(F.max_by("__m", F.struct("event_id", "timestamp")).alias("mean_spread"), F.avg((F.col("bid_price") >= F.col("ask_price")).cast("double")).alias("cross_rate"))
    step = F.col("price") - F.lag("price").over(Window.partitionBy("symbol").orderBy("timestamp", "event_id"))
    t = trades.withColumn("__s", step).groupBy("symbol").agg(F.count_if(F.col("__s") > 0).alias("upticks"), F.count_if(F.col("__s") < 0).alias("downticks"))
    n = trades.groupBy("symbol", F.date_trunc("hour", "timestamp").alias("h")).agg(F.count("*").alias("c")).groupBy("symbol").agg(F.try_divide(F.var_pop("c"), F.avg("c")).alias("burstiness"))
    return t.join(q, "symbol", "left").join(n, "symbol", "left").withColumn("tick_ratio", F.try_divide(F.col("upticks").cast("double"), F.col("downticks")))


def trade_features(trades: DataFrame) -> DataFrame:
    """Trades with large_print (size over mean + 3 sigma of its symbol), volume_burst (over 3 times the mean of 20), size_p50 and size_p95."""
    w = Window.partitionBy("symbol")
    out = trades.withColumn("large_print", F.coalesce(F.col("size") > F.avg("size").over(w) + 3 * F.stddev("size").over(w), F.lit(False)))
    order = w.orderBy("timestamp", "event_id")
    out = out.withColumn("volume_burst", F.col("size") > 3 * F.avg("size").over(order.rowsBetween(-19, 0)))
    return out.withColumn("size_p50", F.percentile("size", F.lit(0.5)).over(w)).withColumn("size_p95", F.percentile("size", F.lit(0.95)).over(w))


def quote_features(quotes: DataFrame) -> DataFrame:
    """Quotes with spread, spread_pct, mid, expansion (spread over the one before), imbalance, depth, mid_stability (deviation of 20 mids over their mean)."""
    w = Window.partitionBy("symbol").orderBy("timestamp", "event_id")
    out = quotes.withColumn("spread", F.col("ask_price") - F.col("bid_price")).withColumn("mid", (F.col("ask_price") + F.col("bid_price")) / 2).withColumn("spread_pct", ratio(F.col("spread"), F.col("mid")))
    out = out.withColumn("expansion", ratio(F.col("spread"), F.lag("spread").over(w))).withColumn("depth", F.col("bid_size") + F.col("ask_size"))
    out = out.withColumn("imbalance", F.try_divide((F.col("bid_size") - F.col("ask_size")).cast("double"), F.col("depth")))
    last = w.rowsBetween(-19, 0)
    return out.withColumn("mid_stability", ratio(F.stddev_pop("mid").over(last), F.avg("mid").over(last)))


def price_features(bars: DataFrame) -> DataFrame:
    """bars with vwap_dev, range_expansion, day_return, hod_break, lod_break, velocity, slope (15 rows)."""
    out = bars.withColumn("vwap_dev", ratio(F.col("close") - F.col("vwap"), F.col("vwap"))).withColumn("__r", F.col("high") - F.col("low"))
    out = out.withColumn("range_expansion", ratio(F.col("__r"), F.avg("__r").over(rows_before(by_day(), 20)))).withColumn("day_return", ratio(F.col("close"), F.first("open").over(by_day().rowsBetween(Window.unboundedPreceding, 0))) - 1)
    past = by_day().rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("hod_break", F.coalesce(F.col("close") > F.max("high").over(past), F.lit(False))).withColumn("lod_break", F.coalesce(F.col("close") < F.min("low").over(past), F.lit(False)))
    out = out.withColumn("velocity", ratio(F.col("close"), F.lag("close", 3).over(by_day())) - 1).withColumn("__i", F.row_number().over(by_day()).cast("double"))
    return out.withColumn("slope", F.regr_slope("close", "__i").over(last_rows(by_day(), 15))).drop("__r", "__i")


def volume_gini(bars: DataFrame) -> DataFrame:
    """Gini coefficient of the bars' volumes per symbol-day."""
    w = Window.partitionBy("symbol", "date").orderBy("volume", "timestamp")
    r = bars.withColumn("__i", F.row_number().over(w)).groupBy("symbol", "date").agg(F.sum(F.col("__i") * F.col("volume")).alias("a"), F.sum("volume").alias("b"), F.count("*").alias("n"))
    return r.select("symbol", "date", (F.try_divide(2.0 * F.col("a"), F.col("n") * F.col("b")) - (F.col("n") + 1) / F.col("n")).alias("gini"))


def corporate_features(daily: DataFrame, actions: DataFrame, near: int = 5) -> DataFrame:
    """Symbol-days with days_since_reverse_split, splits_12m and action_nearby; actions (symbol, date, split_from, split_to)."""
    days = daily.select("symbol", "date", F.lit(True).alias("__day"), F.lit(0).cast("long").alias("__n"), F.lit(None).cast("date").alias("__rev"))
    acts = actions.where("symbol is not null and date is not null").select(F.col("symbol").cast(daily.schema["symbol"].dataType), F.col("date").cast("date"), F.lit(False).alias("__day"), F.lit(1).cast("long").alias("__n"), F.when(F.col("split_from") > F.col("split_to"), F.col("date").cast("date")).alias("__rev"))
    rows = days.unionByName(acts).groupBy("symbol", "date").agg(F.max("__day").alias("__day"), F.sum("__n").alias("__n"), F.max("__rev").alias("__rev"))
    w = Window.partitionBy("symbol").orderBy(F.unix_date("date"))
    out = rows.withColumn("__last", F.max("__rev").over(w.rangeBetween(Window.unboundedPreceding, 0))).withColumn("splits_12m", F.sum("__n").over(w.rangeBetween(-365, 0))).withColumn("__near", F.sum("__n").over(w.rangeBetween(-near, near)))
    return out.where("__day").select("symbol", "date", F.datediff("date", "__last").alias("days_since_reverse_split"), "splits_12m", (F.col("__near") > 0).alias("action_nearby"))


def news_features(days: DataFrame, news: DataFrame, keywords: dict[str, str]) -> DataFrame:
    """Symbol-days with news counts of 1, 7 and 30 days, near_news (a day either side) and a flag per keyword pattern over 7 days."""
    per = news.groupBy("symbol", F.to_date("published").alias("__d")).agg(F.count("*").alias("__n"), *[F.max(F.lower("title").rlike(p)).alias(f"__{k}") for k, p in keywords.items()])
    back = F.datediff("date", "__d")
    joined = days.select("symbol", "date").withColumn("__d", F.explode(F.sequence(F.date_sub("date", 29), F.date_add("date", 1)))).join(per, ["symbol", "__d"], "left")
    count = lambda n: F.coalesce(F.sum(F.when(back.between(0, n - 1), F.col("__n"))), F.lit(0))
    return joined.groupBy("symbol", "date").agg(
        *[count(n).alias(f"news_{n}d") for n in (1, 7, 30)], F.coalesce(F.max(back.between(-1, 1) & F.col("__n").isNotNull()), F.lit(False)).alias("near_news"),
        *[F.coalesce(F.max(F.when(back.between(0, 6), F.col(f"__{k}"))), F.lit(False)).alias(f"has_{k}") for k in keywords],
    )


def fundamentals(quarters: DataFrame) -> DataFrame:
    """Quarters (symbol, period, filed, revenue, cash, debt, equity) with qoq, yoy, burn, debt_to_equity and lag_days."""
    w = Window.partitionBy("symbol").orderBy("period")
    out = quarters.withColumn("qoq", ratio(F.col("revenue"), F.lag("revenue").over(w)) - 1).withColumn("yoy", ratio(F.col("revenue"), F.lag("revenue", 4).over(w)) - 1)
    return out.withColumn("burn", F.lag("cash").over(w) - F.col("cash")).withColumn("debt_to_equity", ratio(F.col("debt"), F.col("equity"))).withColumn("lag_days", F.datediff("filed", "period"))


def atr_barriers(events: DataFrame, bars: DataFrame, period: int = 14, take: float = 2.0, stop: float = 1.0) -> DataFrame:
    """events with take_pct and stop_pct, shares of the entry: multiples of the mean true range of the `period` bars up to the event."""
    before = F.lag("close").over(by_symbol())
    tr = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))
    ranges = bars.withColumn("__tr", tr).withColumn("atr", mean_at_least("__tr", last_rows(by_symbol(), period), period)).withColumn("__id", F.lit(0).cast("long"))
    out = as_of(events.withColumn("timestamp", F.col("event_time")).withColumn("__id", F.lit(0).cast("long")), ranges, ["atr"], order="__id").drop("timestamp", "__id")
    return out.withColumn("take_pct", ratio(take * F.col("atr"), F.col("entry"))).withColumn("stop_pct", ratio(stop * F.col("atr"), F.col("entry"))).drop("atr")


def risk_barriers(events: DataFrame, risk: str, r: float = 1.5) -> DataFrame:
    """events with stop_pct, the share of the entry in column `risk`, and take_pct, r times as much."""
    return events.withColumn("stop_pct", F.col(risk).cast("double")).withColumn("take_pct", r * F.col("stop_pct"))


def triple_barrier(bars: DataFrame, events: DataFrame, take: float = 0.15, stop: float = 0.10, minutes: int = 15, cost: float = 0.0) -> DataFrame:
    """events (event_key, symbol, event_time, entry) with label 1, -1 or 0, exit_time and exit_return: the first bar to touch a barrier; the stop wins within one bar.

    events may have take_pct and stop_pct of their own (see atr_barriers and risk_barriers), which go first where not null.
    """
    take, stop = (F.coalesce(F.col(c), F.lit(float(d))) if c in events.columns else F.lit(float(d)) for c, d in (("take_pct", take), ("stop_pct", stop)))
    future = in_event_windows(bars, events.select("event_key", "symbol", "event_time"), 0, minutes).where("timestamp > event_time")
    j = future.join(events.select("event_key", "entry", take.alias("__take"), stop.alias("__stop")), "event_key")
    side = F.when(F.col("low") <= F.col("entry") * (1 - F.col("__stop")), -1).when(F.col("high") >= F.col("entry") * (1 + F.col("__take")), 1)
    hit = j.withColumn("__side", side).groupBy("event_key").agg(F.min_by(F.struct("timestamp", "__side"), F.when(F.col("__side").isNotNull(), F.col("timestamp"))).alias("h"), F.max_by(F.struct("timestamp", "close"), "timestamp").alias("l"), F.max(F.col("__side").isNotNull()).alias("any"))
    out = events.join(hit, "event_key", "left").withColumn("label", F.when(F.col("any"), F.col("h.__side")).otherwise(0)).withColumn("exit_time", F.when(F.col("any"), F.col("h.timestamp")).otherwise(F.col("l.timestamp")))
    gain = F.when(F.col("label") == 1, take).when(F.col("label") == -1, -stop).otherwise(ratio(F.col("l.close"), F.col("entry")) - 1)
    return out.withColumn("exit_return", gain - cost).drop("h", "l", "any")


def intraday_sigma(bars: DataFrame, n: int = 20) -> DataFrame:
    """bars with sigma: the deviation of the returns of the last n bars of the day."""
    out = bars.withColumn("__r", ratio(F.col("close"), F.lag("close").over(by_day())) - 1)
    return out.withColumn("sigma", F.stddev_samp("__r").over(last_rows(by_day(), n))).drop("__r")


def net_of_costs(
    labelled: DataFrame, fee_per_share: float = 0.003, fee_per_dollar: float = 0.0000278, normal: float = 0.5, restricted: float = 2.0, tick: float = 0.01, least_ticks: int = 1, volatility: float = 0.2,
) -> DataFrame:
    """labelled (entry, exit_return; spread in dollars, sigma, ssr) with fees, slip, net_return and net_label, its sign.

    Fees, as shares of the entry: per share both ways, and per dollar of the sale. Slippage both ways: a share of the spread, larger under
    a short-sale restriction, of so many ticks at least, and a share of the intraday deviation. A null spread is one tick, a null
    sigma or ssr none; an entry of 0 gives nulls.
    """
    entry, sale = F.col("entry"), F.col("entry") * (1 + F.col("exit_return"))
    factor = F.when(F.coalesce("ssr", F.lit(False)), restricted).otherwise(normal)
    one_way = F.greatest(factor * F.coalesce("spread", F.lit(0.0)), F.lit(tick * least_ticks)) + volatility * F.coalesce("sigma", F.lit(0.0)) * entry
    out = labelled.withColumn("fees", ratio(2 * fee_per_share + fee_per_dollar * sale, entry)).withColumn("slip", ratio(2 * one_way, entry))
    out = out.withColumn("net_return", F.col("exit_return") - F.col("fees") - F.col("slip"))
    return out.withColumn("net_label", F.when(F.col("net_return").isNull(), 0).otherwise(F.signum("net_return")).cast("int"))


def forward_label(bars: DataFrame, n: int = 5, up: float = 0.02, down: float = -0.02) -> DataFrame:
    r = ratio(F.lead("close", n).over(by_day()), F.col("close")) - 1
    return bars.withColumn("fwd_return", r).withColumn("fwd_label", F.when(F.col("fwd_return") >= up, 1).when(F.col("fwd_return") <= down, -1).when(F.col("fwd_return").isNotNull(), 0))


def walk_forward(days: DataFrame, train: int = 6, valid: int = 1, test: int = 1) -> DataFrame:
    """(fold, part) of each date for rolling folds of train, valid and test months, one month apart."""
    m = F.months_between(F.trunc("date", "month"), F.trunc(F.min("date").over(Window.partitionBy()), "month")).cast("int")
    width = train + valid + test
    out = days.select("date").distinct().withColumn("__m", m).withColumn("__last", F.max("__m").over(Window.partitionBy()))
    out = out.withColumn("fold", F.explode(F.sequence(F.greatest(F.lit(0), F.col("__m") - width + 1), F.col("__m")))).where(F.col("fold") + width - 1 <= F.col("__last"))
    at = F.col("__m") - F.col("fold")
    return out.withColumn("part", F.when(at < train, "train").when(at < train + valid, "valid").otherwise("test")).drop("__m", "__last")


def purged_folds(days: DataFrame, k: int = 5, purge: int = 1, embargo: int = 3) -> DataFrame:
    """(fold, part) of each date: equal runs of dates as test folds; train dates within `purge` days before or `embargo` after are left out."""
    d = days.select("date").distinct().withColumn("own", F.ntile(k).over(Window.orderBy("date")) - 1)  # one row per date
    span = d.groupBy(F.col("own").alias("fold")).agg(F.min("date").alias("a"), F.max("date").alias("b"))
    out = d.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).join(span, "fold")
    near = F.col("date").between(F.date_sub("a", purge), F.date_add("b", embargo))
    return out.withColumn("part", F.when(F.col("own") == F.col("fold"), "test").when(near, "left_out").otherwise("train")).where("part <> 'left_out'").select("date", "fold", "part")


def fundamentals_as_of(days: DataFrame, quarters: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """days (symbol, date) with the columns of the last quarter filed on or before the day (quarters: symbol, filed, period, ...)."""
    at = lambda c: F.col(c).cast("timestamp")
    filed = quarters.where("filed is not null").withColumn("timestamp", at("filed")).withColumn("__order", F.unix_date("period").cast("long"))
    return as_of(days.withColumn("timestamp", at("date")).withColumn("__order", F.lit(0).cast("long")), filed, list(columns), order="__order").drop("timestamp", "__order")


def gap_aware_atr(bars: DataFrame, seconds: int, n: int = 14) -> DataFrame:
    """bars with atr: mean true range of n rows, null unless all n steps are at most two bar widths."""
    before = F.lag("close").over(by_symbol())
    step = F.unix_timestamp("timestamp") - F.unix_timestamp(F.lag("timestamp").over(by_symbol()))
    out = bars.withColumn("__ok", F.coalesce(step <= 2 * seconds, F.lit(False)).cast("int"))
    out = out.withColumn("__tr", F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before)))
    w = last_rows(by_symbol(), n)
    return out.withColumn("atr", F.when(F.sum("__ok").over(w) == n, F.avg("__tr").over(w))).drop("__ok", "__tr")


def tick_continuity(trades: DataFrame, events: DataFrame, before: int = 3, after: int = 7) -> DataFrame:
    """Per event the share of the minutes around it that hold a trade."""
    minute = F.floor((F.unix_timestamp("timestamp") - F.unix_timestamp("event_time")) / 60)
    hit = in_event_windows(trades, events, before, after).groupBy("event_key").agg(F.count_distinct(minute).alias("minutes"))
    return events.join(hit, "event_key", "left").select("event_key", (F.coalesce("minutes", F.lit(0)) / (before + after + 1)).alias("continuity"))


def gap_aware(bars: DataFrame, seconds: int, n: int = 14) -> DataFrame:
    """bars with valid_step (at most two bar widths since the last) and rsi: Wilder's sums over n rows, null unless all n steps are valid."""
    step = F.unix_timestamp("timestamp") - F.unix_timestamp(F.lag("timestamp").over(by_symbol()))
    change = F.col("close") - F.lag("close").over(by_symbol())
    out = bars.withColumn("valid_step", F.coalesce(step <= 2 * seconds, F.lit(False))).withColumn("__c", change)
    w = last_rows(by_symbol(), n)
    up, down = F.sum(F.greatest("__c", F.lit(0.0))).over(w), F.sum(F.greatest(-F.col("__c"), F.lit(0.0))).over(w)
    ok = F.sum(F.col("valid_step").cast("int")).over(w) == n
    return out.withColumn("rsi", F.when(ok, ratio(100 * up, up + down))).drop("__c")


def filled_forward(bars: DataFrame, seconds: int = 900, most: int = 300) -> DataFrame:
    """Rows for gaps of at most `most` seconds beyond a bar width, with the last close and no volume (is_filled)."""
    nxt = F.unix_timestamp(F.lead("timestamp").over(by_symbol()))
    out = bars.withColumn("__t", F.unix_timestamp("timestamp")).withColumn("__n", nxt)
    last = F.least(F.col("__n") - seconds, F.col("__t") + F.lit(most // seconds * seconds))
    times = F.when(F.col("__n").isNotNull() & (last > F.col("__t")), F.sequence("__t", last, F.lit(seconds).cast("bigint"))).otherwise(F.array("__t"))
    out = out.select("symbol", "close", "volume", "__t", F.explode(times).alias("__at"))
    return out.select("symbol", F.timestamp_seconds("__at").alias("timestamp"), "close", F.when(F.col("__at") == F.col("__t"), F.col("volume")).otherwise(0).alias("volume"), (F.col("__at") != F.col("__t")).alias("is_filled"))


def split_adjusted(daily: DataFrame, splits: DataFrame) -> DataFrame:
    """daily with factor (product of split_from / split_to of later splits), adj_close and is_reverse_day."""
    per = splits.where("symbol is not null and date is not null").groupBy(F.col("symbol").cast(daily.schema["symbol"].dataType).alias("symbol"), F.col("date").cast("date").alias("date"))
    per = per.agg(F.sum(F.ln(F.col("split_from") / F.col("split_to"))).alias("__f"), F.max(F.col("split_from") > F.col("split_to")).alias("__r"))
    rows = daily.withColumn("__day", F.lit(True)).unionByName(per, allowMissingColumns=True)
    back = Window.partitionBy("symbol").orderBy(-F.unix_date("date"))  # from the end: what runs up to a day are the later splits
    later, same = F.sum("__f").over(back.rangeBetween(Window.unboundedPreceding, -1)), F.max("__r").over(back.rangeBetween(0, 0))
    out = rows.withColumn("factor", F.exp(F.coalesce(later, F.lit(0.0)))).withColumn("is_reverse_day", F.coalesce(same, F.lit(False))).where("__day").drop("__day", "__f", "__r")
    return out.withColumn("adj_close", F.col("close") * F.col("factor"))


def similar_vectors(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The k most similar vectors of the same label for each query (query_id, embedding, label): exact cosine, ties by vec_id."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    v = vectors.select("vec_id", "label", F.col("embedding").alias("v"))
    q = queries.select("query_id", "label", F.col("embedding").alias("q"))
    out = v.join(q, "label").where("vec_id <> query_id").withColumn("cosine", F.try_divide(dot("v", "q"), F.sqrt(dot("v", "v")) * F.sqrt(dot("q", "q"))))
    w = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "vec_id")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "vec_id", "cosine", "rank")


def similar_outcomes(neighbours: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Per query: how many of its neighbours (query_id, vec_id, cosine) have an outcome (vec_id, outcome), their mean and its mean weighted by cosine."""
    joined = neighbours.join(outcomes, "vec_id", "left")
    weight = F.when(F.col("outcome").isNotNull(), F.col("cosine"))
    return joined.groupBy("query_id").agg(
        F.count("*").alias("n"), F.count("outcome").alias("n_known"), F.avg("outcome").alias("mean_outcome"), F.try_divide(F.sum(F.col("cosine") * F.col("outcome")), F.sum(weight)).alias("weighted_outcome")
    )


def exponential_mean(rows: DataFrame, column: str, span: int, name: str, by: str = "symbol", order: str = "date", block: int = 1024) -> DataFrame:
    """by, order and name: the mean m = (1 - a) m + a x with a = 2 / (span + 1), from the first value on; at a null the mean so far.

    Each step is m -> p m + q, and steps compose: a block of so many values is one p and one q, which put together in order say what
    each block starts from; inside, a fold takes one value after the other. Expressions only, and no array longer than a block,
    but for one element per block of a group.
    """
    so_far = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.select(by, order, F.col(column).cast("double").alias("__x")).withColumn("__i", F.count("__x").over(so_far) - 1)
    known = out.where("__x is not null").select(by, F.expr(f"__i div {block}").alias("__b"), (F.col("__i") % block).alias("k"), F.col("__x").alias("x"))
    blocks = known.groupBy(by, "__b").agg(F.sort_array(F.collect_list(F.struct("k", "x"))).alias("xs"))
    step = lambda m, x: F.when(m.isNull(), x).otherwise(m * (span - 1) / (span + 1) + x * 2 / (span + 1))
    alone = F.aggregate("xs", F.when(F.col("__b") > 0, 0.0), lambda m, e: step(m, e["x"]))
    summed = blocks.select(by, F.struct("__b", F.pow(F.lit((span - 1) / (span + 1)), F.size("xs")).alias("p"), alone.alias("q")).alias("s"))
    first = F.struct(F.array().cast("array<struct<b:bigint,m:double>>").alias("out"), F.lit(None).cast("double").alias("m"))
    fold = F.aggregate(F.sort_array(F.collect_list("s")), first, lambda a, e: F.struct(F.concat(a["out"], F.array(F.struct(e["__b"].alias("b"), a["m"].alias("m")))).alias("out"), (F.coalesce(a["m"] * e["p"], F.lit(0.0)) + e["q"]).alias("m")))
    carried = summed.groupBy(by).agg(fold["out"].alias("c")).select(by, F.explode("c").alias("c")).select(by, F.col("c.b").alias("__b"), F.col("c.m").alias("__m"))
    start = F.struct(F.array().cast("array<double>").alias("out"), F.col("__m").alias("m"))
    run = F.aggregate("xs", start, lambda a, e: F.struct(F.concat(a["out"], F.array(step(a["m"], e["x"]))).alias("out"), step(a["m"], e["x"]).alias("m")))
    means = blocks.join(carried, [by, "__b"]).select(by, "__b", F.posexplode(run["out"]).alias("__k", name)).select(by, (F.col("__b") * block + F.col("__k")).alias("__i"), name)
    return out.join(means, [by, "__i"], "left").select(by, order, name)


def indicators(daily: DataFrame, fast: int = 12, slow: int = 26) -> DataFrame:
    """daily with bollinger bands (20, 2), rsi14 (sums), volume_ratio, and macd: the exponential means of all closes so far.

    The means are recursions, computed as prefix scans (exponential_mean); null closes are passed over.
    """
    w = last_rows(by_daily(), 20)
    mean, dev = F.avg("close").over(w), F.stddev_pop("close").over(w)
    out = daily.withColumn("bb_mid", mean).withColumn("bb_up", mean + 2 * dev).withColumn("bb_low", mean - 2 * dev).withColumn("volume_ratio", ratio(F.col("volume"), mean_at_least("volume", rows_before(by_daily(), 20), 1)))
    change = F.col("close") - F.lag("close").over(by_daily())
    out = out.withColumn("__c", change)
    r = last_rows(by_daily(), 14)
    up, down = F.sum(F.greatest("__c", F.lit(0.0))).over(r), F.sum(F.greatest(-F.col("__c"), F.lit(0.0))).over(r)
    out = out.withColumn("rsi14", F.when(F.count("__c").over(r) == 14, ratio(100 * up, up + down))).drop("__c")

    fast_mean, slow_mean = (exponential_mean(daily, "close", n, f"__{n}") for n in (fast, slow))
    macd = fast_mean.join(slow_mean, ["symbol", "date"]).select("symbol", "date", (F.col(f"__{fast}") - F.col(f"__{slow}")).alias("macd"))
    return out.join(macd, ["symbol", "date"])


def volatility_ranking(daily: DataFrame, n: int = 100) -> DataFrame:
    """Symbols by the sum of their ranks in mean range, absolute gap and volume ratio."""
    r = daily.groupBy("symbol").agg(F.avg(ratio(F.col("high") - F.col("low"), F.col("close")) * 100).alias("range"), F.avg(F.abs("gap_pct")).alias("gap"), F.avg("rvol").alias("rvol"))
    total = sum((F.rank().over(Window.orderBy(F.desc(c))) for c in ("range", "gap", "rvol")), F.lit(0))  # one row per symbol
    return r.withColumn("total_rank", total).orderBy("total_rank", "symbol").limit(n)


def pattern_screens(daily: DataFrame, bars: DataFrame | None = None) -> DataFrame:
    """daily with red_to_green (opened under and closed over the close before), green_to_red, first_green (after three red days), first_red."""
    before = F.lag("close").over(by_daily())
    out = daily.withColumn("red_to_green", F.coalesce((F.col("open") < before) & (F.col("close") > before), F.lit(False))).withColumn("green_to_red", F.coalesce((F.col("open") > before) & (F.col("close") < before), F.lit(False)))
    green = (F.col("close") > F.col("open")).cast("int")
    past = F.sum(green).over(rows_before(by_daily(), 3))
    full = F.count("*").over(rows_before(by_daily(), 3)) == 3
    return out.withColumn("first_green", full & (past == 0) & (green == 1)).withColumn("first_red", full & (past == 3) & (green == 0))


def intraday_screens(bars: DataFrame) -> DataFrame:
    """Bars with pm_high_break (first close in RTH over the premarket high) and vwap_reclaim (close crosses the day's running VWAP upwards)."""
    m = minute_of_day(market_time(F.col("timestamp")))
    whole = Window.partitionBy("symbol", "date")
    out = bars.withColumn("__m", m).withColumn("pm_high", F.max(F.when(F.col("__m").between(240, 569), F.col("high"))).over(whole))
    over = F.coalesce(F.col("__m").between(570, 959) & (F.col("close") > F.col("pm_high")), F.lit(False))
    past = by_day().rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("__o", over).withColumn("pm_high_break", F.col("__o") & ~F.coalesce(F.max("__o").over(past), F.lit(False)))
    run = by_day().rowsBetween(Window.unboundedPreceding, 0)
    tp = (F.col("high") + F.col("low") + F.col("close")) / 3
    out = out.withColumn("__v", F.try_divide(F.sum(tp * F.col("volume")).over(run), F.sum("volume").over(run))).withColumn("__a", F.col("close") > F.col("__v"))
    return out.withColumn("vwap_reclaim", F.coalesce(F.col("__a") & ~F.lag("__a").over(by_day()), F.lit(False))).drop("__m", "__o", "__v", "__a")


def trade_metrics(trades: DataFrame, by: tuple[str, ...] = ("pattern",)) -> DataFrame:
    """trades (pattern, closed, pnl): per pattern n, hit_rate, expectancy, profit_factor, sharpe, max_drawdown, loss_p95."""
    run = Window.partitionBy(*by).orderBy("closed", "trade_id").rowsBetween(Window.unboundedPreceding, 0)
    out = trades.withColumn("__e", F.sum("pnl").over(run)).withColumn("__d", F.max("__e").over(run) - F.col("__e"))
    win, loss = F.sum(F.greatest("pnl", F.lit(0.0))), F.sum(F.greatest(-F.col("pnl"), F.lit(0.0)))
    return out.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg((F.col("pnl") > 0).cast("double")).alias("hit_rate"), F.avg("pnl").alias("expectancy"), F.try_divide(win, loss).alias("profit_factor"),
        F.try_divide(F.avg("pnl"), F.stddev("pnl")).alias("sharpe"), F.max("__d").alias("max_drawdown"), F.percentile("pnl", F.lit(0.05)).alias("loss_p95"),
    )


def multi_event_symbols(events: DataFrame, hours: int = 1, least: int = 2) -> DataFrame:
    """Symbols with several bullish event types within the last hours of the table."""
    start = events.agg(F.max("timestamp") - F.expr(f"interval {hours} hours")).scalar()
    out = events.where((F.col("timestamp") >= start) & (F.col("event_bias") == "bullish")).groupBy("symbol").agg(F.count_distinct("event_type").alias("n_types"), F.count("*").alias("n"))
    return out.where(F.col("n_types") >= least)


def latest_features(bars: DataFrame) -> DataFrame:
    """The newest row of each symbol."""
    return bars.groupBy("symbol").agg(F.max_by(F.struct("timestamp", "close", "volume"), "timestamp").alias("x")).select("symbol", "x.*")


def double_bottoms(bars: DataFrame, rows: int = 5, dip: float = 0.02, near: float = 0.05) -> DataFrame:
    """Bars whose close, twice `rows` earlier, dipped, recovered by at least `dip` and came back to within `near` of the first dip."""
    one, two = F.lag("close", rows).over(by_symbol()), F.lag("close", 2 * rows).over(by_symbol())
    out = bars.withColumn("middle", one).withColumn("first", two)
    return out.where((F.col("middle") >= F.col("first") * (1 + dip)) & (F.col("close") <= F.col("middle") * (1 - dip)) & (F.abs(F.col("close") - F.col("first")) <= near * F.col("first")))


def event_sequences(events: DataFrame, first: str, then: str, minutes: int = 60) -> DataFrame:
    """Events of one type whose symbol's next event of another type comes within so many minutes."""
    w = Window.partitionBy("symbol").orderBy(F.desc("timestamp")).rangeBetween(Window.unboundedPreceding, Window.currentRow)  # from the end: one running minimum
    nxt = F.min(F.when(F.col("event_type") == then, F.col("timestamp"))).over(w)
    out = events.withColumn("next_time", nxt).where(F.col("event_type") == first)
    return out.where(F.unix_timestamp("next_time") - F.unix_timestamp("timestamp") <= 60 * minutes)


def flat_base_breakouts(events: DataFrame, daily: DataFrame, run_pct: float = 100.0) -> DataFrame:
    """Daily events with flat_base of the day before, max_run_pct, big_run and is_flat_base_breakout (a range or volume event out of a flat base)."""
    base = daily.withColumn("had_flat_base", F.coalesce(F.lag("is_flat_base").over(by_daily()), F.lit(False))).withColumn("max_run_pct", (ratio(F.max("high").over(by_daily().rowsBetween(1, 5)), F.col("close")) - 1) * 100)
    out = events.join(base.select("symbol", "date", "had_flat_base", "max_run_pct"), ["symbol", "date"], "left")
    return out.withColumn("big_run", F.coalesce(F.col("max_run_pct") >= run_pct, F.lit(False))).withColumn("is_flat_base_breakout", F.coalesce(F.col("had_flat_base"), F.lit(False)) & (F.col("is_ire") | F.col("is_vswg")))


def tape_windows(events: DataFrame, before: int = 3, after: int = 7, wide_before: int = 10, wide_after: int = 20, spike: float = 8.0) -> DataFrame:
    """events with window_before_min and window_after_min: the wide ones where the spike is strong."""
    strong = F.coalesce(F.col("spike_x") >= spike, F.lit(False))
    return events.withColumn("window_before_min", F.when(strong, wide_before).otherwise(before)).withColumn("window_after_min", F.when(strong, wide_after).otherwise(after))
