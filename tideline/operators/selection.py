"""Deduplication, ranking, sampling and the selection cascade; every row that falls out says where and why."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.config import ManifestConfig, SessionLimits
from tideline.functions.quantiles import exact_quantiles, quantile_columns
from tideline.functions.scalars import null_count, ratio, with_derived
from tideline.functions.time import market_time, minute_of_day
from tideline.storage import saved

from .aggregates import side_by_side

KEY = ("symbol", "timestamp", "event_type")


def exact_dedup(events: DataFrame, key: tuple[str, ...] = KEY, tie: tuple[str, ...] = ("direction",)) -> DataFrame:
    """One row per key: highest score (none last), then fewest nulls, then the tie columns."""
    w = Window.partitionBy(*key).orderBy(F.desc_nulls_last("score"), "__nulls", *tie)
    out = events.withColumn("__nulls", null_count(events, key)).withColumn("__r", F.row_number().over(w))
    return out.where("__r = 1").drop("__nulls", "__r")


def dedup_stats(before: DataFrame, after: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    a = before.agg(F.count("*").alias("n_before"))
    b = after.agg(F.count("*").alias("n_after"), F.count_distinct(*key).alias("n_keys"), F.count_distinct("symbol").alias("n_symbols"))
    out = side_by_side(a, b).withColumn("removed", F.col("n_before") - F.col("n_after")).withColumn("removed_pct", F.try_divide(F.col("removed") * 100.0, F.col("n_before")))
    return out.withColumn("residual", F.col("n_after") - F.col("n_keys"))


def score_order() -> list[Column]:
    """Score, relative volume and dollar volume down (nulls first), then time up, then the rest of the key."""
    return [F.desc_nulls_first("score"), F.desc_nulls_first("rvol_day"), F.desc_nulls_first("dollar_volume_bar"), F.asc("timestamp"), F.asc("symbol"), F.asc("event_type")]


def top_per_group(df: DataFrame, by: tuple[str, ...], n: int, order: list[Column], rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= n)


def enriched(events: DataFrame, daily: DataFrame) -> DataFrame:
    """events with dollar_volume_day, rvol_day and rvol_day_missing of their New York day, vwap_min, dollar_volume_bar, spread_proxy and enriched."""
    et = events.withColumn("timestamp_et", market_time(F.col("timestamp"))).withColumn("date_et", F.to_date("timestamp_et")).withColumn("hour_et", F.hour("timestamp_et")).withColumn("minute_et", F.minute("timestamp_et"))
    day = daily.select("symbol", F.col("date").alias("date_et"), F.col("dollar_volume").alias("dollar_volume_day"), "rvol_day", "rvol_day_missing")
    out = with_derived(et.join(day, ["symbol", "date_et"], "left"))
    return out.withColumn("rvol_day_missing", F.coalesce("rvol_day_missing", F.lit(True))).withColumn("enriched", F.col("dollar_volume_day").isNotNull())


def liquidity_reason(cfg: ManifestConfig, tests: tuple[str, ...] = ("dollar_volume_bar", "volume", "dollar_volume_day", "rvol_day", "spread_proxy")) -> Column:
    """Null if a row passes its session's tests, else the reason. A null relative volume passes; other nulls and unknown sessions don't."""
    reason = F.lit("unknown_session")
    for session, x in cfg.limits.items():
        rules = {
            "dollar_volume_bar": F.col("dollar_volume_bar") >= x.dollar_volume_bar, "volume": F.col("volume") >= x.volume_bar, "dollar_volume_day": F.col("dollar_volume_day") >= x.dollar_volume_day,
            "rvol_day": F.coalesce(F.col("rvol_day") >= x.rvol_day, F.lit(True)), "spread_proxy": F.col("spread_proxy") <= x.spread,
        }
        ok = reduce(lambda a, b: a & b, [rules[t] for t in tests])
        own = F.when(ok, F.lit(None).cast("string")).when(~ok, f"{session}_liquidity").otherwise("null_metric")
        reason = F.when(F.col("session") == session, own).otherwise(reason)
    return reason


def cascade(events: DataFrame, cfg: ManifestConfig = ManifestConfig(), tests: tuple[str, ...] | None = None) -> DataFrame:
    """events with year, month, date_only, clipped price, ranks, and descarte_stage and descarte_reason: null for the manifest's rows.

    Stages: score, liquidity by session, cap per symbol and month, per symbol and day, per symbol, over all. A rank
    counts only rows that came so far, so each stage is one window over the survivors; the last one ranks through the
    range-partitioned top of a limit, not through one task. What the first two stages discard is set aside before any
    window, and what the windows have ranked is written once.
    """
    out = events.withColumn("year", F.year("timestamp")).withColumn("month", F.month("timestamp")).withColumn("date_only", F.to_date("timestamp"))
    out = out.withColumn("price_raw", F.col("close")).withColumn("price_clipped", F.greatest(F.least("close", F.lit(cfg.price_max)), F.lit(cfg.price_min)))
    stage, why = F.lit(None).cast("string"), liquidity_reason(cfg, tests) if tests else liquidity_reason(cfg)
    low = ~F.coalesce(F.col("score") >= cfg.min_score, F.lit(False))
    out = out.withColumn("__why", why)
    out = out.withColumn("descarte_stage", F.when(low, "stage1_quality").when(F.col("__why").isNotNull(), "stage2_liquidity").otherwise(stage))
    out = out.withColumn("descarte_reason", F.when(low, "low_score").otherwise(F.col("__why"))).drop("__why")
    out = saved(out, "judged")
    early, out = out.where("descarte_stage is not null"), out.where("descarte_stage is null")
    order = [*score_order(), F.xxhash64(*events.columns)]  # only rows that are alike in all columns are left in any order
    caps = [("stage3_month_cap", "rank_symbol_month", ("symbol", "year", "month"), cfg.per_symbol_month), ("stage3b_day_cap", "rank_symbol_day", ("symbol", "date_only"), cfg.per_symbol_day), ("stage5_symbol_cap", "rank_symbol_total", ("symbol",), cfg.per_symbol)]
    for name, rank, by, most in caps:
        w = Window.partitionBy(*by, F.col("descarte_stage").isNull()).orderBy(*order)
        out = out.withColumn(rank, F.when(F.col("descarte_stage").isNull(), F.row_number().over(w)))
        over = F.col("descarte_stage").isNull() & (F.col(rank) > most)
        out = out.withColumn("descarte_reason", F.when(over, F.lit(rank.replace("rank_", "cap_"))).otherwise(F.col("descarte_reason"))).withColumn("descarte_stage", F.when(over, F.lit(name)).otherwise(F.col("descarte_stage")))
    out = saved(out, "ranked")
    # A symbol, null too, and the rank within it name one row.
    kept = out.where("descarte_stage is null").orderBy(*order).limit(cfg.max_events).select(F.col("symbol").alias("__symbol"), F.col("rank_symbol_total").alias("__rank"), F.lit(True).alias("__kept"))
    out = out.join(kept, F.col("symbol").eqNullSafe(F.col("__symbol")) & (F.col("rank_symbol_total") == F.col("__rank")), "left").drop("__symbol", "__rank")
    over = F.col("descarte_stage").isNull() & F.col("__kept").isNull()
    late = out.withColumn("descarte_reason", F.when(over, "global_cap").otherwise(F.col("descarte_reason"))).withColumn("descarte_stage", F.when(over, "stage5_global_cap").otherwise(F.col("descarte_stage"))).drop("__kept")
    return late.unionByName(early, allowMissingColumns=True)


def kept_and_discarded(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    return flagged.where("descarte_stage is null").drop("descarte_stage", "descarte_reason"), flagged.where("descarte_stage is not null")


def attribution(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy(F.coalesce("descarte_stage", F.lit("kept")).alias("stage"), F.coalesce("descarte_reason", F.lit("")).alias("reason")).agg(F.count("*").alias("n"))


def session_quotas(kept: DataFrame, cfg: ManifestConfig = ManifestConfig()) -> DataFrame:
    """(session, n, share, low, high, verdict); changes no rows."""
    limits = kept.sparkSession.createDataFrame([(s, float(a), float(b)) for s, (a, b) in cfg.quotas.items()], "session string, low double, high double")
    counts = kept.groupBy("session").agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy()))  # one row per session
    out = limits.join(counts, "session", "left").fillna(0, ["n"]).withColumn("total", F.max("total").over(Window.partitionBy()))
    out = out.withColumn("share", F.coalesce(F.try_divide("n", "total"), F.lit(0.0)))
    return out.withColumn("verdict", F.when(F.col("share") < F.col("low"), "below").when(F.col("share") > F.col("high"), "above").otherwise("ok")).drop("total")


def sanity_checks(kept: DataFrame, cfg: ManifestConfig = ManifestConfig()) -> DataFrame:
    """(name, value, ok) of ten checks."""
    kept = saved(kept.select("symbol", "session", "score", "rvol_day"), "kept")
    half = exact_quantiles(kept, {"score": (0.5,), "rvol_day": (0.5,)})
    top = kept.groupBy("symbol").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "symbol").limit(20).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("top"))
    share = lambda s: F.coalesce(F.avg((F.col("session") == s).cast("double")), F.lit(0.0)).alias(s)
    row = kept.agg(F.count("*").alias("n"), F.count_distinct("symbol").alias("symbols"), *quantile_columns(half, "score", ((0.5, "score"),)), *quantile_columns(half, "rvol_day", ((0.5, "rvol"),)), share("PM"), share("RTH"), share("AH"))
    row = side_by_side(row, top)
    n = F.col("n").cast("double")
    checks = [("total_events", n, n.between(*cfg.events_range)), ("symbols", F.col("symbols").cast("double"), F.col("symbols") >= cfg.min_symbols), ("score_median", F.col("score"), F.col("score") >= cfg.min_score_median), ("rvol_median", F.col("rvol"), F.col("rvol") >= cfg.min_rvol_median)]
    top20 = F.coalesce(F.try_divide(F.col("top").cast("double"), n), F.lit(0.0))
    checks.append(("top20_share", top20, top20 <= cfg.max_top20))
    checks += [(f"share_{s}", F.col(s), F.col(s).between(*cfg.quotas[s])) for s in ("PM", "RTH", "AH")]
    storage, days = n * cfg.storage_mb_p90 / 1024, n * cfg.seconds_p90 / 86400
    checks += [("storage_gb_p90", storage, storage <= cfg.max_storage_gb), ("time_days_p90", days, days <= cfg.max_days)]
    return row.select(F.explode(F.array(*[F.struct(F.lit(a).alias("name"), b.alias("value"), F.coalesce(c, F.lit(False)).alias("ok")) for a, b, c in checks])).alias("x")).select("x.*")


def manifest_summary(kept: DataFrame) -> DataFrame:
    """(section, value, n): counts by type and session, and the 20 busiest symbols."""
    parts = [kept.groupBy(F.lit(c).alias("section"), F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n")) for c in ("event_type", "session")]
    top = kept.groupBy(F.lit("top20").alias("section"), F.col("symbol").cast("string").alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(20)
    return reduce(DataFrame.unionByName, [*parts, top])


def freeze_metadata(kept: DataFrame, cfg: ManifestConfig = ManifestConfig()) -> DataFrame:
    """One row to be written beside a frozen manifest."""
    kept = saved(kept.select("symbol", "session", "score", "timestamp"), "kept")
    half = exact_quantiles(kept, {"score": (0.5,)})
    return kept.agg(
        F.count("*").alias("n_events"), F.count_distinct("symbol").alias("n_symbols"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"), *quantile_columns(half, "score", ((0.5, "score_median"),)),
        *[F.avg((F.col("session") == s).cast("double")).alias(f"share_{s.lower()}") for s in ("PM", "RTH", "AH")], (F.count("*") * cfg.storage_mb_p90 / 1024).alias("storage_gb_p90"),
    )


def priority(column: str, order: tuple[str, ...]) -> Column:
    """Place of a value in a list, those not in it last."""
    at = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(column))
    return F.when(at > 0, at).otherwise(len(order) + 1)


def bucket_quotas(events: DataFrame, buckets: dict[str, float], most: int) -> DataFrame:
    """The best int(most * share) of each New York clock bucket ("HHMM-HHMM", end exclusive)."""
    m = minute_of_day(market_time(F.col("timestamp")))
    bucket, quota = F.lit(None).cast("string"), F.lit(0)
    for name, share in buckets.items():
        a, b = (int(x[:2]) * 60 + int(x[2:]) for x in name.split("-"))
        inside = (m >= a) & (m < b)
        bucket, quota = F.when(inside, name).otherwise(bucket), F.when(inside, int(most * share)).otherwise(quota)
    out = events.withColumn("bucket", bucket).withColumn("__q", quota).where("bucket is not null")
    w = Window.partitionBy("bucket").orderBy(F.desc_nulls_last("score"), "timestamp", "symbol", "event_type", "direction")
    return out.withColumn("__r", F.row_number().over(w)).where("__r <= __q").drop("__q", "__r")


def bar_liquidity(events: DataFrame, limits: SessionLimits = SessionLimits()) -> DataFrame:
    spread = ratio(F.col("high") - F.col("low"), F.col("close")) * 100
    return events.where((F.col("dollar_volume") >= limits.dollar_volume_bar) & (F.col("volume") >= limits.volume_bar) & (spread <= limits.spread * 100))


def profile_manifest(events: DataFrame, sessions: tuple[str, ...], min_score: float, limits: SessionLimits, per_day: int, per_symbol: int, types: tuple[str, ...], most: int, buckets: dict[str, float] | None = None) -> DataFrame:
    """Sessions, score, liquidity, caps per symbol-day and symbol, then by type priority and score: bucket quotas or the first `most`."""
    best = [F.desc_nulls_last("score"), F.asc("timestamp"), F.asc("event_type"), F.asc("direction")]
    out = bar_liquidity(events.where(F.col("session").isin(*sessions) & (F.col("score") >= min_score)), limits)
    out = top_per_group(out, ("symbol", "date"), per_day, best, "rank_day")
    out = top_per_group(out, ("symbol",), per_symbol, best, "rank_symbol")
    if buckets:
        return bucket_quotas(out, buckets, most)
    return out.withColumn("priority", priority("event_type", types)).orderBy("priority", *best, "symbol").limit(most)


def stratified_sample(events: DataFrame, ranking: DataFrame, strata: list[tuple[str, int, int]], n: int, seed: int = 42) -> DataFrame:
    """n events of the symbols in each range of ranks [from, to), chosen by a keyed hash: the same ones every time."""
    name = F.lit(None).cast("string")
    for s, a, b in strata:
        name = F.when((F.col("rank") >= a) & (F.col("rank") < b), s).otherwise(name)
    out = events.join(ranking.select("symbol", name.alias("stratum")), "symbol").where("stratum is not null")
    w = Window.partitionBy("stratum").orderBy(drawn(seed), "symbol", "timestamp", "event_type")
    return out.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def drawn(seed: int) -> Column:
    """A keyed hash of an event: sorting by it draws the same ones every time."""
    return F.md5(F.concat_ws("|", F.lit(seed), "symbol", F.unix_micros("timestamp"), "event_type").cast("binary"))


def proportional_sample(events: DataFrame, by: tuple[str, ...], n: int, seed: int = 42) -> DataFrame:
    """About n events, each group with its share of them (rounded up), chosen by a keyed hash."""
    sizes = events.groupBy(*by).agg(F.count("*").alias("__size"))
    total = sizes.agg(F.sum("__size")).scalar()
    quota = sizes.select(*by, F.ceil(F.col("__size") * n / total).alias("__quota"))
    w = Window.partitionBy(*by).orderBy(drawn(seed), "symbol", "timestamp", "event_type")
    return events.withColumn("__r", F.row_number().over(w)).join(quota, list(by)).where("__r <= __quota").drop("__r", "__quota")


def rank_slice(ranking: DataFrame, offset: int, length: int, rank: str = "rank") -> DataFrame:
    """The rows of ranks offset + 1, ..., offset + length."""
    return ranking.where(F.col(rank).between(offset + 1, offset + length))


def discard_margin(flagged: DataFrame, cfg: ManifestConfig = ManifestConfig()) -> DataFrame:
    """Discarded rows with the share by which a score missed (null for other reasons)."""
    return flagged.where("descarte_stage is not null").withColumn("margin", F.when(F.col("descarte_reason") == "low_score", F.lit(cfg.min_score) - F.col("score")))


def stage_margins(flagged: DataFrame, cfg: ManifestConfig = ManifestConfig()) -> DataFrame:
    """Discarded rows with miss_field, miss_value and miss_limit: the score, the first liquidity test of the session that failed, or
    the rank that went over its cap. Null where a metric or the session is unknown, and for the global cap."""
    cases = [(F.col("descarte_reason") == "low_score", "score", F.col("score"), F.lit(cfg.min_score))]
    for session, x in cfg.limits.items():
        own = (F.col("descarte_stage") == "stage2_liquidity") & (F.col("session") == session)
        tests = (("dollar_volume_bar", x.dollar_volume_bar), ("volume", x.volume_bar), ("dollar_volume_day", x.dollar_volume_day), ("rvol_day", x.rvol_day))
        cases += [(own & (F.col(c) < limit), c, F.col(c), F.lit(float(limit))) for c, limit in tests]
        cases.append((own & (F.col("spread_proxy") > x.spread), "spread_proxy", F.col("spread_proxy"), F.lit(float(x.spread))))
    for stage, rank, most in (("stage3_month_cap", "rank_symbol_month", cfg.per_symbol_month), ("stage3b_day_cap", "rank_symbol_day", cfg.per_symbol_day), ("stage5_symbol_cap", "rank_symbol_total", cfg.per_symbol)):
        cases.append((F.col("descarte_stage") == stage, rank, F.col(rank), F.lit(most)))
    miss = F.lit(None).cast("struct<field:string,value:double,bound:double>")
    for when, field, value, limit in reversed(cases):
        miss = F.when(when, F.struct(F.lit(field).alias("field"), value.cast("double").alias("value"), limit.cast("double").alias("bound"))).otherwise(miss)
    out = flagged.where("descarte_stage is not null").withColumn("__m", miss)
    return out.withColumn("miss_field", F.col("__m.field")).withColumn("miss_value", F.col("__m.value")).withColumn("miss_limit", F.col("__m.bound")).drop("__m")


def relaxed_level(events: DataFrame, session: str, need: int, levels: list[SessionLimits]) -> DataFrame:
    """(level, n): rows of a session passing each level of limits; the first that reaches `need`, else the last."""
    own = events.where(F.col("session") == session)
    ok = [(F.col("dollar_volume_bar") >= x.dollar_volume_bar) & (F.col("spread_proxy") <= x.spread) for x in levels]
    row = own.agg(*[F.count_if(c).alias(f"n{i}") for i, c in enumerate(ok)])
    every = row.select(F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.col(f"n{i}").alias("n")) for i in range(len(levels))])).alias("x")).select("x.*")
    return every.orderBy((F.col("n") < need).cast("int"), F.when(F.col("n") >= need, F.col("level")).otherwise(-F.col("level"))).limit(1)
