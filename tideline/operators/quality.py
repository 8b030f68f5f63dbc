"""Data-quality and audit jobs over bars, events, logs and file lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.quantiles import exact_quantiles, quantile_columns
from tideline.functions.time import market_time, session_of
from tideline.storage import saved

from .aggregates import daily_rate, outliers, side_by_side
from .rolling import bucket_repeats

def _status(code: str, reason: str) -> str:
    """A pattern for a number that reads as a status: after a word that announces one, alone in parentheses, or before its reason; in
    other places it counts or names something."""
    return rf"\b(?:http\S*|\w*status|\w*code|\w*error|response|returned|received|got)[\s:=(\"'-]*{code}\b|\({code}\)|\b{code}\W+(?:{reason})"


#: Classes of log lines; the first that matches counts.
LOG_CLASSES = (
    ("rate_limit", f"({_status('429', 'too many|client error')}|rate limit)"), ("timeout", r"(timed? ?out|timeout)"), ("connection", r"(connection|reset by peer|refused)"), ("not_found", f"({_status('404', 'client error')}|not found)"),
    ("server", _status(r"5\d\d", "server error|internal|not implemented|bad gateway|service|gateway")), ("memory", r"(memoryerror|out of memory)"), ("error", r"(error|exception|traceback)"),
)
#: Lines that are no errors.
LOG_EXCLUDED = r"(debug|retrying|0 errors)"


def bar_quality(bars: DataFrame) -> DataFrame:
    """One row: rows, surplus rows of equal (symbol, timestamp), nulls per column, rows that step back in time in file order (id, if there)."""
    keyed = bars.groupBy("symbol", "timestamp").agg(F.count("*").alias("c")).agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("n_duplicates"))
    row = bars.agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("open", "high", "low", "close", "volume")])
    out = side_by_side(row, keyed).withColumn("is_empty", F.col("n_rows") == 0)
    if "id" in bars.columns:
        w = Window.partitionBy("symbol").orderBy("id")
        steps = bars.withColumn("__b", F.lag("timestamp").over(w) > F.col("timestamp")).agg(F.count_if(F.col("__b")).alias("n_unsorted"))
        out = side_by_side(out, steps)
    return out


def kpi_alerts(events: DataFrame, max_day: int = 50) -> DataFrame:
    """(kpi, value, alert) of daily rates, outliers and bucket repeats."""
    rate = daily_rate(events).select(F.lit("events_per_symbol_day_max").alias("kpi"), F.col("max").cast("double").alias("value"), (F.col("max") > max_day).alias("alert"))
    far = outliers(events).select(F.concat("metric", F.lit("_median")).alias("kpi"), F.col("median").alias("value"), "alert")
    again = bucket_repeats(events).agg(F.count("*").alias("n")).select(F.lit("bucket_repeats").alias("kpi"), F.col("n").cast("double").alias("value"), (F.col("n") > 0).alias("alert"))
    return rate.unionByName(far).unionByName(again)


def reconciled(manifest: DataFrame, checkpoint: DataFrame, output: DataFrame, key: str = "symbol") -> DataFrame:
    """(in_manifest, in_checkpoint, in_output, n) of the keys."""
    parts = [d.select(key).distinct().withColumn(n, F.lit(True)) for d, n in ((manifest, "in_manifest"), (checkpoint, "in_checkpoint"), (output, "in_output"))]
    out = parts[0].join(parts[1], key, "full_outer").join(parts[2], key, "full_outer").fillna(False)
    return out.groupBy("in_manifest", "in_checkpoint", "in_output").agg(F.count("*").alias("n"))


def oversized(files: DataFrame, max_days: int, max_mb: float) -> DataFrame:
    """files (symbol, date, bytes): days and MB per symbol beyond either limit."""
    out = files.groupBy("symbol").agg(F.count_distinct("date").alias("days"), (F.sum("bytes") / 1e6).alias("mb"))
    return out.where((F.col("days") > max_days) | (F.col("mb") > max_mb))


def log_classes(lines: DataFrame, classes=LOG_CLASSES, excluded: str = LOG_EXCLUDED) -> DataFrame:
    """(class, n): the first pattern that a line (value) meets; lines that are excluded or meet none are left out.

    Neither a leading time nor a place "[n/N]" is looked at: their digits read like a status.
    """
    low, name = F.regexp_replace(F.lower("value"), r"^\d{4}-\d\d-\d\d[ t]\d\d:\d\d:\d\d\S*|\[\d+/\d+\]", ""), F.lit(None).cast("string")
    for c, pattern in reversed(classes):
        name = F.when(low.rlike(pattern), c).otherwise(name)
    return lines.where(~low.rlike(excluded)).groupBy(name.alias("class")).agg(F.count("*").alias("n")).where("class is not null")


#: Error types of a log, any case, and what marks a line that is none of them.
ERROR_TYPES = (("ERROR", r"ERROR"), ("FAILED", r"FAILED"), ("Exception", r"Exception"), ("Traceback", r"Traceback"), ("HTTP 429 Rate Limit", r"429.*Too Many"), ("WinError", r"WinError"), ("FileNotFoundError", r"FileNotFoundError"))
NO_ERROR = r"Skipping|\[\d+/\d+\]|Failed: 0|_log_heartbeat|DEBUG"


def log_error_types(lines: DataFrame, types=ERROR_TYPES, excluded: str = NO_ERROR) -> DataFrame:
    """(class, n): how many lines (value) meet each pattern, any case; a line counts for every one it meets. Lines that are excluded, or
    tell of a retry, count for none."""
    real = lines.where(~F.col("value").rlike(excluded) & ~F.lower("value").contains("retrying"))
    met = F.filter(F.array(*[F.when(F.col("value").rlike(f"(?i){p}"), F.lit(n)) for n, p in types]), lambda x: x.isNotNull())
    return real.select(F.explode(met).alias("class")).groupBy("class").agg(F.count("*").alias("n"))


def log_progress(lines: DataFrame) -> DataFrame:
    """From lines "YYYY-MM-DD HH:MM:SS ... [n/N]": last place, total, rate per minute and minutes to go."""
    p = lines.select(F.try_to_timestamp(F.regexp_extract("value", r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d)", 1)).alias("ts"), F.expr(r"try_cast(regexp_extract(value, '\\[(\\d+)/(\\d+)\\]', 1) as long)").alias("n"), F.expr(r"try_cast(regexp_extract(value, '\\[(\\d+)/(\\d+)\\]', 2) as long)").alias("total")).where("ts is not null and n is not null")
    out = p.agg(F.max_by("n", F.struct("ts", "n")).alias("done"), F.min_by("n", F.struct("ts", "n")).alias("first"), F.max("total").alias("total"), ((F.max(F.unix_timestamp("ts")) - F.min(F.unix_timestamp("ts"))) / 60).alias("minutes"))
    out = out.withColumn("rate", F.try_divide(F.col("done") - F.col("first"), F.col("minutes")))
    return out.withColumn("eta_minutes", F.try_divide(F.col("total") - F.col("done"), F.col("rate")))


def repeated_work(heartbeat: DataFrame) -> DataFrame:
    """Symbols that a tab-separated heartbeat (time, symbol, ...) names more than once, and their share."""
    n = heartbeat.select(F.get(F.split("value", "\t"), F.lit(1)).alias("symbol")).groupBy("symbol").agg(F.count("*").alias("n"))
    return n.agg(F.count("*").alias("n_symbols"), F.count_if(F.col("n") > 1).alias("n_repeated"), F.try_divide(F.count_if(F.col("n") > 1).cast("double"), F.count("*")).alias("rate"))


def run_statistics(events: DataFrame, run: str = "run_id") -> DataFrame:
    """Events, symbols and duplicates per run."""
    out = events.groupBy(run).agg(F.count("*").alias("n_events"), F.count_distinct("symbol").alias("n_symbols"), F.count_distinct("symbol", "timestamp", "event_type").alias("n_keys"))
    return out.withColumn("duplicates", F.col("n_events") - F.col("n_keys"))


def manifest_counts(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("session").agg(F.count("*").alias("n"), F.count_distinct("symbol").alias("n_symbols"))


def dq_thresholds(daily: DataFrame, max_missing: float = 5.0, max_null: float = 1.0, sigma: float = 5.0) -> DataFrame:
    """Per symbol: missing weekdays in percent, null closes in percent, closes beyond sigma deviations, and fail."""
    stats = daily.groupBy("symbol").agg(F.min("date").alias("a"), F.max("date").alias("b"), F.count("*").alias("n"), F.count_if(F.dayofweek("date").between(2, 6)).alias("have"), F.count_if(F.col("close").isNull()).alias("n_null"), F.avg("close").alias("m"), F.stddev("close").alias("s"))
    span = F.datediff("b", "a") + 1
    # Weekdays in a span: five of each whole week, and those of the days left over.
    left = F.aggregate(F.sequence(F.lit(0), F.lit(6)), F.lit(0), lambda acc, i: acc + F.when((i < span % 7) & (F.weekday(F.date_add("a", i)) < 5), 1).otherwise(0))
    stats = stats.withColumn("expected", F.floor(span / 7) * 5 + left)
    far = daily.join(stats.select("symbol", "m", "s"), "symbol").where(F.abs(F.col("close") - F.col("m")) > sigma * F.col("s")).groupBy("symbol").agg(F.count("*").alias("n_outliers"))
    out = stats.join(far, "symbol", "left").fillna(0, ["n_outliers"])
    out = out.withColumn("missing_pct", F.greatest(F.lit(0.0), F.try_divide((F.col("expected") - F.col("have")) * 100.0, F.col("expected")))).withColumn("null_pct", F.try_divide(F.col("n_null") * 100.0, F.col("n")))
    return out.withColumn("fail", (F.coalesce("missing_pct", F.lit(0.0)) > max_missing) | (F.col("null_pct") > max_null) | (F.col("n_outliers") > 0)).select("symbol", "missing_pct", "null_pct", "n_outliers", "fail")


def recommended_checks(events: DataFrame, ssr: str = "ssr", min_dollar_volume: float = 150_000, max_spread: float = 0.03, price: tuple[float, float] = (5.0, 100.0), min_rvol: float = 2.0) -> DataFrame:
    """(name, value, ok): sessions that don't fit their New York time, medians of dollar volume and spread, share of rows with a flag for
    short-sale restrictions, mean price, mean relative volume. Medians are exact."""
    wrong = F.count_if(~F.col("session").eqNullSafe(session_of(market_time(F.col("timestamp"))))).cast("double")
    events = saved(events.select("session", "timestamp", "dollar_volume_bar", "spread_proxy", ssr, "close", "rvol_day"), "checked")
    half = exact_quantiles(events, {"dollar_volume_bar": (0.5,), "spread_proxy": (0.5,)})
    row = events.agg(
        wrong.alias("tz"), *quantile_columns(half, "dollar_volume_bar", ((0.5, "dv"),)), *quantile_columns(half, "spread_proxy", ((0.5, "spread"),)), F.avg(F.col(ssr).isNotNull().cast("double")).alias("ssr"),
        F.avg("close").alias("price"), F.avg("rvol_day").alias("rvol"),
    )
    checks = [("timezone", "tz", F.col("tz") == 0), ("dollar_volume_median", "dv", F.col("dv") >= min_dollar_volume), ("spread_median", "spread", F.col("spread") <= max_spread), ("ssr_present", "ssr", F.col("ssr") == 1), ("price_mean", "price", F.col("price").between(*price)), ("rvol_mean", "rvol", F.col("rvol") >= min_rvol)]
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).cast("double").alias("value"), F.coalesce(ok, F.lit(False)).alias("ok")) for n, c, ok in checks])).alias("x")).select("x.*")


def extra_checks(events: DataFrame, max_type_share: float = 0.60, min_months: int = 30) -> DataFrame:
    """(name, value, ok): the largest share of a type, months covered, nulls in the key."""
    top = events.groupBy("event_type").agg(F.count("*").alias("c")).agg(F.max("c").alias("top"))
    row = events.agg(F.count("*").alias("n"), F.count_distinct(F.date_format("timestamp", "yyyy-MM")).alias("months"), F.count_if(F.col("symbol").isNull() | F.col("timestamp").isNull() | F.col("event_type").isNull()).alias("nulls"))
    row = side_by_side(row, top)
    share = F.try_divide(F.col("top").cast("double"), F.col("n"))
    checks = [("max_type_share", share, share < max_type_share), ("months", F.col("months").cast("double"), F.col("months") >= min_months), ("null_keys", F.col("nulls").cast("double"), F.col("nulls") == 0)]
    return row.select(F.explode(F.array(*[F.struct(F.lit(a).alias("name"), b.alias("value"), c.alias("ok")) for a, b, c in checks])).alias("x")).select("x.*")
