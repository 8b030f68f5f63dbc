"""Alerts: users' rules as rows, matched with events and ranked, in batch and on streams."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.storage import saved

#: The event types and sessions that a rule without its own means.
TYPES = ("volume_spike", "vwap_break", "price_momentum", "consolidation_break", "opening_range_break", "flush", "tape_speed")
SESSIONS = ("PM", "RTH", "AH", "CLOSED")
LIMITS = ("symbols", "direction", "min_price", "max_price", "min_score", "min_spike")
#: Days of one event type that are broadcast hold so many events at most.
BROADCAST_EVENTS = 200_000
RULES = "rule_id long, user long, event_types array<string>, sessions array<string>, symbols array<string>, direction string, min_price double, max_price double, min_score double, min_spike double"


def _order() -> list[Column]:
    """Which of a day's events comes first."""
    return [F.desc_nulls_last("score"), *map(F.col, ("timestamp", "symbol", "event_type", "direction"))]


def _every(c: str, values: tuple[str, ...]) -> Column:
    """What a rule names, or all of values."""
    return F.array_distinct(F.coalesce(c, F.array(*map(F.lit, values))))


def _fits(e: Callable[[str], Column]) -> list[Column]:
    """For each limit of a rule (`__` before its name) whether the event whose columns e returns is within; a null in a rule doesn't limit."""
    fits = lambda limit, ok: F.col(f"__{limit}").isNull() | F.coalesce(ok, F.lit(False))
    return [
        fits("symbols", F.array_contains("__symbols", e("symbol"))), fits("direction", e("direction") == F.col("__direction")), fits("min_price", e("close") >= F.col("__min_price")),
        fits("max_price", e("close") <= F.col("__max_price")), fits("min_score", e("score") >= F.col("__min_score")), fits("min_spike", e("spike_x") >= F.col("__min_spike")),
    ]


def matched(events: DataFrame, rules: DataFrame) -> DataFrame:
    """rule_id, user and the event for each rule that an event fits; a null in a rule doesn't limit.

    Rules are laid over their types and sessions, so events and rules meet by equality on these. A null score or spike doesn't
    fit a rule that asks for one.
    """
    laid = rules.withColumn("event_type", F.explode(_every("event_types", TYPES))).withColumn("session", F.explode(_every("sessions", SESSIONS)))
    laid = laid.select("event_type", "session", *[F.col(c).alias(f"__{c}") for c in ("rule_id", "user", *LIMITS)])
    both = events.join(laid, ["event_type", "session"])
    for ok in _fits(F.col):
        both = both.where(ok)
    return both.select(F.col("__rule_id").alias("rule_id"), F.col("__user").alias("user"), *events.columns)


def ranked(alerts: DataFrame, per_user: int = 10) -> DataFrame:
    """Each user's first alerts of each date by score, one per event whatever the number of rules it fits (the smallest rule_id is named)."""
    key = ["user", "symbol", "timestamp", "event_type", "direction"]
    one = alerts.groupBy(*key).agg(F.min("rule_id").alias("rule_id"), F.first("date").alias("date"), F.max("score").alias("score"))
    w = Window.partitionBy("user", "date").orderBy(*_order())
    return one.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= per_user)


def _worth_keeping(events: DataFrame, rules: DataFrame, per_user: int) -> DataFrame:
    """The events that can be among the first per_user of some rule on their date.

    An event gives way to those before it that fit every rule it fits: of its type (and direction, session or symbol, where a rule asks
    for one), and with a price or spike no worse. Those to which none gives way are a layer; an event in a later layer than
    the per_user-th has at least per_user such events before it. Where rules limit two of price from below, from above and spike,
    all events stay.
    """
    asks = rules.agg(*[(F.count(c) > 0).alias(c) for c in ("sessions", *LIMITS)]).first()
    if not asks["sessions"]:
        events = events.where(F.col("session").isin(*SESSIONS))
    least = lambda c: F.when(F.isnan(c), float("-inf")).otherwise(F.coalesce(-F.col(c), F.lit(float("nan"))))  # noqa: E731  null is worst, NaN is over any limit
    sides = {"max_price": F.coalesce(F.col("close").cast("double"), F.lit(float("nan"))), "min_price": least("close"), "min_spike": least("spike_x")}
    worse = [x for c, x in sides.items() if asks[c]]
    if len(worse) > 1:
        return events
    by = ["date", "event_type", *[c for c, rule in (("direction", "direction"), ("session", "sessions"), ("symbol", "symbols")) if asks[rule]]]
    before = Window.partitionBy(*by).orderBy(*_order()).rowsBetween(Window.unboundedPreceding, -1)
    out = events.withColumn("__left", worse[0] if worse else F.lit(0.0)).withColumn("__kept", F.lit(False))
    for _ in range(per_user):
        out = out.withColumn("__best", F.min("__left").over(before))
        first = F.col("__left").isNotNull() & (F.col("__best").isNull() | (F.col("__best") > F.col("__left")))
        out = out.withColumn("__first", first).withColumn("__kept", F.col("__kept") | F.col("__first")).withColumn("__left", F.when(~F.col("__first"), F.col("__left")))
    return out.where("__kept").drop("__left", "__kept", "__best", "__first")


def best(events: DataFrame, rules: DataFrame, per_user: int = 10) -> DataFrame:
    """What ranked(matched(events, rules), per_user) returns, without a row for each pair; events: one row of a symbol, time, type and direction.

    Events that are worth keeping lie in a list for each type and date, first ones first. A rule takes the first per_user of each
    list that it fits, which holds its user's first ones and, for these, every rule that they fit. Rules are dealt by user and lists are
    broadcast (unless they are long), so what a user gets is ranked where it is found.
    """
    kept = _worth_keeping(events, rules, per_user)
    place = F.row_number().over(Window.partitionBy("date", "event_type").orderBy(*_order())).alias("place")
    item = F.struct("place", *[c for c in ("symbol", "timestamp", "direction", "session", "close", "score", "spike_x")])
    days = saved(kept.select("*", place).groupBy("event_type", "date").agg(F.sort_array(F.collect_list(item)).alias("list")), "days")
    few = (days.agg(F.sum(F.size("list"))).first()[0] or 0) <= BROADCAST_EVENTS
    n = max(1, int(rules.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    laid = rules.repartition(n, "user").select("rule_id", "user", F.explode(_every("event_types", TYPES)).alias("event_type"), _every("sessions", SESSIONS).alias("__sessions"), *[F.col(c).alias(f"__{c}") for c in LIMITS])
    met = laid.join(F.broadcast(days) if few else days, "event_type")
    fits = lambda e: reduce(lambda a, b: a & b, _fits(lambda c: e[c]), F.array_contains("__sessions", e["session"]))
    found = met.select("rule_id", "user", "event_type", "date", F.explode(F.slice(F.filter("list", fits), 1, per_user)).alias("e"))
    return ranked(found.select("rule_id", "user", "event_type", "date", "e.symbol", "e.timestamp", "e.direction", "e.score"), per_user)


def alerting(spark: SparkSession, rules_path: str, out_path: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch over events: the alerts of each batch under its number. Rules are read anew for each batch, so a changed
    rule counts from the next one on; a batch that runs again writes the same folder."""

    def step(batch: DataFrame, number: int) -> None:
        rules = spark.read.schema(RULES).parquet(rules_path)
        matched(batch, rules).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out_path)

    return step
