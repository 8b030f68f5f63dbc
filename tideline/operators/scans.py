"""Running values over sorted groups of any size.

A window needs a group in one task. Here a range sort cuts the rows into parts wherever they fall, also inside a group; each
part is summed up per group, what comes in from the parts before is a window over those sums (a row per group and part),
and the rest is a window inside the part. A group that holds half of all rows is spread over half of all tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.storage import saved


def sorted_parts(rows: DataFrame, by: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """rows with __part and __at: written in the order of by and order (nulls first), __at rising within and over parts."""
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = [F.col(c).asc_nulls_first() for c in (*by, *order)]
    placed = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id())
    return saved(placed, "sorted").withColumn("__part", F.shiftright("__at", 33))


def inside(by: tuple[str, ...]) -> Window:
    """The window of a group within one part, in order."""
    return Window.partitionBy("__part", *by).orderBy("__at")


def with_carry(parts: DataFrame, by: tuple[str, ...], summary: dict[str, Column], carry: dict[str, Column]) -> DataFrame:
    """parts with the columns of carry: window expressions over the summaries of the parts before, in order."""
    sums = parts.groupBy("__part", *by).agg(*[c.alias(n) for n, c in summary.items()])
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    known = sums.select(F.col("__part").alias("__p"), *[F.col(c).alias(f"__by_{c}") for c in by], *[c.over(before).alias(n) for n, c in carry.items()])
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by], F.col("__part") == F.col("__p"))
    return parts.join(known, on).drop("__p", *[f"__by_{c}" for c in by])


def running_sum(rows: DataFrame, by: tuple[str, ...], order: tuple[str, ...], value: str, name: str) -> DataFrame:
    """rows with name: the sum of value over the rows before in their group."""
    parts = with_carry(sorted_parts(rows, by, order), by, {"__s": F.sum(value)}, {"__c": F.sum("__s")})
    own = F.sum(value).over(inside(by).rowsBetween(Window.unboundedPreceding, -1))
    return parts.withColumn(name, F.coalesce(own, F.lit(0)) + F.coalesce("__c", F.lit(0))).drop("__c", "__part", "__at")


def last_known(rows: DataFrame, by: tuple[str, ...], order: tuple[str, ...], value: str, name: str) -> DataFrame:
    """rows with name: the last value that isn't null up to each row in its group."""
    parts = with_carry(sorted_parts(rows, by, order), by, {"__v": F.max_by(value, F.when(F.col(value).isNotNull(), F.col("__at")))}, {"__c": F.last("__v", ignorenulls=True)})
    own = F.last(value, ignorenulls=True).over(inside(by).rowsBetween(Window.unboundedPreceding, 0))
    return parts.withColumn(name, F.coalesce(own, F.col("__c"))).drop("__c", "__part", "__at")
