"""Exact quantiles of whole tables by selection: histograms narrow the range that holds each rank; values are never gathered."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.storage import saved

#: Bins of a histogram; and values that are few enough to be looked at one by one.
BINS, FEW = 4096, 4096


@dataclass
class _Target:
    """The value at place `rank` (from 0) among those of `column` in low..high, of which there are `n`."""

    column: str
    rank: int
    low: float
    high: float
    n: int
    value: float | None = None


def _magnitude(x: Column) -> Column:
    """Whole numbers in the order of doubles, one for each sign and power of two: nothing narrows a long tail as fast."""
    size = F.floor(F.log2(F.abs(x))) + 2000
    return F.when(F.isnan(x), 9000).when(F.abs(x) == math.inf, F.signum(x) * 8000).when(x == 0, 0).otherwise(F.signum(x) * size).cast("long")


def _histogram(values: DataFrame, bins: list[tuple[int, Column, Column]]) -> dict[int, list[tuple[int, int, float, float]]]:
    """For each (number, column, bin or null) its bins in order: bin, count, least and largest value."""
    rows = F.filter(F.array(*[F.when(b.isNotNull(), F.struct(F.lit(i).alias("i"), b.cast("long").alias("b"), x.alias("x"))) for i, x, b in bins]), lambda r: r.isNotNull())
    got = values.select(F.explode(rows).alias("r")).groupBy("r.i", "r.b").agg(F.count("*").alias("n"), F.min("r.x").alias("a"), F.max("r.x").alias("z")).collect()
    out: dict[int, list] = {i: [] for i, *_ in bins}
    for r in got:
        out[r["i"]].append((r["b"], r["n"], r["a"], r["z"]))
    return {i: sorted(x) for i, x in out.items()}


def _narrowed(t: _Target, bins: list[tuple[int, int, float, float]]) -> None:
    for _, n, a, z in bins:
        if t.rank < n:
            t.n, t.low, t.high = n, a, z
            if a == z or (a != a and z != z):
                t.value = a
            return
        t.rank -= n


def _inside(t: _Target) -> Column:
    return F.col(t.column).between(t.low, t.high)


def exact_quantiles(df: DataFrame, wanted: dict[str, tuple[float, ...]]) -> dict[tuple[str, float], float | None]:
    """The quantiles of columns as `percentile` has them (linear between neighbouring ranks, nulls left out; None without values).

    The columns are written once, narrow. Each pass counts the values of the open ranges in BINS bins and keeps the bin that
    holds the rank; a range with few values is sorted. A billion values take three passes; the driver sees counts of bins.
    """
    names = {c: f"x{i}" for i, c in enumerate(wanted)}
    values = saved(df.select(*[(F.col(f"`{c}`").cast("double") + 0.0).alias(x) for c, x in names.items()]), "quantiles")
    first = _histogram(values, [(i, F.col(x), _magnitude(F.col(x))) for i, x in enumerate(names.values())])
    totals = {x: sum(n for _, n, *_ in first[i]) for i, x in enumerate(names.values())}
    targets: dict[tuple[str, int], _Target] = {}
    for i, (c, qs) in enumerate(wanted.items()):
        x = names[c]
        for q in qs if totals[x] else ():
            at = q * (totals[x] - 1)
            for rank in {math.floor(at), math.ceil(at)}:
                t = targets[x, rank] = _Target(x, rank, -math.inf, math.inf, totals[x])
                _narrowed(t, first[i])
    while todo := [t for t in targets.values() if t.value is None and t.n > FEW]:
        width = [(t, (t.high - t.low) / BINS) for t in todo]
        bins = []
        for i, (t, w) in enumerate(width):
            x = F.col(t.column)
            # A range too wide or too narrow for equal steps is halved.
            step = F.least(F.floor((x - t.low) / w), F.lit(BINS - 1)) if 0 < w < math.inf else F.when(x <= t.low / 2 + t.high / 2, 0).otherwise(1)
            if t.low / 2 + t.high / 2 in (t.low, t.high) and not 0 < w < math.inf:
                step = F.when(x == t.low, 0).otherwise(1)
            bins.append((i, x, F.when(_inside(t), step)))
        got = _histogram(values, bins)
        for i, t in enumerate(todo):
            _narrowed(t, got[i])
    if few := [t for t in targets.values() if t.value is None]:
        rows = F.filter(F.array(*[F.when(_inside(t), F.struct(F.lit(i).alias("i"), F.col(t.column).alias("x"))) for i, t in enumerate(few)]), lambda r: r.isNotNull())
        for r in values.select(F.explode(rows).alias("r")).groupBy("r.i").agg(F.sort_array(F.collect_list("r.x")).alias("xs")).collect():
            few[r["i"]].value = r["xs"][few[r["i"]].rank]
    out: dict[tuple[str, float], float | None] = {}
    for c, qs in wanted.items():
        for q in qs:
            x = names[c]
            at = q * (totals[x] - 1)
            low, high = (targets[x, f(at)].value for f in (math.floor, math.ceil)) if totals[x] else (None, None)
            out[c, q] = low if low == high or low is None else (math.ceil(at) - at) * low + (at - math.floor(at)) * high
    return out


def quantile_columns(found: dict[tuple[str, float], float | None], column: str, names: tuple[tuple[float, str], ...]) -> list[Column]:
    """The found quantiles of a column as literals under the given names."""
    return [F.lit(found[column, q]).cast("double").alias(n) for q, n in names]
