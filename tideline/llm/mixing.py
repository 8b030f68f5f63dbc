"""Operator 11, mixing sources to target weights.

The words of each source, its documents one after the other, are packed into blocks of a fixed length (the last one is
shorter). A source's target says how many words the mix takes of it, and so how many blocks. The mix is written in shards
of a fixed number of slots. How many slots of a shard each source gets is a multinomial draw, given what the mix takes of
each source in all, so that totals meet the targets instead of scattering about them: the range of shards is halved again
and again, and the left half's counts are drawn (a hypergeometric draw, source by source) with a seed of that range. Any
task can draw any shard's counts alone, and learns with them how many blocks of a source the shards before it take. That
number, and a keyed permutation of the source's block numbers for each pass over it, say which block fills a slot; blocks
and documents meet in a join by source and block number.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import U64, mix64, saved
from .sharding import ROUNDS, number_rows

WORD = r"[^\x20\x09-\x0D]+"
#: Sources whose counts are drawn together, and shards drawn by one row.
GROUP, CHUNK = 1024, 16
STEPS = mix64(np.arange(1, ROUNDS + 1, dtype=U64))
DRAWS = "shard long, slot long, rank long, block long, epoch long, words long"


class Mix(NamedTuple):
    """documents: one row per row of docs (rank of its source, first word in it); sources; draws: one row per filled slot."""

    documents: DataFrame
    sources: DataFrame
    draws: DataFrame
    block: int


def _keys(seed: int, ranks: np.ndarray, epochs: np.ndarray) -> np.ndarray:
    return mix64(mix64(ranks.astype(U64) + U64(seed % 2**64)) + epochs.astype(U64) * U64(0x9E3779B97F4A7C15))


def permuted(numbers: np.ndarray, sizes: np.ndarray, keys: np.ndarray, back: bool = False) -> np.ndarray:
    """Each number (below its size) under the permutation of its size and key: a Feistel network that walks on while it is
    outside. back: the inverse."""
    half = np.maximum(1, (np.frexp(np.maximum(sizes - 1, 0).astype(np.float64))[1] + 1) // 2).astype(U64)
    mask = (U64(1) << half) - U64(1)
    out, todo = numbers.astype(U64), np.arange(len(numbers))
    while len(todo):
        x, h, m, key = out[todo], half[todo], mask[todo], keys[todo]
        left, right = x >> h, x & m
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            step = mix64(key + STEPS[i])
            if back:
                left, right = right ^ (mix64(left ^ step) & m), left
            else:
                left, right = right, left ^ (mix64(right ^ step) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= sizes[todo].astype(U64)]
    return out.astype(np.int64)


def drawn(counts: np.ndarray, sample: int, rng: np.random.Generator) -> np.ndarray:
    """How many of each kind a sample without replacement holds. Where more than 10^9 things are left to sample from, single
    draws are binomial (kinds below a thousand) or normal, within the bounds that keep the sample whole."""
    out, rest = np.zeros(len(counts), dtype=np.int64), int(counts.sum())
    for i, n in enumerate(counts.tolist()):
        other = rest - n
        low, high = max(0, sample - other), min(n, sample)
        if low >= high:
            x = low
        elif rest < 10**9:
            x = int(rng.hypergeometric(n, other, sample))
        elif n < 1000:
            x = int(rng.binomial(n, sample / rest))
        else:
            p = sample / rest
            x = round(n * p + rng.standard_normal() * (n * p * (1 - p) * (other / rest)) ** 0.5)
        out[i] = x = min(max(x, low), high)
        sample, rest = sample - x, other
    return out


def shard_counts(groups: np.ndarray, members: np.ndarray, g: int, first: int, last: int, slots: int, seed: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each shard in first..last-1: its number, the slots that groups before g fill, and for each member of group g how
    many slots it fills and how many it fills in the shards before.

    groups: the blocks that each group of sources gives to the whole mix; members: those of the sources of group g.
    """
    total = int(groups.sum())

    def split(low: int, high: int, every: np.ndarray, own: np.ndarray, before: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        if high <= first or low >= last:
            return
        if high - low == 1:
            yield low, int(every[:g].sum()), own, before
            return
        middle = (low + high) // 2
        size = min(middle * slots, total) - low * slots
        left = drawn(every, size, np.random.default_rng([seed, low, high]))
        mine = drawn(own, int(left[g]), np.random.default_rng([seed, low, high, g]))
        yield from split(low, middle, left, mine, before)
        yield from split(middle, high, every - left, own - mine, before + mine)

    yield from split(0, -(-total // slots), groups, members, np.zeros(len(members), dtype=np.int64))


def _planned(sources: DataFrame, block: int, seed: int) -> DataFrame:
    """sources with blocks, n_draws and cut: the words that the last draw takes of its block (0: all)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rank, size, target = (batch.column(i).to_numpy() for i in range(3))
            words, blocks = np.floor(target + 0.5).astype(np.int64), -(-size // block)
            passes, rest = np.divmod(words, np.maximum(size, 1))
            # The pass that ends early meets the source's last block, which is shorter, at this place.
            at = permuted(np.maximum(blocks - 1, 0), blocks, _keys(seed, rank, passes), back=True) if len(rank) else rank
            short = size - (blocks - 1) * block
            later = np.maximum(rest - at * block - short, 0)
            full = np.where(rest <= at * block, -(-rest // block), at + 1 + -(-later // block))
            over = np.where(rest <= at * block, full * block, at * block + short + -(-later // block) * block) - rest
            length = np.where((rest > at * block) & (later == 0), short, block)
            draws, cut = passes * blocks + full, np.where(over > 0, length - over, 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blocks), pa.array(draws), pa.array(cut)], names=["rank", "blocks", "n_draws", "cut"])

    plan = sources.select("rank", "size", "target").where("size > 0").mapInArrow(run, "rank long, blocks long, n_draws long, cut long")
    return sources.join(plan, "rank", "left").na.fill(0, ["blocks", "n_draws", "cut"])


def _level(sources: DataFrame, total: Fraction) -> float:
    """The share of one unit of weight at which min(share * weight, cap) sums to total: whatever stops at its cap leaves the
    rest to the others, until none is above."""
    capped, share = 0, Fraction(0)
    while True:
        low = F.col("cap") <= F.lit(float(share)) * F.col("weight")
        got = sources.agg(
            F.sum(F.when(low, F.col("cap").cast("decimal(38,0)"))).alias("held"), F.sum(F.when(~low, F.col("weight").cast("decimal(38,0)"))).alias("open"), F.count(F.when(low, 1)).alias("n"),
        ).first()
        if not got["open"] or (share and got["n"] <= capped):
            return float(share)
        capped = got["n"]
        fresh = (total - int(got["held"] or 0)) / int(got["open"])
        if fresh <= share:
            return float(share)
        share = fresh


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), percent: int = 150, repeat: int = 2, block: int = 128, shard_blocks: int = 1024, seed: int = 20240229, keep_text: bool = False) -> Mix:
    """The mix of docs (doc_id, text, source) that takes percent % of all words.

    Sources in the order of code points, null last (a source of its own), have the given weights in turn; a source gives
    its words `repeat` times at most. Sources without words give none; empty and null texts have no words, and null and
    repeated doc_ids are documents like others. An empty table gives an empty mix. Other columns of docs play no part.

    documents: doc_id, source, size, rank, first (the source's words before it), source_size, target, at (a number of the
    row), with keep_text the text. sources: source, rank, weight, size, cap, target, blocks, n_draws, cut. draws: shard,
    slot (in the shard, gapless), rank, block, epoch (the pass over the source), words (taken of the block, from its start).
    """
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text, source = F.col("text").cast("string"), F.col("source").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64(text).alias("digest"),
        F.monotonically_increasing_id().alias("row"), *([text.alias("text")] if keep_text else []),
    )
    rows = saved(rows, "mix-sizes")  # sampling the ranges would count the words again
    order = [F.col("source").asc_nulls_last(), F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("row")]
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("digest", "row")
    placed = saved(placed.withColumn("at", F.monotonically_increasing_id()), "mix-documents").withColumn("part", F.shiftright("at", 33))
    by_part = saved(placed.groupBy("source", "part").agg(F.sum("size").alias("words")), "mix-parts")
    sources = number_rows(by_part.groupBy("source").agg(F.sum("words").alias("size")).withColumn("last", F.isnull("source")), ["last", "source"], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    sources = saved(sources.select("source", "rank", weight.alias("weight"), "size", (F.col("size") * repeat).alias("cap")), "mix-sources")
    every = sources.agg(F.sum(F.col("size").cast("decimal(38,0)")).alias("n")).first()["n"] or 0
    level = _level(sources.where("size > 0"), min(Fraction(int(every) * percent, 100), Fraction(int(every) * repeat)))
    sources = sources.withColumn("target", F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight")))
    sources = saved(_planned(sources, block, seed), "mix-plan")

    carried = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = by_part.withColumn("carry", F.coalesce(F.sum("words").over(carried), F.lit(0))).alias("c")
    known = carry.join(sources.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).select("c.part", "c.carry", "s.rank", F.col("s.source").alias("name"), F.col("s.size").alias("source_size"), "s.target")
    inside = Window.partitionBy("part", "source").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    documents = placed.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("d").join(known.alias("k"), (F.col("d.part") == F.col("k.part")) & F.col("d.source").eqNullSafe(F.col("k.name")))
    documents = documents.select("d.doc_id", "d.source", "d.size", "k.rank", (F.col("inner") + F.col("carry")).alias("first"), "k.source_size", "k.target", "d.at", *(["d.text"] if keep_text else []))
    return Mix(documents, sources, _draws(sources, block, shard_blocks, seed), block)


def _draws(sources: DataFrame, block: int, slots: int, seed: int) -> DataFrame:
    spark = sources.sparkSession
    grouped = sources.where("n_draws > 0").groupBy(F.expr(f"rank div {GROUP}").alias("g"))
    # One number for each GROUP sources comes to the driver.
    totals = sorted((r["g"], r["n"]) for r in grouped.agg(F.sum("n_draws").alias("n")).collect())
    groups, place = np.array([n for _, n in totals], dtype=np.int64), {g: i for i, (g, _) in enumerate(totals)}
    chunks = -(-int(groups.sum()) // (slots * CHUNK))
    if not chunks:
        return spark.createDataFrame([], DRAWS)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                rank, n, blocks, size, cut = (np.array([m[c] for m in row["members"]], dtype=np.int64) for c in ("rank", "n_draws", "blocks", "size", "cut"))
                first = row["chunk"] * CHUNK
                for shard, before, counts, given in shard_counts(groups, n, place[row["g"]], first, min(first + CHUNK, -(-int(groups.sum()) // slots)), slots, seed):
                    s = np.repeat(np.arange(len(n)), counts)
                    draw = given[s] + np.arange(len(s)) - np.repeat(np.cumsum(counts) - counts, counts)
                    epoch, number = np.divmod(draw, blocks[s])
                    b = permuted(number, blocks[s], _keys(seed, rank[s], epoch))
                    words = np.minimum(block, size[s] - b * block)
                    words = np.where((draw == n[s] - 1) & (cut[s] > 0), cut[s], words)
                    filled = min(slots, int(groups.sum()) - shard * slots)
                    key = np.full(len(s), mix64(np.array([seed + 1], dtype=U64) + U64(shard))[0], dtype=U64)
                    slot = permuted(before + np.arange(len(s)), np.full(len(s), filled), key)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(s), shard), slot, rank[s], b, epoch, words)], names=["shard", "slot", "rank", "block", "epoch", "words"])

    members = grouped.agg(F.sort_array(F.collect_list(F.struct("rank", "n_draws", "blocks", "size", "cut"))).alias("members"))
    work = members.select("g", "members", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    work = work.repartition(min(chunks, max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))), "chunk")  # a number, so that AQE leaves these few rows apart
    return saved(work.mapInArrow(run, DRAWS), "mix-draws")


def _overlaps(documents: DataFrame, block: int) -> DataFrame:
    """documents (rank, first, size, ...) with one row for each block that a document has words in."""
    ends = F.expr(f"sequence(first div {block}, (first + size - 1) div {block})")
    return documents.where("size > 0").withColumn("block", F.explode(ends))


def taken_words(mix: Mix) -> DataFrame:
    """Per row of docs: doc_id, size, source_size, target (of its source), taken (words the mix takes, repeats counted)."""
    per_block = mix.draws.groupBy("rank", "block").agg(F.count("*").alias("n"), F.sum("words").alias("words"), F.max("words").alias("most"))
    keys = ["at", "doc_id", "size", "source_size", "target"]
    met = _overlaps(mix.documents.select(*keys, "rank", "first"), mix.block).join(per_block, ["rank", "block"])
    # The draws of a block take all of it, but for at most one, which takes a part from its start; that one may be the only one.
    low = F.greatest(F.col("first") - F.col("block") * mix.block, F.lit(0))
    high = F.least(F.col("first") + F.col("size") - F.col("block") * mix.block, F.lit(mix.block))
    whole, part = F.col("n") - F.when(F.col("words") < F.col("n") * F.col("most"), 1).otherwise(0), F.col("words") % F.col("most")
    part = F.when(F.col("words") < F.col("n") * F.col("most"), part).otherwise(0)
    of = lambda end: F.greatest(F.least(high, end) - low, F.lit(0))
    got = met.select(*keys, (whole * of(F.col("most")) + of(part)).alias("taken"))
    none = mix.documents.select(*keys, F.lit(0).cast("long").alias("taken"))
    return got.unionByName(none).groupBy(*keys).agg(F.sum("taken").cast("long").alias("taken")).drop("at")


def mixed_text(mix: Mix) -> DataFrame:
    """The mix itself, one row per slot: shard, slot, source, words, spans (doc_id, start word, words), text (words joined by
    one space). Needs plan_mix(keep_text=True). A row holds one block at most."""
    found = F.regexp_extract_all("text", F.lit(WORD), 0)
    low = f"greatest(b * {mix.block} - first, 0)"
    piece = f"struct(b as block, {low} as start, slice(found, cast({low} + 1 as int), cast(least((b + 1) * {mix.block} - first, size) - {low} as int)) as words)"
    cut = F.expr(f"transform(sequence(first div {mix.block}, (first + size - 1) div {mix.block}), b -> {piece})")
    pieces = mix.documents.where("size > 0").withColumn("found", found).select("doc_id", "source", "rank", "first", F.explode(cut).alias("p"))
    pieces = pieces.select("doc_id", "source", "rank", "p.block", "p.start", F.col("p.words").alias("held"), (F.col("first") + F.col("p.start") - F.col("p.block") * mix.block).alias("place"))
    met = mix.draws.join(pieces, ["rank", "block"]).where("place < words")
    rows = F.transform(
        F.sort_array(F.collect_list(F.struct("place", "doc_id", "start", F.expr("slice(held, 1, cast(words - place as int))").alias("held")))),
        lambda x: F.struct(x.doc_id.alias("doc_id"), x.start.alias("start"), F.size(x.held).alias("words"), x.held.alias("held")),
    )
    out = met.groupBy("shard", "slot", "rank", "block", "words").agg(F.first("source").alias("source"), rows.alias("rows"))
    spans = F.transform("rows", lambda x: F.struct(x.doc_id.alias("doc_id"), x.start.alias("start"), x.words.alias("words")))
    return out.select("shard", "slot", "source", "words", spans.alias("spans"), F.array_join(F.flatten(F.col("rows.held")), " ").alias("text"))
