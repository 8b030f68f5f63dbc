"""Operator 4, sharding: a Feistel permutation with cycle walking over global row numbers.

Rows are numbered 0..n-1 in the order of doc_id. A keyed Feistel network permutes the numbers of the smallest domain of
an even number of bits that holds n; numbers that leave 0..n-1 walk on until they are back inside. The permuted number
p gives shard p % shards and slot p // shards: the law is `rows`, the counts of shards differ by one at most, and where a
row lies can be computed from its number, n and the seed alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, sealed, without

ROUNDS = 6


def feistel(numbers: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A permutation of 0..n-1, applied to numbers in that range."""
    from .common import U64, mix64

    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask, shift = U64((1 << half) - 1), U64(half)
    keys = mix64(U64(seed % 2**64) + np.arange(1, ROUNDS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
    out = numbers.astype(U64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> shift, x & mask
        for key in keys:
            left, right = right, left ^ (mix64(right ^ key) & mask)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= U64(n)]
    return out.astype(np.int64)


def number_rows(rows: DataFrame, by: list[str], name: str = "row_number") -> DataFrame:
    """rows with their place in the order of the columns `by`, nulls first, from 0; rows alike in these are ordered anyhow.

    A range sort, a count of each range, and a broadcast of those counts: one small row per partition. The sorted
    rows are written before they are counted, so the numbers hold even if a task runs again.
    """
    order = [F.col(c).asc_nulls_first() for c in by]
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = saved(placed.withColumn("__at", F.monotonically_increasing_id()), "numbered").withColumn("__part", F.shiftright("__at", 33))
    counts = sorted((r["__part"], r["n"]) for r in placed.groupBy("__part").agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for part, count in counts:
        starts.append((part, total))
        total += count
    first = rows.sparkSession.createDataFrame(starts, "__part long, __first long")
    out = placed.join(F.broadcast(first), "__part").withColumn(name, F.col("__first") + F.col("__at").bitwiseAND((1 << 33) - 1))
    return out.withColumn("n_rows", F.lit(total).cast("long")).drop("__part", "__at", "__first")


def assign_shards(docs: DataFrame, shards: int = 16, seed: int = 20240229) -> DataFrame:
    """Per row of docs: doc_id, size, text_crc32, row_number, shard, slot, n_rows.

    size: UTF-8 bytes of the text plus 1 (null text: 1, and its CRC is that of the empty text). Equal rows are ordered
    anyhow among themselves, which changes no result. Null doc_ids come first. An empty table gives an empty table;
    other columns of docs play no part.
    """
    return _placed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_digest()), shards, seed)


def _digest() -> list[Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [(F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")]


def _placed(rows: DataFrame, shards: int, seed: int) -> DataFrame:
    """rows (doc_id, size, text_crc32, ...) with row_number, n_rows, shard and slot."""
    numbered = number_rows(rows, ["doc_id", "size", "text_crc32"])

    @F.pandas_udf("long")
    def permuted(number: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series(feistel(number.to_numpy(), int(n.iloc[0]), seed) if len(number) else number)

    out = numbered.withColumn("__p", permuted("row_number", "n_rows"))
    return out.withColumn("shard", F.expr(f"cast(__p % {shards} as int)")).withColumn("slot", F.expr(f"__p div {shards}")).drop("__p")


def shuffled_shards(docs: DataFrame, shards: int = 16, seed: int = 20240229) -> DataFrame:
    """docs themselves with shard and slot, for writing: each row once, also where doc_ids are null or repeated.

    Columns shard and slot of docs are replaced, others kept whatever their names.
    """
    inner, opened = sealed(without(docs, "shard", "slot"))
    return opened(_placed(inner.select("*", *_digest()), shards, seed), "shard", "slot")
