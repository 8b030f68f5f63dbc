"""Operator 6, token counts: a cache of counts by content digest and tokenizer-version digest.

Documents are reduced to a digest of their normalised content (here null becomes the empty text: the tokenizer itself
normalises nothing). Digests found in the cache need no encoding; of the rest each distinct content is encoded once and
its count appended to the cache, a Parquet table (content, version, n_tokens).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, table_path
from .pretokens import pretoken_ids

CACHE = "content string, version string, n_tokens long"
#: Parts into which the rows of one content are dealt.
SALTS = 32


def tokenizer_version(path: str) -> str:
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def encode_counts(misses: DataFrame, path: str, version: str) -> DataFrame:
    """(content, version, n_tokens) of rows (content, text), each content once in a task."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        parts, done = pretoken_ids(path, lower=False), set()
        for batch in batches:
            new = []
            for i, content in enumerate(batch.column(0).to_pylist()):
                if content not in done:
                    done.add(content)
                    new.append(i)
            batch = batch.take(pa.array(new, pa.int64()))
            n = [len(parts.of(t or "")) // 4 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64())], names=["content", "version", "n_tokens"])

    return misses.mapInArrow(run, CACHE)


def read_cache(spark: SparkSession, cache: str | None) -> DataFrame:
    if cache:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
        if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
            return spark.read.schema(CACHE).parquet(cache)
    return spark.createDataFrame([], CACHE)


def count_tokens(docs: DataFrame, path: str, cache: str | None = None) -> DataFrame:
    """Per row of docs: doc_id, n_bytes (UTF-8), n_tokens, cached (whether the cache had it before).

    cache: a Parquet table in shared storage, appended to; None starts with an empty one in the shared folder. The table
    may hold a digest twice if two jobs append at once; counts are equal then, and one is taken. Null text: empty, no
    tokens. A row with a null doc_id is counted like others. Copies are encoded once. Empty tables give empty tables.
    """
    spark = docs.sparkSession
    version = tokenizer_version(path)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("content"), text.alias("text"))
    known = read_cache(spark, cache).where(F.col("version") == version)
    target = cache or table_path(spark, "token_cache")
    # A row's salt comes from its place, as doc_ids may be null or repeated; written, so that it stays what it is.
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).alias("salt")
    small = saved(rows.select("doc_id", "n_bytes", "content", salt), "digests")
    # One document stands for all of a content; what the cache knows drops out before any text moves.
    parts = small.groupBy("content", "salt").agg(F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("__doc"))
    parts = saved(parts, "contents")
    first = parts.groupBy("content").agg(F.min("__doc").alias("__doc"))
    first = first.join(known.select("content"), "content", "left_anti").withColumnRenamed("content", "__content").hint("shuffle_hash")
    # Rows alike in doc_id and content meet in one task, which encodes the first of them.
    misses = rows.join(first, (F.coalesce(rows["doc_id"], F.lit(-(2**63))) == first["__doc"]) & (rows["content"] == first["__content"])).select("content", "text")
    before = known.groupBy("content").agg(F.lit(True).alias("cached"))
    encode_counts(misses, path, version).dropDuplicates(["content"]).write.mode("append").parquet(target)
    after = spark.read.schema(CACHE).parquet(target).where(F.col("version") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    # Rows of one content are dealt over salts, so that a text of very many documents isn't one task.
    of_part = parts.select("content", "salt").join(after, "content")
    of_part = of_part.join(before, "content", "left") if cache else of_part.withColumn("cached", F.lit(None).cast("boolean"))
    out = small.join(of_part, ["content", "salt"])
    return out.select("doc_id", "n_bytes", "n_tokens", F.coalesce("cached", F.lit(False)).alias("cached"))
