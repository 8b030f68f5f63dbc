"""The corpus pipeline: documents through quality rules, line dedup, near-duplicate and substring dedup to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes what a stage returns to the shared folder and
reads it again as the next one's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.llm.common import saved, sealed
from tideline.llm.line_dedup import dedup_lines
from tideline.llm.minhash_dedup import keep_first
from tideline.llm.packing import pack_documents
from tideline.llm.quality_rules import keep_clean
from tideline.llm.queries import tokenizer_path
from tideline.llm.substring_dedup import remove_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; of the others the failing lines."""
    return keep_clean(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 10 code points or more stay in the smallest document that holds them."""
    inner, opened = sealed(docs, new_text=True)
    return opened(dedup_lines(inner, min_chars=10))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with similarity 0.8 or more, on shingles of five words, stays."""
    return keep_first(docs, k=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows of 35 that stand elsewhere too go."""
    return remove_repeats(docs, depth=35)


def bin_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 2048 tokens at most, each with its sequence and offset."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), length=2048, end_id=0).drop("ids")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("minhash_dedup", minhash_dedup), ("substring_dedup", substring_dedup), ("bin_packing", bin_packing)]

#: Substring dedup on the kept words and packing can't be expressed in SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
