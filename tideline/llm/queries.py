"""The queries of the training-data operators: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where the public tokenizers' files are found: name -> path.
TOKENIZERS: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    if name in TOKENIZERS:
        return TOKENIZERS[name]
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import apply_rules

    return apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "clean_text")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embedding_dedup import link_vectors

    return link_vectors(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import count_removed

    return count_removed(table(spark, sf_dir, "documents"), depth=35)


def op4_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import assign_shards

    out = assign_shards(table(spark, sf_dir, "documents"), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens

    out = count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op7_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_scoring import score_documents

    return score_documents(table(spark, sf_dir, "documents"), depth=5)


def op8_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), length=2048, end_id=0).drop("ids")


def op9_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .piece_sampling import encode_texts

    out = encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path("piece_bpe_32k.model"), seed=7, rate=0.1)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    return out.select("doc_id", n_bytes, (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), "lossless")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import plan_mix, taken_words

    return taken_words(plan_mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), percent=150, repeat=2))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import ordered_turns, prefix_trie, share_openings

    return prefix_trie(*share_openings(ordered_turns(table(spark, sf_dir, "conversations")), every=100, most=6))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .collocations import collocations

    return collocations(table(spark, sf_dir, "documents"), order=3, min_count=10, share=50, top=2000)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_rules, op2_embedding_dedup, op3_substring_dedup, op4_feistel_shards, op5_minhash_dedup, op6_token_counts, op7_context_tree_scores, op8_bin_packing, op9_piece_sampling, op10_line_dedup, op11_source_mix, op12_prefix_trie, op13_collocations)}
