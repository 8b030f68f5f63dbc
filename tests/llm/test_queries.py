"""The registered queries on the smallest tables: against their SQL, or their contract's columns where there is none."""

import os

import duckdb
import pytest

from tideline.llm.oracles import oracle_sql
from tideline.llm.queries import queries

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    "op4_feistel_shards": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op6_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op7_context_tree_scores": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op8_bin_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op11_source_mix": {"doc_id", "size", "source_size", "target", "taken"},
    "op9_piece_sampling": {"doc_id", "n_pieces", "ids_crc32", "lossless"},
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.sql(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    out = queries()[name](spark, DATA).toPandas()
    if name not in oracle_sql():
        assert COLUMNS[name] <= set(out.columns) and len(out) >= 200
        return
    want = duck.sql(oracle_sql()[name]).df()
    want = want.astype({c: out[c].dtype for c in want if str(want[c].dtype) == "Int64" and c in out})  # whole numbers with nulls
    assert sorted(out.columns) == sorted(want.columns)
    show = lambda df: sorted(map(tuple, df[sorted(df.columns)].astype(str).values))
    assert show(out) == show(want)
