"""Columns of the user under names that operators use themselves; and the shared folder."""

from collections import Counter

import pytest

import corpus_pipeline
from tideline.llm import common, line_dedup, minhash_dedup, quality_rules, sharding, substring_dedup

NAMES = ("cuts", "n_removed", "__cuts", "__doc", "__id", "mark", "kept", "clean_text", "n_words", "n_lines", "__lost", "shard", "slot", "size", "a.b", "back`tick", "N_CHARS")


@pytest.fixture(scope="module")
def odd(spark, rows):
    table = [(d, t, *[f"{i}-{n}" if n != "N_CHARS" else len(t or "") for n in NAMES]) for i, (d, t, *_) in enumerate(rows)]
    fields = ["doc_id long", "text string", *[f"`{n.replace('`', '``')}` {'int' if n == 'N_CHARS' else 'string'}" for n in NAMES]]
    return spark.createDataFrame(table, ", ".join(fields))


def others(rows):
    return Counter((r["doc_id"], r["cuts"], r["a.b"], r["back`tick"], r["kept"], r["__cuts"]) for r in rows)


@pytest.mark.parametrize("f", [quality_rules.keep_clean, minhash_dedup.keep_first, substring_dedup.remove_repeats, lambda d: corpus_pipeline.line_dedup(d.sparkSession, d, "")])
def test_stages_keep_odd_columns(odd, f):
    before = others(odd.collect())
    out = f(odd)
    assert out.columns == odd.columns and out.dtypes == odd.dtypes
    rows = out.collect()
    assert rows and not others(rows) - before
    assert all((r["N_CHARS"] or 0) == len(r["text"] or "") for r in rows)


def test_added_columns_replace_their_namesakes_only(odd):
    out = line_dedup.dedup_lines(odd)
    assert out.columns == [c for c in odd.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    assert others(out.collect()) == others(odd.collect())


def test_written_shards_hold_every_row(odd):
    out = sharding.shuffled_shards(odd, shards=4)
    assert out.columns == [c for c in odd.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    rows = out.collect()
    assert others(rows) == others(odd.collect())
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows)


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        applicationId = "x"
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_folder(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        common.shared_folder(Session())
