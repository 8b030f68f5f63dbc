"""Operator 13 against plain counting, for phrases of up to 3 and 4 words; the groups of a task; unary paths."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tideline.llm import collocations as col

SCHEMA = "text string, lang string, word string, n string, w1 string, doc_id string"


def counts(rows, order):
    f = defaultdict(Counter)
    for text, lang, *_ in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, order + 1):
                f["und" if lang is None else lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return f


def plain(rows, order=3, least=10, share=50, top=2000):
    out = []
    for lang, f in counts(rows, order).items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        c = {p: v for p, v in f.items() if len(p) > 1 and v >= least}
        inside = defaultdict(int)
        for p, v in c.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], v)
        ranked = []
        for p, a in c.items():
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if 100 * inside[p] < share * a:
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(13)
    vocabulary = ["the", "of", "New", "YORK", "été", "straße", "a b", "\U0001f600", "x-y", "<|end|>", *(f"w{i}" for i in range(25))]
    passage = " ".join(rng.choice(vocabulary) + str(i) for i in range(50))
    rows = [(" ".join(rng.choice(vocabulary) + rng.choice(("", "", "", "", ",", ". ", "\n", "\t", "!?", "  ")) for _ in range(rng.randint(0, 200))), rng.choice(("en", "en", "en", None, "und", "", "de"))) for _ in range(250)]
    rows += [(f"start{i} {passage} stop{i}. the of new york", "en") for i in range(15)] + [("again and again " * 40, "en"), (None, None), ("", "en"), (" .,\t!\n", "xx"), ("alone", "yy")]
    rows += [("long " * 30_000 + "tail. end", "fr"), ("the of the of", "en"), ("same same same", "de")] + [("repeated row here", "de")] * 12
    return [(t, lang, "x", "x", "x", "x") for t, lang in rows]


def found(out):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in out.collect())


@pytest.fixture(scope="module")
def docs(spark, texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("phrases") / "documents.parquet")
    spark.createDataFrame(texts, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize(("order", "top"), [(3, 2000), (4, 7), (2, 2000)])
def test_against_plain_counting(docs, texts, order, top):
    want = plain(texts, order, top=top)
    assert len(want) > 10 and found(col.collocations(docs, order=order, top=top)) == want


def test_small_groups(texts, monkeypatch):
    """What a task adds up is the same whether a text, a slice or a few words make a group, and whatever words it remembers."""

    def rows_of(order):
        import pyarrow as pa

        got = {}

        class Frame:
            def select(self, *_):
                return self

            def mapInArrow(self, f, _):
                batch = pa.RecordBatch.from_arrays([pa.array([t or "" for t, *_ in some]), pa.array([lang or "und" for _, lang, *_ in some])], names=["text", "lang"])
                sums, words = Counter(), Counter()
                for b in f(iter([batch])):
                    for r in b.to_pylist():
                        key = tuple(r[f"w{i + 1}"] for i in range(order))
                        if r["word"] is None:
                            sums[key] += r["n"]
                        else:
                            words[r["lang"], r["word"], r["w1"]] += r["n"]
                got["x"] = sums, words

        col.rows(Frame(), order, 0)
        return got["x"]

    some = texts[:60] + texts[-8:]
    wide = rows_of(3)
    for name, value in (("GROUP", 7), ("VOCABULARY", 5), ("SLICE", 11)):
        monkeypatch.setattr(col, name, value)
    assert rows_of(3) == wide and sum(wide[1].values()) == sum(wide[0].values())


def test_words_that_share_a_hash(spark, docs, texts, monkeypatch):
    """Detected, and done again with other hashes."""
    seeds = []
    whole = col.rows

    def rows(d, order, seed):
        seeds.append(seed)
        out = whole(d, order, seed)
        if seed == 0:
            twice = out.where("word is not null").limit(1).selectExpr("w1", "w2", "w3", "n", "lang", "concat(word, 'x') as word")
            out = out.unionByName(twice)
        return out

    monkeypatch.setattr(col, "rows", rows)
    assert found(col.collocations(docs)) == plain(texts) and seeds == [0, 1]


def test_unary_paths(spark, docs, texts):
    f = counts(texts, 3)
    edges = {(lang, p): v for lang, c in f.items() for p, v in c.items() if len(p) == 3 and v >= 10}
    after = {}
    for (lang, p), v in edges.items():
        for (other, q), w in edges.items():
            if lang == other and p[1:] == q[:2] and v == w == f[lang][p[1:]]:
                after[lang, p] = lang, q
    heads = [e for e in edges if e not in after.values()]
    want = []
    for e in heads:
        at, words = e, list(e[1])
        while at in after:
            at = after[at]
            words.append(at[1][-1])
        want.append((e[0], " ".join(words), len(words), edges[e]))
    g = col.graph(docs)
    got = sorted((r.lang, r.phrase, r.n_words, r.a) for r in col.unary_paths(g).collect())
    assert got == sorted(want) and max(r[2] for r in got) >= 48
    nodes = {(r.w1, r.w2) for r in col.unary_nodes(g).collect()}
    assert len(nodes) == len(after)


def test_nothing(spark):
    for rows in ([], [(None, None)], [("one two", "en")]):
        docs = spark.createDataFrame(rows, "text string, lang string")
        assert col.collocations(docs).collect() == [] == col.unary_paths(col.graph(docs)).collect()
    assert np.concatenate([c for c in col.summed(np.empty(0, dtype=np.uint64), 3, 0)[0]]).size == 0
