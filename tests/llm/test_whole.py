"""Cases in which operators once did less than the whole job."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame

from tideline.llm import lm_scoring, minhash_dedup, piece_sampling, substring_dedup
from tideline.llm.common import WordHashes
from tideline.llm.fm_index import Bits, FMIndex
from tideline.llm.queries import tokenizer_path


def test_every_occurrence_is_drawn(spark):
    path = tokenizer_path("piece_bpe_32k.model")
    docs = spark.createDataFrame([(i, " ".join(["international"] * 50)) for i in range(40)], "doc_id long, text string")
    model = piece_sampling.PieceModel(path)
    unit = model.segment("▁international", 0, 0)
    rng = random.Random(2)

    def drawn() -> list[int]:
        bits = list("▁international")
        agenda = [model.scores.get(a + b) for a, b in zip(bits, bits[1:])]
        while any(x is not None for x in agenda):
            i = max((x, -i) for i, x in enumerate(agenda) if x is not None)[1] * -1
            agenda[i] = None
            if rng.random() >= 0.1:
                bits[i : i + 2] = [bits[i] + bits[i + 1]]
                del agenda[i]
                for k in {i - 1, i} & {*range(len(agenda))}:
                    agenda[k] = model.scores.get(bits[k] + bits[k + 1])
        return [model.ids[b] for b in bits]

    share = sum(drawn() == unit for _ in range(4000)) / 4000
    seen, plain = set(), 0
    for r in piece_sampling.encode_texts(docs, path, seed=7, rate=0.1).collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        starts = [i for i, x in enumerate(ids) if model.bytes[x].startswith(b" ")]
        words = [tuple(ids[a:b]) for a, b in zip(starts, [*starts[1:], len(ids)])]
        assert r.lossless and len(words) == 50
        seen |= {*words}
        plain += words.count(tuple(unit))
    assert len(seen) > 50  # four variants gave four at most
    assert abs(plain / 2000 - share) < 0.05


def test_a_document_of_several_texts_links_them(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    c = " ".join(f"c{i}" for i in range(40))
    rows = [(5, a), (5, b), (3, a), (4, b), (6, c), (7, b), (8, c), (8, a)]
    out = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=4).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in out) == sorted((d, 3, d == 3) for d, _ in rows)


def test_rows_without_an_id_are_not_one_group(spark):
    shared = " ".join(f"s{i}" for i in range(60))
    texts = [" ".join(f"w{i}x{k}" for k in range(40)) + " " + shared for i in range(30)]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    scan = substring_dedup.scanned(docs, 35, 16, 200).collect()
    assert all(r.doc_id is None for r in scan)
    # Of the other texts' anchors only those that the text itself holds.
    words = {r.mark: substring_dedup.anchors(WordHashes().of(r.text.encode().split()), 35, 16)[0] for r in scan if r.text}
    assert len(words) == 30 and all({*r.anchors} <= {*words[r.mark].tolist()} for r in scan)
    assert all(len(r.anchors) == len({*r.anchors}) for r in scan)
    several = substring_dedup.scanned(docs.unionByName(docs), 35, 16, 200).collect()
    assert len(several) == 60 and all(len(r.anchors) == len({*r.anchors}) for r in several)
    assert [r.n_removed for r in substring_dedup.count_removed(docs).collect()] == [60] * 30


def test_ids_at_the_ends_of_their_range(spark):
    shared = " ".join(f"s{i}" for i in range(60))
    docs = spark.createDataFrame([(-(2**63), shared), (None, shared), (0, shared + " x"), (2**63 - 1, None)], "doc_id long, text string")
    out = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.count_removed(docs).collect()}
    assert out == {-(2**63): (60, 60), None: (60, 60), 0: (61, 60), 2**63 - 1: (0, 0)}


def test_repeats_are_found_by_the_search(spark, monkeypatch):
    """Without what backward search answers nothing is cut; the index alone tells how often another text's windows stand in it."""
    shared = " ".join(f"s{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"a{i} " + shared + f" b{i}") for i in range(5)], "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup.count_removed(docs).collect()] == [60] * 5
    rng = np.random.default_rng(3)
    text = rng.integers(1, 4, 400)
    text[::50] = 0
    index = FMIndex(text, np.ones(400, dtype=np.int64), 4, 6)
    other = rng.integers(1, 6, 300)  # with symbols that the index doesn't know
    found = index.matches(other, np.array([0, 150]), np.array([150, 300]))
    for i in range(300):
        window = other[i : i + 6].tolist()
        whole = len(window) == 6 and (i + 6 <= 150 or i >= 150)
        assert found[i] == (sum(text[k : k + 6].tolist() == window for k in range(395)) if whole else 0)
    table = pa.table({"d1": [1, 2], "d2": [1, 2], "n": [1, 1], "words": [b" ".join(b"w%d" % i for i in range(40)), b" ".join(b"w%d" % i for i in range(3, 43))]})
    assert substring_dedup.search_shard(table, 35)["runs"].to_pylist() == [[3, 6], [0, 3]]
    monkeypatch.setattr(FMIndex, "matches", lambda self, text, starts, ends: np.ones(len(text), dtype=np.int64))
    assert substring_dedup.search_shard(table, 35).num_rows == 0


def test_bits():
    rng = np.random.default_rng(1)
    for n in (1, 63, 64, 65, 1000):
        raw = (rng.random(n) < 0.3).astype(np.uint8)
        raw[-1] = 1
        bits, ones = Bits(raw), np.flatnonzero(raw)
        assert bits.rank(np.arange(n)).tolist() == (np.cumsum(raw) - raw).tolist()
        assert bits.select(np.arange(len(ones))).tolist() == ones.tolist()


def test_scores_spread_rows_without_an_id(spark, monkeypatch):
    texts = [f"text number {i} of many" for i in range(200)]
    blocks: list[DataFrame] = []
    frame = type(spark.range(0))
    whole = frame.groupBy
    monkeypatch.setattr(frame, "groupBy", lambda self, *cols: blocks.append(self) or whole(self, *cols))
    monkeypatch.setattr(lm_scoring, "MIN_BLOCKS", 8)
    out = lm_scoring.score_documents(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string"), depth=3)
    assert next(x for x in blocks if "block" in x.columns).select("block").distinct().count() == 8
    assert out.count() == 200


def test_repeats_keep_their_first_place(spark):
    rng = random.Random(5)
    pool = [" ".join(rng.choice("abcdefghijklmnop") + str(rng.randint(0, 9)) for _ in range(rng.randint(20, 90))) for _ in range(12)]
    texts = {i - 3: " ".join(rng.choice(pool) for _ in range(rng.randint(1, 8))) for i in range(40)}
    texts |= {100: None, 101: "", 102: "x y " * 400, 103: "x y " * 300 + pool[0]}
    words, first = {d: (t or "").split() for d, t in texts.items()}, {}
    for d in sorted(words):
        for i in range(len(words[d]) - 34):
            first.setdefault(tuple(words[d][i : i + 35]), (d, i))
    expected = {}
    for d, w in words.items():
        gone = {j for i in range(len(w) - 34) if first[tuple(w[i : i + 35])] < (d, i) for j in range(i, i + 35)}
        expected[d] = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else texts[d]
    assert sum(expected[d] != t for d, t in texts.items()) > 30
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    for split in (200, 2):
        assert {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs, split=split, keep_first=True).collect()} == expected
    assert substring_dedup.remove_repeats(docs.where("doc_id > 200"), keep_first=True).count() == 0


def test_many_rows_alike_are_one_document(spark):
    """Rows alike in doc_id and text, null doc_ids included: the work doesn't grow with the square of their number."""
    long, other, n = " ".join(f"w{i}" for i in range(200)), " ".join(f"v{i}" for i in range(100)), 2000
    rows = [(1, long)] * n + [(None, other)] * n + [(2, "short text")] * n + [(3, long + " z"), (None, " ".join(f"u{i}" for i in range(50)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = Counter((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.count_removed(docs).collect())
    assert out == {(1, 200, 200): n, (None, 100, 100): n, (2, 2, 0): n, (3, 201, 200): 1, (None, 50, 0): 1}
    cuts = substring_dedup.reports(substring_dedup.scanned(docs, 35, 16, 200), 35, 16).collect()
    assert sorted(len(r.cuts) for r in cuts) == [66, 166, 166]  # one for each window of a frequent anchor, however many rows
    kept = Counter((r.doc_id, r.text) for r in substring_dedup.remove_repeats(docs).collect())
    assert kept == {(1, ""): n, (None, ""): n, (2, "short text"): n, (3, "z"): 1, (None, rows[-1][1]): 1}
