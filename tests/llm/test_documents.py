"""The operators on documents against brute force, on a table with nulls, copies, long texts and clashing columns."""

import functools
import hashlib
import math
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from tideline.llm import line_dedup, lm_scoring, minhash_dedup, packing, piece_sampling, quality_rules, sharding, substring_dedup, token_counts
from tideline.llm.queries import tokenizer_path

from . import plain
from .conftest import words


def split(text):
    return (text or "").encode().split()


def by_id(rows):
    return [(r[0], r[1]) for r in rows]


def test_quality_rules(docs, rows, empty):
    out = quality_rules.apply_rules(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        w = split(r.text)
        seen = Counter(zip(w, w[1:], w[2:]))
        repeated = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in (r.text or "").split("\n") if split(x)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(len(x.decode()) for x in w), sum((r.text or "").count(c) for c in "#*$%&|<>"))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(repeated))
        assert r.base_failed == (len(w) < 50 or 2 * len(repeated) > len(w))
        bad = [x for x in lines if plain.line_fails(x)]
        assert (r.n_bad_lines, r.n_lost_words) == (len(bad), sum(len(split(x)) for x in bad))
        assert r.kept == (not r.base_failed and 2 * r.n_lost_words <= len(w))
        assert r.clean_text == (None if r.text is None else "\n".join(x for x in r.text.split("\n") if x not in bad))
    kept = {r.doc_id for r in out if r.kept}
    assert set(range(30)) <= kept and not kept & {48, 50, 51, 52, 53, 54, 55}
    assert quality_rules.keep_clean(docs).columns == docs.columns
    assert quality_rules.apply_rules(empty).count() == 0


LINES = {
    "=====": True, "-----": True, "!!!! ???": True, "....": True, "* * *": True, "a.": False, "- a point": False, "1. First of all": False, "x = (a + b) * c": False, "{{}} [[]] ok": True,
    "About": True, "home news": True, "About.": False, "about\u00a0home": False, "\u00a0": False, "home | about | contact": False, "a | b | c | d": True, "HOME \u00bb NEWS \u00bb TOP \u00bb x": True,
    "Read more": True, "Subscribe to our newsletter today": True, "\u00a9 2020 Someone. All rights reserved.": True, "PRIVACY POLICY | TERMS OF USE": True, "Une phrase en fran\u00e7ais.": False,
    "The new privacy policy was debated for weeks, and in the end most of the members voted for it.": False, "He had to enable javascript and then accept all cookies before he could read anything there.": True,
}


@pytest.mark.parametrize("line", LINES)
def test_line_rules(line):
    assert plain.line_fails(line) == LINES[line]
    assert quality_rules.line_fails(line.encode(), len(split(line)), quality_rules.LineRules()) == LINES[line]


def test_a_clean_text_of_one_line_may_mention_a_policy(spark):
    text = "The ministers met again on Tuesday to discuss what the privacy policy of a large shop means for its customers. " + " ".join(f"Speaker{i} told{i} of{i} cost{i}." for i in range(20))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [r.text for r in quality_rules.keep_clean(docs).collect()] == [text]


def test_line_dedup(docs, rows, empty):
    holders = defaultdict(set)
    for doc, text in by_id(rows):
        for line in (text or "").encode().split(b"\n"):
            if doc is not None and len(line.strip().lower().decode()) >= 10:
                holders[line.strip().lower()].add(doc)
    expected = Counter()
    for doc, text in by_id(rows):
        lines = (text or "").encode().split(b"\n")
        kept = [x for x in lines if doc is None or len(holders[x.strip().lower()]) < 2 or min(holders[x.strip().lower()]) == doc]
        expected[doc, len(lines), len(lines) - len(kept), b"\n".join(kept).decode()] += 1
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_dedup.dedup_lines(docs).collect()) == expected
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_state_is_reversible(docs, spark):
    half = line_dedup.build_state(docs.where("doc_id < 40"))
    whole = line_dedup.insert(half, docs.where("doc_id >= 40"))
    back = line_dedup.delete(whole, docs.where("doc_id >= 40"))

    def content(state):
        return {(r.doc_id, frozenset(zip(r["__lost"][::2], r["__lost"][1::2]))) for r in line_dedup.dropped_keys(state).collect()}

    assert content(whole) == content(line_dedup.build_state(docs))
    assert content(back) == content(half)
    assert content(whole) != content(half)


def test_line_counts_follow_inserts_and_deletes(docs, rows, spark):
    """The counts of all keys equal those of a state built anew; repeated rows of a doc_id are one document; an insert writes rows
    for its own keys only; what is deleted can come back, and logs can be put together."""

    def counts(state):
        return {(r.h1, r.h2): (r.n_docs, r.owner) for r in state.live_counts().collect()}

    twice = spark.createDataFrame([(1, "one line here\nanother line"), (1, "one line here"), (2, "one line here"), (3, "a third line")], "doc_id long, text string")
    assert sorted(counts(line_dedup.build_state(twice)).values()) == [(1, 1), (1, 3), (2, 1)]
    parts = [docs.where(f"doc_id % 3 = {i}") for i in range(3)]
    state = line_dedup.build_state(parts[0])
    for part in parts[1:]:
        before = state.counts.count()
        state = line_dedup.insert(state, part)
        own = line_dedup.line_keys(part).select("h1", "h2").distinct().count()
        assert 0 < state.counts.count() - before <= own
    whole = counts(line_dedup.build_state(docs.where("doc_id is not null")))
    assert counts(state) == whole
    assert counts(line_dedup.insert(state, parts[1])) == whole
    less = line_dedup.delete(state, parts[0].where("doc_id < 45"))
    assert counts(less) == counts(line_dedup.build_state(docs.where("doc_id is not null and not (doc_id % 3 = 0 and doc_id < 45)")))
    back = line_dedup.insert(less, parts[0])
    assert counts(back) == whole and counts(line_dedup.compacted(back)) == whole
    shared = [k for k, (n, _) in whole.items() if n > 1]
    filters = {r["shard"]: line_dedup.CuckooFilter.read(r["n_buckets"], r["slots"]) for r in back.filters.collect()}
    for h1, h2 in shared:
        assert filters[h1 % back.n_shards].has(np.array([h1]), np.array([h2])).all()


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(2**63), 2**63 - 1, (4000, 2), dtype=np.int64)
    f = line_dedup.CuckooFilter.of(keys[:2000, 0], keys[:2000, 1])
    assert f.has(keys[:2000, 0], keys[:2000, 1]).all() and f.has(keys[2000:, 0], keys[2000:, 1]).mean() < 0.01
    for a, b in keys[:1000].tolist():
        assert f.delete(a, b)
    assert f.has(keys[1000:2000, 0], keys[1000:2000, 1]).all() and f.has(keys[:1000, 0], keys[:1000, 1]).mean() < 0.01


def test_minhash_dedup(docs, rows, empty):
    def shingles(text, k):
        w = (text or "").encode().lower().split()
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())

    for k in (4, 5):
        sets = [(d, shingles(t, k)) for d, t in by_id(rows)]
        parent = {d: d for d, _ in sets if d is not None}
        links = [(a, b) for (a, s), (b, t) in combinations([x for x in sets if x[0] is not None and x[1]], 2) if 100 * len(s & t) >= 80 * len(s | t)]
        for _ in range(len(parent)):
            for a, b in links:
                parent[a] = parent[b] = min(parent[a], parent[b])
        expected = Counter((d, len(s), parent.get(d), d is None or parent[d] == d) for d, s in sets)
        assert Counter(map(tuple, minhash_dedup.near_duplicates(docs, k=k).collect())) == expected
    assert minhash_dedup.near_duplicates(empty).count() == 0


def test_pairs_of_one_hub_are_dealt(spark, monkeypatch):
    """The pairs of a hub meet its set in several salts; none is lost or repeated."""
    rng = np.random.default_rng(4)
    sets = {i: sorted(rng.choice(40, rng.integers(25, 40), replace=False).tolist()) for i in range(60)}
    pairs = [(a, b) for b in (0, 1) for a in range(2, 60)] + [(3, 2)]
    expected = [(a, b) for a, b in pairs if 100 * len({*sets[a]} & {*sets[b]}) >= 80 * len({*sets[a]} | {*sets[b]})]
    monkeypatch.setattr(minhash_dedup, "HUB_PAIRS", 7)
    got = minhash_dedup.verified(spark.createDataFrame(pairs, "a long, b long"), spark.createDataFrame(list(sets.items()), "doc_id long, shingles array<long>"), 80)
    assert 0 < len(expected) < len(pairs) and sorted(map(tuple, got.collect())) == sorted(expected)


def test_near_copies_that_do_not_link_to_one_hub(spark):
    """A chain of texts, each near its neighbours only, and a group around a text that is not in it."""
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base[9 * i :] + [f"x{j}" for j in range(9 * i)]) for i in range(12)]
    texts += [" ".join(f"y{rng.integers(10**9)}" if rng.random() < 0.045 else f"b{i}" for i in range(120)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(docs, k=4).collect()}
    sets = [set(zip(*[t.split()[i:] for i in range(4)])) for t in texts]
    label = list(range(len(texts)))
    for _ in range(len(texts)):
        for a, b in combinations(range(len(texts)), 2):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                label[a] = label[b] = min(label[a], label[b])
    assert [out[i] for i in range(len(texts))] == label
    assert len(set(label)) > 2


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    sets = [pool[:2000], pool[500:2500], pool[:3], pool[:3]]
    sig = minhash_dedup.superminhash(np.concatenate(sets), np.repeat(np.arange(4), [len(s) for s in sets]), 4)
    assert abs((sig[0] == sig[1]).mean() - 0.6) < 0.12 and (sig[2] == sig[3]).all()


def test_substring_dedup(docs, rows, empty):
    depth, where = 35, Counter()
    texts = [split(t) for _, t in by_id(rows)]
    for w in texts:
        where.update(tuple(w[i : i + depth]) for i in range(len(w) - depth + 1))
    expected = Counter()
    for (doc, _), w in zip(by_id(rows), texts):
        gone = set()
        for i in range(len(w) - depth + 1):
            if where[tuple(w[i : i + depth])] > 1:
                gone.update(range(i, i + depth))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        expected[doc, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    for hot in (200, 2):
        assert Counter(map(tuple, substring_dedup.count_removed(docs, split=hot).collect())) == expected
    assert substring_dedup.count_removed(empty).count() == 0
    out = substring_dedup.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(rows)


def test_sharding(docs, rows, empty):
    out = sharding.assign_shards(docs, shards=5).collect()
    assert len(out) == len(rows)
    expected = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in by_id(rows))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == expected
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len({len(s) for s in slots.values()}) <= 2
    again = {(r.doc_id, r.size, r.shard, r.slot) for r in sharding.assign_shards(docs.repartition(7), shards=5).collect()}
    assert again == {(r.doc_id, r.size, r.shard, r.slot) for r in out}
    assert sharding.assign_shards(empty).count() == 0
    for n in (1, 2, 3, 17, 1000):
        assert sorted(sharding.feistel(np.arange(n), n, 9)) == list(range(n))


def test_token_counts(docs, rows, empty, spark, tmp_path):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    tokenizer, cache = Tokenizer.from_file(path), f"file://{tmp_path}/cache"
    expected = Counter((d, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False))) for d, t in by_id(rows))
    first = token_counts.count_tokens(docs.where("doc_id < 20"), path, cache).collect()
    assert not any(r.cached for r in first)
    whole = token_counts.count_tokens(docs, path, cache).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in whole) == expected
    assert {r.doc_id for r in whole if r.cached} >= set(range(20)) and not all(r.cached for r in whole)
    assert spark.read.parquet(cache).count() == len({t or "" for _, t in by_id(rows)})
    assert token_counts.count_tokens(empty, path).count() == 0


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    path, length = tokenizer_path("word_bpe_49k.json"), 128
    tokenizer = Tokenizer.from_file(path)
    out = packing.pack_documents(docs, path, length, with_ids=True).collect()
    expected = Counter()
    for doc, text in by_id(rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), length)):
            part = np.array(ids[at : at + length], dtype="<u4").tobytes()
            expected[doc, piece, at, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == expected
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in out)
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= length
    assert len(bins) <= -(-sum(r.length for r in out) // length) + 2
    assert packing.pack_documents(empty, path).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_fullest_is_the_best_filling(seed):
    rng = np.random.default_rng(seed)
    for _ in range(200):
        counts = np.zeros(31, dtype=np.int64)
        for n in rng.integers(3, 30, rng.integers(1, 9)):
            counts[n] += 1
        room = int(rng.integers(0, 60))
        items = [n for n in range(31) for _ in range(counts[n])]
        best = max(s for k in range(len(items) + 1) for c in combinations(items, k) if (s := sum(c)) <= room)
        taken = packing.fullest(counts, sorted({*items}, reverse=True), room)
        assert sum(taken) == best and all(c <= counts[n] for n, c in Counter(taken).items())


def test_piece_sampling(docs, rows, empty):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = piece_sampling.encode_texts(docs, path, seed=1, rate=0.0).collect()
    assert all(np.frombuffer(r.ids, "<u4").tolist() == library.encode(r.text or "") for r in plain if "▁" not in (r.text or ""))
    one = piece_sampling.encode_texts(docs, path, seed=1, rate=0.3)
    two = piece_sampling.encode_texts(docs, path, seed=2, rate=0.3).collect()
    again = piece_sampling.encode_texts(docs.repartition(5), path, seed=1, rate=0.3).collect()
    assert Counter((r.doc_id, r.text, bytes(r.ids)) for r in one.collect()) == Counter((r.doc_id, r.text, bytes(r.ids)) for r in again)
    assert {(r.doc_id, bytes(r.ids)) for r in one.collect()} != {(r.doc_id, bytes(r.ids)) for r in two}
    assert all(r.lossless for r in two) and sum(len(r.ids) for r in two) > sum(len(r.ids) for r in plain)
    back = Counter((r.doc_id, r.text) for r in piece_sampling.decode_ids(one, path).collect())
    assert back == Counter((d, t or "") for d, t in by_id(rows))
    assert piece_sampling.encode_texts(empty, path, seed=1).count() == 0


def test_lm_scores(docs, rows, empty):
    out = lm_scoring.score_documents(docs, depth=4).collect()
    assert len(out) == len(rows)
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in by_id(rows) if d is not None} | {None: False}
    counts = Counter()
    for d, t in by_id(rows):
        if not held[d]:
            counts.update([*split((t or "").encode().lower().decode()), b"\n"])
    total = sum(counts.values())
    text = {(d, len((t or "").encode())): [*(t or "").encode().lower().split(), b"\n"] for d, t in by_id(rows)}
    for r in out:
        tokens = text[r.doc_id, r.n_bytes]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(tokens), sum(w in counts for w in tokens), total)
        assert abs(r.base_score - sum(np.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in tokens)) < 1e-6
        assert r.score < 0 and (r.bits_per_byte is None) == (r.n_bytes == 0)
    assert lm_scoring.score_documents(empty).count() == 0


def by_definition(train, texts, depth):
    """log10 probabilities of texts by context-tree weighting, node by node."""
    seen = defaultdict(lambda: [0, 0])
    children = defaultdict(set)

    def decisions(text):
        raw = b"\0" * depth + text + b"\xff"
        for i in range(depth, len(raw)):
            bits = f"{raw[i]:08b}"
            for j in range(8):
                yield [(raw[i - d : i], bits[:j]) for d in range(depth + 1)], int(bits[j])

    for text in train:
        for path, bit in decisions(text):
            for node in path:
                seen[node][bit] += 1
            for up, down in zip(path, path[1:]):
                children[up].add(down)

    @functools.cache
    def log_own(node):
        n0, n1 = seen[node]
        return math.lgamma(n0 + 0.5) + math.lgamma(n1 + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(n0 + n1 + 1)

    @functools.cache
    def log_weighted(node):
        if len(node[0]) == depth:
            return log_own(node)
        return float(np.logaddexp(log_own(node), below(node))) - math.log(2)

    @functools.cache
    def below(node):
        return sum(map(log_weighted, children[node]))

    out = []
    for text in texts:
        total = 0.0
        for path, bit in decisions(text):
            mixed = None
            for node in reversed(path):
                n = seen[node]
                own = (n[bit] + 0.5) / (n[0] + n[1] + 1)
                weight = 1.0 if mixed is None else math.exp(log_own(node) - math.log(2) - log_weighted(node))
                mixed = own if mixed is None else weight * own + (1 - weight) * mixed
            total += math.log10(mixed)
        out.append(total)
    return out


@pytest.mark.parametrize("hot", [10**9, 100])
def test_lm_scores_by_definition(spark, monkeypatch, hot):
    """Also with most contexts divided over shards, several bytes deep."""
    import random

    rng = random.Random(4)
    texts = [words(rng, rng.randint(1, 40)) for _ in range(30)] + ["", None, "the the the the " * 20, "caf\u00e9 \U0001f600 END"]
    monkeypatch.setattr(lm_scoring, "HOT_BYTES", hot)
    monkeypatch.setattr(lm_scoring, "HOT_MOST", 10**9)
    monkeypatch.setattr(lm_scoring, "MIN_BLOCKS", 4)
    low = [(t or "").encode().lower() for t in texts]
    train = [t for i, t in enumerate(low) if zlib.crc32(str(i).encode()) % 7 != 2]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    if hot == 100:
        cuts = lm_scoring.hot_contexts(docs.fillna(""), 4, hot)
        assert sorted(cuts.hot) == [2, 3] and all(len(c) > 1 for c in cuts.hot.values())
    out = {r.doc_id: r.score for r in lm_scoring.score_documents(docs, depth=4).collect()}
    for i, expected in enumerate(by_definition(train, low, 4)):
        assert abs(out[i] - expected) < 1e-4 * max(1, abs(expected)), i


def test_rows_alike_are_encoded_once(spark, tmp_path, monkeypatch):
    """351 rows of null and repeated doc_ids with two contents: two texts are encoded, none once the cache has them."""
    path = str(tokenizer_path("byte_bpe_50k.json"))
    rows = [(None, "the same text for all")] * 200 + [(7, "the same text for all")] * 50 + [(7, "another text")] * 100 + [(8, "another text")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    made, whole = [], token_counts.encode_counts

    def encode_counts(misses, *more):
        out = whole(misses, *more)
        made.append(out.count())
        return out

    monkeypatch.setattr(token_counts, "encode_counts", encode_counts)
    cache = str(tmp_path / "cache")
    for known in (False, True):
        out = token_counts.count_tokens(table, path, cache).collect()
        assert sorted((r.doc_id or 0, r.n_bytes) for r in out) == sorted((d or 0, len(t)) for d, t in rows)
        assert {r.cached for r in out} == {known} and len({(r.n_bytes, r.n_tokens) for r in out}) == 2
    assert made == [2, 0]
