"""Operator 11: targets against resharing by hand, draws against their law, the mix against the words of its documents."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from tideline.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, rank string, at string, first string"


def resharing(sizes: dict, weights=(5, 2, 1), percent=150, repeat=2) -> dict:
    """Targets by the plain rule: share by weight, stop at the cap, share the rest again."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, target, open_ = Fraction(sum(sizes.values()) * percent, 100), dict.fromkeys(order, Fraction(0)), {*order}
    while left > 0 and open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if target[s] + share * weight[s] >= repeat * sizes[s]}
        for s in full:
            left -= repeat * sizes[s] - target[s]
            target[s] = Fraction(repeat * sizes[s])
        open_ -= full
        if not full:
            for s in open_:
                target[s] += share * weight[s]
            break
    return target


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(11)
    rows = []
    for i in range(300):
        source = "hot" if i % 3 == 0 else rng.choice([None, "a", "b", "é", "Z", "", "~", "c" * 40])
        text = rng.choice([None, "", " \t ", "w"]) if i % 17 == 0 else " ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.randint(1, 300)))
        rows.append((i - 20, text, source))
    rows += [(1005, "one two three", "a")] * 40 + [(None, "x y", None)] * 30 + [(1007, "long " * 20_000, "big"), (1008, None, "none"), (1009, "lonely", "one")]
    docs = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(5)
    mix = mixing.plan_mix(docs, block=16, shard_blocks=64, keep_text=True)
    return rows, docs, mix


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_and_taken_words(mixed):
    rows, docs, mix = mixed
    out = mixing.taken_words(mix).collect()
    assert Counter((r.doc_id, r["size"]) for r in out) == Counter((d, size(t)) for d, t, _ in rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    want = resharing(sizes)
    of = {(r.source_size, round(r.target, 6)) for r in out}
    assert of == {(sizes[s], round(float(want[s]), 6)) for s in sizes}
    assert all(0 <= r.taken <= 2 * r["size"] for r in out)
    by_source = {s: 0 for s in sizes}
    for r in mix.draws.join(mix.sources, "rank").groupBy("source").sum("words").collect():
        by_source[r.source] = r[1]
    assert all(abs(by_source[s] - want[s]) <= Fraction(1, 2) for s in sizes)
    assert sum(r.taken for r in out) == sum(by_source.values())
    again = mixing.taken_words(mixing.plan_mix(docs.repartition(3), block=16, shard_blocks=64)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))


def test_the_text_of_the_mix(mixed):
    rows, _, mix = mixed
    out = mixing.mixed_text(mix).collect()
    slots = defaultdict(set)
    for r in out:
        slots[r.shard].add(r.slot)
        assert len(r.text.split(" ")) == r.words == sum(s.words for s in r.spans) <= 16
    assert all(s == {*range(len(s))} for s in slots.values()) and all(len(slots[k]) == 64 for k in range(len(slots) - 1))
    assert len(out) == mix.draws.count() == sum(map(len, slots.values()))
    taken = defaultdict(int)
    unique = {d: t for d, t, _ in rows if d is not None and d != 1005}
    for r in out:
        words = r.text.split(" ")
        for s in r.spans:
            part, words = words[: s.words], words[s.words :]
            taken[s.doc_id] += s.words
            if s.doc_id in unique:
                assert re.findall(r"[^\x20\x09-\x0D]+", unique[s.doc_id])[s.start : s.start + s.words] == part
    want = defaultdict(int)
    for r in mixing.taken_words(mix).collect():
        want[r.doc_id] += r.taken
    assert taken == {d: n for d, n in want.items() if n}


def test_counts_of_shards():
    """Drawn alone or together, by group or in one, counts fill each shard, and their spread is that of a multinomial draw without replacement."""
    rng = np.random.default_rng(1)
    n = rng.integers(0, 400, 50)
    groups = np.array([n[:20].sum(), n[20:].sum()])
    shards = -(-int(n.sum()) // 64)
    parts = [list(mixing.shard_counts(groups, m, g, 0, shards, 64, 9)) for g, m in enumerate((n[:20], n[20:]))]
    filled = [sum(int(p[k][2].sum()) for p in parts) for k in range(shards)]
    assert filled == [64] * (shards - 1) + [int(n.sum()) - 64 * (shards - 1)]
    for g, m in enumerate((n[:20], n[20:])):
        assert (sum(x[2] for x in parts[g]) == m).all()
        given = np.zeros(len(m), dtype=np.int64)
        for k, before, counts, first in parts[g]:
            assert (first == given).all() and before == (int(parts[0][k][2].sum()) if g else 0)
            alone = next(mixing.shard_counts(groups, m, g, k, k + 1, 64, 9))
            assert (alone[2] == counts).all() and (alone[3] == first).all()
            given += counts
    many = np.array([x[2][0] for s in range(400) for x in mixing.shard_counts(np.array([800]), np.array([200, 600]), 0, 0, 8, 100, s)])
    assert abs(many.mean() - 25) < 1e-9 and abs(many.var() / (100 * 0.25 * 0.75 * 700 / 799) - 1) < 0.15


def test_draws_from_very_many():
    rng = np.random.default_rng(2)
    counts = np.array([5, 10**12, 0, 3 * 10**12, 700], dtype=np.int64)
    for sample in (0, 1, 10**12, int(counts.sum()) - 2, int(counts.sum())):
        out = mixing.drawn(counts, sample, rng)
        assert out.sum() == sample and (out >= 0).all() and (out <= counts).all()


def test_permutations():
    for n in (1, 2, 3, 4, 5, 17, 64, 1000):
        size, key = np.full(n, n), np.full(n, 12345, dtype=np.uint64)
        there = mixing.permuted(np.arange(n), size, key)
        assert sorted(there) == [*range(n)]
        assert (mixing.permuted(there, size, key, back=True) == np.arange(n)).all()


def test_nothing_to_mix(spark, empty):
    for docs in (empty.withColumn("source", empty.shard), spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")):
        mix = mixing.plan_mix(docs, keep_text=True)
        out = mixing.taken_words(mix).collect()
        assert len(out) == docs.count() and all(r.taken == r["size"] == r.target == 0 for r in out)
        assert mixing.mixed_text(mix).count() == 0
