"""Operator 12 against a plain trie, on conversations that share openings, copies, long ones, nulls, ties and repeated rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tideline.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, place string, key string, block string"


def plain(rows):
    convs = defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        root = c - c % 100 if c >= 0 else c + -c % 100
        built[c] = tuple(turns.get(root, [])[:h] + turns[c][h:])
    nodes = defaultdict(list)
    for c, s in built.items():
        for d in range(len(s) + 1):
            nodes[s[:d]].append(c)
    kids = defaultdict(int)
    for s in nodes:
        if s:
            kids[s[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for s, members in nodes.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += not kids[s]
            saved[s[:d]] += (len(members) - 1) * len(s[-1][1] if s else "")
    digest = lambda s: hashlib.sha256(",".join(str(c) for c in sorted(nodes[s]) if built[c] == s).encode()).hexdigest()
    return sorted((min(m), len(s), min(nodes[s[:-1]]) if s else -1, len(m), kids[s], leaves[s], saved[s], digest(s)) for s, m in nodes.items())


def found(rows):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows)


@pytest.fixture(scope="module")
def table():
    rng = random.Random(12)
    rows = []
    for c in [*range(0, 230), *range(-150, -40), 2**63 - 1, -(2**63), 1000]:
        for t in range(rng.choice((1, 2, 3, 5, 8, 9))):
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(("user", "assistant", None)), rng.choice((None, "", "hi", "hello there", "été \U0001f600", f"own {c} {t}")), "x", "x", "x"))
    for c in (300, 301, 302, 306, 308, 350):  # long, copies of each other but for one place
        rows += [(c, t, "user", "same" if (c, t) != (308, 33) else "other", "x", "x", "x") for t in range(70)]
    for c in range(400, 460):  # many copies of one conversation
        rows += [(c, t, "user", f"copy {t}", "x", "x", "x") for t in range(12)]
    rows += [(500, 1, "user", x, "x", "x", "x") for x in ("b", "a", "b", None)] * 3 + [(None, 0, "user", "nobody's", None, None, None)]
    rows += [(700, None, None, None, None, None, None)] * 20
    return rows


def tree(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return pt.prefix_trie(*pt.share_openings(pt.ordered_turns(df)))


def test_against_a_plain_trie(spark, table):
    assert found(tree(spark, table).collect()) == plain(table)


def test_small_blocks_runs_and_chunks(spark, table, monkeypatch):
    """The same with blocks of 3 turns in windows of 4, spans of 5 and chunks of 2 ids, and without heavy parents."""
    for name, value in (("WIDTH", 3), ("RUN", 4), ("SPAN", 5), ("IDS", 2), ("HEAVY", 0)):
        monkeypatch.setattr(pt, name, value)
    assert found(tree(spark, table).collect()) == plain(table)


def test_long_texts_and_no_conversations(spark):
    rows = [(c, t, "user", "long " * 100_000 + str(t % 2), "x", "x", "x") for c in (1, 2) for t in range(3)]
    assert found(tree(spark, rows).collect()) == plain(rows)
    assert tree(spark, []).collect() == [] == tree(spark, [(None, 1, "a", "b", None, None, None)]).collect()


def test_order_of_turns(spark):
    rows = [(1, 2, "b", "x"), (1, None, "z", "first"), (1, 2, "a", "y"), (1, 2, "a", "x"), (1, 0, None, None)]
    out = pt.ordered_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("place").collect()
    key = lambda r, x: hashlib.md5(f"{len(r)}:{r}{x}".encode()).hexdigest() + f"-{len(x)}"
    assert [(r.place, r.key) for r in out] == [(i, key(*k)) for i, k in enumerate([("z", "first"), ("", ""), ("a", "x"), ("a", "y"), ("b", "x")])]
