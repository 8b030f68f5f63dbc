"""The data structures behind the operators against brute force, and the operator on embeddings."""

from collections import Counter
from fractions import Fraction
from itertools import combinations, product

import numpy as np
import pytest

from tideline.llm import cover_tree, embedding_dedup
from tideline.llm.components import connected_components, union_find
from tideline.llm.context_tree import Cuts, KeyTable, TopNodes, deep, gram_codes, log_kt
from tideline.llm.fm_index import FMIndex
from tideline.llm.lm_scoring import END, block_counts, pack, unpack, word_keys


def test_fm_index_counts_windows():
    rng = np.random.default_rng(1)
    for depth, _ in product((3, 5, 8, 35), range(15)):
        parts = [rng.integers(1, 4 if depth < 8 else 2, rng.integers(depth, depth + 30)) for _ in range(rng.integers(1, 12))]
        weights = rng.integers(1, 4, len(parts))
        text = np.concatenate([np.append(p, 0) for p in parts])
        index = FMIndex(text, np.concatenate([np.full(len(p) + 1, w) for p, w in zip(parts, weights)]), int(text.max()) + 1, depth)
        where = Counter()
        for p, w in zip(parts, weights.tolist()):
            for i in range(len(p) - depth + 1):
                where[tuple(p[i : i + depth])] += w
        for query in (parts, [rng.integers(1, 6, rng.integers(1, depth + 40)) for _ in range(5)]):
            stream = np.concatenate([np.append(q, 0) for q in query])
            ends = np.cumsum([len(q) + 1 for q in query]) - 1
            starts = ends - np.array([len(q) for q in query])
            found = index.matches(stream, starts, ends)
            for q, s in zip(query, starts):
                assert found[s : s + len(q)].tolist() == [where[tuple(q[i : i + depth])] if i + depth <= len(q) else 0 for i in range(len(q))]


def kt(bits):
    p, seen = Fraction(1), [0, 0]
    for b in bits:
        p *= Fraction(2 * seen[b] + 1, 2 * sum(seen) + 2)
        seen[b] += 1
    return p


def weighted(history, depth, at=()):
    """P_w of a node: history is a list of (context bytes, newest first, and bit)."""
    own = kt([b for _, b in history])
    if len(at) == depth or not history:
        return own
    below = Fraction(1)
    for c in {h[0][len(at)] for h in history}:
        below *= weighted([h for h in history if h[0][len(at)] == c], depth, (*at, c))
    return own / 2 + below / 2


def test_context_tree_weighting_by_definition():
    """The chance of a bit is P_w with it over P_w without it."""
    depth, texts = 3, [b"abracadabra", b"abba cab", b"caba"]
    codes, _ = gram_codes(texts, depth)
    grams, counts = np.unique(codes, return_counts=True)
    extra, _ = gram_codes([b"abrc"], depth)
    every = np.unique(np.concatenate([grams, extra]))
    n = np.zeros(len(every))
    n[np.searchsorted(every, grams)] = counts
    predicted, nodes = deep(every, n, depth)
    low, at = np.unique((nodes["context"] & 255) * 256 + nodes["place"], return_inverse=True)
    top = TopNodes(low >> 8, low & 255, *[np.bincount(at, nodes[k], len(low)) for k in ("n0", "n1", "logs")])
    got = dict(zip(every.tolist(), top.log10(every, predicted).tolist()))
    for gram in every.tolist():
        raw = gram.to_bytes(depth + 1, "big")
        total = 0.0
        for j in range(8):
            prefix, bit = raw[-1] >> (8 - j), (raw[-1] >> (7 - j)) & 1
            history = []
            for c in codes.tolist():
                own = c.to_bytes(depth + 1, "big")
                if own[-1] >> (8 - j) == prefix:
                    history.append((own[-2::-1], (own[-1] >> (7 - j)) & 1))
            context = raw[-2::-1]
            total += np.log10(float(weighted([*history, (context, bit)], depth) / weighted(history, depth)))
        assert abs(total - got[gram]) < 1e-9


def test_log_kt():
    for a, b in ((0, 0), (1, 0), (3, 5), (70, 2), (200, 300)):
        exact = kt([0] * a + [1] * b)
        assert abs(log_kt(np.array([a]), np.array([b]))[0] - (np.log(exact.numerator / exact.denominator) if a + b < 200 else float(np.sum(np.log([((2 * i + 1) / 2) for i in range(a)])) + np.sum(np.log([((2 * i + 1) / 2) for i in range(b)])) - np.sum(np.log(np.arange(1, a + b + 1)))))) < 1e-8


def test_pack():
    for x in ([], [5], [-(2**63), 2**63 - 1, 0, 7]):
        assert unpack(pack(np.array(x, dtype=np.int64))).tolist() == x


def test_word_keys():
    long = "x" * 64
    texts = [t.encode() for t in ("", " \n", "one two  one\tthree", "\x0bone\x0c\r", "eightlet eightlets \x1c\x85 eightlet\0", f"{long} {long}y {long}yz {long}y \0 \0\0", "caf\u00e9 caf", "")]
    split = [[*t.split(), None] for t in texts]
    keys, begins = word_keys(texts)
    assert begins.tolist() == np.cumsum([0, *map(len, split)])[:-1].tolist()
    pairs = set(zip((w for s in split for w in s), keys.tolist(), strict=True))
    assert len(pairs) == len({w for w, _ in pairs}) == len({k for _, k in pairs}) and (None, int(END)) in pairs


def test_counting_a_block_takes_no_step_by_word():
    import cProfile
    import pstats

    texts, profile = [" ".join(f"w{i}" for i in range(a, a + 20_000)).encode() for a in (0, 10_000)], cProfile.Profile()
    (grams, g_counts, _, _), (words, w_counts, order, bounds) = profile.runcall(block_counts, texts, np.array([1, 0]), 5, 7, Cuts({}))
    assert pstats.Stats(profile).total_calls < 5_000
    assert len(words) == 30_001 and w_counts.sum() == 20_001 and set(w_counts.tolist()) == {0, 1}
    codes = [gram_codes([t + b"\xff"], 5)[0].tolist() for t in texts]
    expected = Counter(codes[0])
    assert dict(zip(grams.tolist(), g_counts.tolist())) == {c: expected[c] for c in codes[0] + codes[1]}
    assert bounds[-1] == len(words) and all((np.diff(words[order[a:b]].astype(object)) > 0).all() for a, b in zip(bounds, bounds[1:]))


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_key_table(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**40, n).astype(np.uint64))
    others = np.append(keys + np.uint64(1), np.uint64(0))
    assert KeyTable(keys).find(keys).tolist() == list(range(len(keys)))
    where = {k: i for i, k in enumerate(keys.tolist())}
    assert KeyTable(keys).find(others).tolist() == [where.get(k, -1) for k in others.tolist()]


def test_union_find():
    nodes, roots = union_find([5, 3, 9], [3, 1, 8])
    assert dict(zip(nodes, roots)) == {5: 1, 3: 1, 1: 1, 9: 8, 8: 8}


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(300, 300)]
    out = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(200, 260)]}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def shapes(n, dims=32):
    """Unit vectors that lie scattered, dense, closer than the threshold, in clusters of several widths, and with copies."""
    rng = np.random.default_rng(4)
    centre, several = rng.standard_normal((1, dims)), cover_tree.unit(rng.standard_normal((n // 20, dims)))
    noise = rng.standard_normal((n, dims))
    clusters = several[rng.integers(0, len(several), n)] + rng.choice([0.005, 0.02, 0.06], n)[:, None] * noise
    copies = several[rng.integers(0, len(several), n)]
    return {k: cover_tree.unit(v) for k, v in {"scattered": noise, "dense": centre + 0.12 * noise, "close": centre + 0.01 * noise, "clusters": clusters, "copies": copies}.items()}


def by_definition(near):
    """Of a symmetric matrix of links: the smallest place reachable from each."""
    label = np.arange(len(near))
    while (new := np.minimum(label, np.where(near, label[None, :], len(label)).min(1)).tolist()) != label.tolist():
        label = np.array(new)
    return label


@pytest.mark.parametrize("shape", shapes(20))
def test_cover_tree_levels(shape):
    tree = cover_tree.CoverTree.build(shapes(600)[shape])
    assert sorted(tree.order.tolist()) == list(range(600))
    assert shape == "copies" or tree.size[tree.leaf].max() <= cover_tree.LEAF
    assert tree.depth() > 1
    for (s, e, first, n), r in zip(tree.nodes.tolist(), tree.radii.tolist()):
        far = np.sqrt(((tree.points[s:e] - tree.points[s]) ** 2).sum(1)).max()
        assert far <= r + cover_tree.MARGIN and r <= far + cover_tree.MARGIN
        if n:
            kids = tree.nodes[first : first + n]
            assert kids[0, 0] == s and kids[-1, 1] == e and (kids[1:, 0] == kids[:-1, 1]).all()
            half = 2.0
            while half >= r:
                half /= 2
            apart = np.sqrt(((tree.points[kids[:, None, 0]] - tree.points[kids[None, :, 0]]) ** 2).sum(-1)) + 9 * np.eye(n)
            assert apart.min() > half - cover_tree.MARGIN and tree.radii[first : first + n].max() <= half + cover_tree.MARGIN


@pytest.mark.parametrize("shape", shapes(20))
def test_dual_traversal(shape):
    rng = np.random.default_rng(5)
    points, weight = shapes(600)[shape], rng.integers(1, 4, 600)
    one, two = cover_tree.CoverTree.build(points[:350]), cover_tree.CoverTree.build(points[350:])
    u, v = weight[:350][one.order], weight[350:][two.order]
    near = np.zeros((600, 600), dtype=bool)
    near[:350, 350:] = one.points @ two.points.T >= 0.98
    near |= near.T
    found = cover_tree.dual_traversal(one, two, 0.98, u, v)
    assert found.weight.tolist() == (near @ np.concatenate([u, v])).tolist() and found.label.tolist() == by_definition(near).tolist()
    near = one.points @ one.points.T >= 0.98
    np.fill_diagonal(near, False)
    found = cover_tree.dual_traversal(one, one, 0.98, u, u)
    assert found.weight.tolist() == (near @ u).tolist() and found.label.tolist() == by_definition(near).tolist()
    nodes = len(one.nodes)
    assert found.looked < nodes * nodes
    if shape == "scattered":  # most pairs of leaves are ruled out by their radii, at the first level
        assert found.pruned > 0.9 * found.looked
    if shape == "clusters":  # most of the pairs of points lie under node pairs that were ruled out higher up
        assert found.pruned > 0.6 * found.looked and found.looked < 350 * 350 / 5
    if shape == "close":  # the whole tree links at the root
        assert found.looked == 0


def test_groups_by_masks():
    rng = np.random.default_rng(6)
    for _ in range(20):
        near = rng.random((30, 40)) < 0.03
        groups, both = cover_tree.Groups(70), np.zeros((70, 70), dtype=bool)
        groups.link_where(near, np.arange(30), np.arange(30, 70))
        both[:30, 30:] = near
        assert groups.label.tolist() == by_definition(both | both.T).tolist()


def test_embedding_dedup(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((5, 8))
    rows = [(i, (base[i % 5] + 0.08 * rng.standard_normal(8)).astype(np.float32).tolist(), i % 2, "x") for i in range(120)]
    rows += [(200 + i, rows[3][1], 1, "x") for i in range(30)]
    rows += [(300, None, 1, "x"), (301, [0.0] * 8, 1, "x"), (302, [float("nan")] * 8, 1, "x"), (303, [None] * 8, 1, "x"), (304, rows[3][1], None, "x"), (305, [], 1, "x"), (306, [float("inf")] * 8, 1, "x"), (307, rows[3][1][:4], 1, "x"), rows[0], (None, rows[3][1], 1, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n_links string")
    good = {r[0]: r for r in rows if r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])}
    links = [(a, b) for a, b in combinations(good, 2) if good[a][2] == good[b][2] and len(good[a][1]) == len(good[b][1]) and np.dot(good[a][1], good[b][1]) / np.linalg.norm(good[a][1]) / np.linalg.norm(good[b][1]) >= 0.98]
    n = Counter(x for pair in links for x in pair)
    label = {r[0]: r[0] for r in rows}
    for _ in range(len(label)):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    expected = Counter((r[0], n[r[0]], label[r[0]], r[0] is None or label[r[0]] == r[0]) for r in rows)
    assert links and Counter(map(tuple, embedding_dedup.link_vectors(df).collect())) == expected
    monkeypatch.setattr(embedding_dedup, "BLOCK", 8)
    monkeypatch.setattr(embedding_dedup, "TILE_CELLS", 8 * 8 * 2)
    assert Counter(map(tuple, embedding_dedup.link_vectors(df).collect())) == expected
    assert embedding_dedup.link_vectors(df.limit(0)).count() == 0


def test_agendas_together_equal_one_by_one():
    import random

    from tideline.llm.piece_sampling import LITERAL, PieceModel
    from tideline.llm.queries import tokenizer_path

    model, rng = PieceModel(tokenizer_path("piece_bpe_32k.model")), random.Random(3)
    parts = ["".join(rng.choice("▁etaoinshrdlué你ꙮ.") for _ in range(rng.randint(1, 90))) for _ in range(3000)] + ["▁the", "a", "ꙮ", LITERAL, "▁" * 70]
    keys = np.array([rng.getrandbits(64) for _ in parts], dtype=np.uint64)
    for rate in (0.0, 0.2, 0.9):
        limit = int(rate * 2**53)
        assert model.segment_many(parts, keys, limit) == [np.array(model.segment(p, int(k), limit), dtype="<u4").tobytes() for p, k in zip(parts, keys)]


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.9])
@pytest.mark.parametrize("limit", [400, 1_200_000])
def test_units_are_remembered_from_their_second_time_on(rate, limit):
    import random

    from tideline.llm.piece_sampling import PieceModel, SegmentTree
    from tideline.llm.queries import tokenizer_path

    rng, drop = random.Random(8), int(rate * 2**53)
    tree = SegmentTree(PieceModel(tokenizer_path("piece_bpe_32k.model")), limit)
    model = tree.model
    often = [" the", " and", "\n", "▁", " ꙮꙮ你.", " " + "on" * 40, " " + "on" * 40 + ",", "x", " "]
    single = list(dict.fromkeys(" " + "".join(rng.choice("etaoinshrdlué你ꙮ") for _ in range(rng.randint(3, 14))) + rng.choice(("", ".", ",")) for _ in range(3000)))
    for call in range(6):
        units = single[call * 500 : call * 500 + 500] + [rng.choice(often) for _ in range(200)] + single[:50] * (call > 3)
        rng.shuffle(units)
        keys = np.array([rng.getrandbits(64) for _ in units], dtype=np.uint64)
        ids, counts = tree.encode(units, keys, drop)
        expected = [[i for p, limit_ in zip(model.parts(u), (drop, 0)) for i in model.segment(p, int(k), limit_)] for u, k in zip(units, keys)]
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == expected
        if not call:
            assert len(tree.roots) < 50 and not any(u in tree.units for u in single[:500] if u.rstrip(".,").replace(" ", "▁") not in tree.roots)
    ids, counts = tree.encode([], np.zeros(0, dtype=np.uint64), drop)
    assert not len(ids) and not len(counts)
