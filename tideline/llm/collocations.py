"""Operator 13, phrase collocations by a weighted de Bruijn graph.

Nodes are phrases of order - 1 words, edges those of order words. Each word of a text starts one row: the edge that begins
with it, or, within order - 1 words of its piece's end, the shorter phrase that the end leaves (a correction). Rows alike
are added up, in each task first, so the weight of an edge is its phrase's count; the count of a shorter phrase is the flow
out of it, the weights of all edges that begin with it and its corrections, and needs no counting of its own. Words are
64-bit hashes of language and word while counts are made; a table of words with their hashes, made in the same pass, tells
what they stand for. If it shows that two words share a hash, all is done again with other hashes.

A node whose whole flow comes in by one edge and goes out by one edge is inside a unary path and is compacted: its phrase
is never more frequent than the edges around it. unary_paths() gives whole paths, the long passages that repeat as one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import U64, mix64, saved

UPPER, LOWER, ENDS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b".,;:!?\n\x0b\x0c\r"
#: A byte that UTF-8 never has stands for the end of a piece.
FOLD, END = bytes.maketrans(UPPER + ENDS, LOWER + b"\xff" * len(ENDS)), b"\xff"
SPLIT = re.compile(rb"[ \t\xff]")
#: Words whose rows a task adds up at once, different words it remembers, and bytes it splits at once.
GROUP, VOCABULARY, SLICE = 3_000_000, 500_000, 1 << 22


class Graph(NamedTuple):
    """words: lang, word, id, n (all words); phrases: by length from 2 to order the frequent ones, w1, w2, ..., a."""

    words: DataFrame
    phrases: dict[int, DataFrame]


class Words(dict):
    """Hashes of one language's words; 0 is the end of a piece."""

    def __init__(self, lang: str, seed: int):
        super().__init__({END: 0})
        self.head, self.seed = b"%d:%b" % (len(lang.encode()), lang.encode()), seed

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = self[word] = xxhash.xxh3_64_intdigest(self.head + word, self.seed) or 1
        return h


def slices(text: str) -> Iterator[list[bytes]]:
    """The words of a text in order, folded, with END where pieces end, some megabytes at once."""
    data, at = text.encode().translate(FOLD), 0
    while at < len(data):
        found = SPLIT.search(data, at + SLICE)
        end = found.start() if found else len(data)
        yield data[at:end].replace(END, b" \xff ").split()
        at = end


def summed(ids: np.ndarray, order: int, last: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The rows that the words before `last` start, zeros after a piece's end, each once with its count; and the words that start them."""
    columns = [ids[:last]]
    for j in range(1, order):
        after = ids[j : j + last]
        after = np.concatenate([after, np.zeros(last - len(after), dtype=U64)])
        columns.append(np.where(columns[-1] == 0, U64(0), after))
    columns = [c[columns[0] != 0] for c in columns]
    node = np.zeros(len(columns[0]), dtype=U64)
    for c in columns[:-1]:
        node = mix64(node + c)
    place = np.argsort((node & ~U64(0xFFFFFF)) | (mix64(columns[-1]) & U64(0xFFFFFF)))  # rows of a node lie together
    columns = [c[place] for c in columns]
    new = np.ones(len(place), dtype=bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    starts = np.flatnonzero(new)
    return [c[starts] for c in columns], np.diff(np.append(starts, len(place))), columns[0]


def rows(docs: DataFrame, order: int, seed: int) -> DataFrame:
    """w1, ..., n of edges and corrections (lang and word null), and id as w1 (the others null), n, lang and word of the words."""
    names = [f"w{i + 1}" for i in range(order)]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known: dict[str, Words] = {}
        held: list[np.ndarray] = []

        def record(columns: list, n: np.ndarray, lang: object, word: object) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64()), lang, word], names=[*names, "n", "lang", "word"])

        def flush(whole: bool) -> Iterator:
            """whole: a text has ended; else the last words stay, as the rows that they start go on."""
            ids = np.concatenate(held) if held else np.empty(0, dtype=U64)
            last = len(ids) if whole else max(0, len(ids) - order + 1)
            columns, n, starts = summed(ids, order, last)
            held[:] = [] if whole else [ids[last:]]
            none = pa.nulls(len(n), pa.string())
            yield record([pa.array(c.view(np.int64)) for c in columns], n, none, none)
            found, times = np.unique(starts, return_counts=True)
            for lang, words in known.items():
                at = np.fromiter(words.values(), dtype=U64, count=len(words))
                place = np.minimum(np.searchsorted(found, at), len(found) - 1)
                hit = np.flatnonzero((found[place] == at) & (at != 0)) if len(found) else []
                if len(hit):
                    every = list(words)
                    text = pa.array([every[i] for i in hit], pa.binary()).cast(pa.string())
                    empty = pa.nulls(len(hit), pa.int64())
                    yield record([pa.array(at[hit].view(np.int64)), *[empty] * (order - 1)], times[place[hit]], pa.array([lang] * len(hit)), text)
            if sum(map(len, known.values())) >= VOCABULARY:
                keep = {lang: [w for w, h in words.items() if h in rest] for lang, words in known.items()} if (rest := {*held[0].tolist()} if held else set()) else {}
                known.clear()
                for lang, some in keep.items():
                    for w in some:
                        known.setdefault(lang, Words(lang, seed))[w]

        size = 0
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in slices(text):
                    words = known.get(lang)
                    if words is None:
                        words = known[lang] = Words(lang, seed)
                    held.append(np.fromiter(map(words.__getitem__, part), dtype=U64, count=len(part)))
                    size += len(part)
                    if size >= GROUP or sum(map(len, known.values())) >= VOCABULARY:
                        yield from flush(False)
                        size = 0
                held.append(np.zeros(1, dtype=U64))
        yield from flush(True)

    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    return texts.mapInArrow(run, ", ".join(f"{x} long" for x in [*names, "n"]) + ", lang string, word string")


def graph(docs: DataFrame, order: int = 3, min_count: int = 10, seed: int = 0) -> Graph:
    """The graph of docs (text, lang): all words, and the phrases of 2 to order words that occur min_count times or more.

    Null texts are empty; a null lang is `und`. Repeated rows count each; other columns play no part.
    """
    names = [f"w{i + 1}" for i in range(order)]
    dealt = rows(docs, order, seed).repartition("w1", "w2")
    # Each sum uses every column, so that all read one exchange; what is not needed is left out after it is written.
    length = sum((F.col(c).isNotNull() & (F.col(c) != 0)).cast("int") for c in names)
    sums = [dealt.groupBy(*names, "lang", "word").agg(F.sum("n").alias("a")).where(f"word is not null or a >= {min_count}").select(*names, "a", "lang", "word", F.lit(order).alias("of"))]
    for j in range(2, order):
        used = [F.sum("n").alias("a"), F.count("lang").alias("x"), F.count("word").alias("y"), *[F.count(c).alias(f"z{c}") for c in names[j:]]]
        flow = dealt.groupBy(*names[:j]).agg(*used).where(" + ".join(["x", "y", *(f"z{c}" for c in names[j:])]) + f" >= 0 and a >= {min_count}")
        sums.append(flow.select(*names[:j], *[F.lit(None).cast("long").alias(c) for c in names[j:]], "a", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("word"), F.lit(j).alias("of")))
    every = sums[0]
    for s in sums[1:]:
        every = every.unionByName(s)
    every = saved(every.withColumn("length", length), "grams")
    words = every.where("word is not null").select("lang", "word", F.col("w1").alias("id"), F.col("a").alias("n"))
    if not words.groupBy("id").agg(F.count("*").alias("k")).where("k > 1").isEmpty():
        return graph(docs, order, min_count, seed + 1)
    return Graph(words, {j: every.where(f"word is null and of = {j} and length = {j}").select(*names[:j], "a") for j in range(2, order + 1)})


def _inside(g: Graph, order: int, min_count: int) -> tuple[DataFrame, DataFrame]:
    """Edges with into (the whole flow of the node they lead to is theirs) and out (of the node they come from); nodes with the flow."""
    names = [f"w{i + 1}" for i in range(order)]
    nodes = g.phrases[order - 1] if order > 2 else g.words.where(f"n >= {min_count}").select(F.col("id").alias("w1"), F.col("n").alias("a"))
    first = nodes.withColumnRenamed("a", "f")
    last = nodes.select(*[F.col(names[i]).alias(names[i + 1]) for i in range(order - 1)], F.col("a").alias("t"))
    edges = g.phrases[order].join(first, names[:-1]).join(last, names[1:])
    return edges.select(*names, "a", (F.col("a") == F.col("f")).alias("out"), (F.col("a") == F.col("t")).alias("into")), nodes


def unary_nodes(g: Graph, min_count: int = 10) -> DataFrame:
    """Nodes inside unary paths: one edge brings their whole flow and one takes it."""
    order = max(g.phrases)
    edges, _ = _inside(g, order, min_count)
    names = [f"w{i + 1}" for i in range(order)]
    came = edges.where("into").select(*[F.col(names[i + 1]).alias(names[i]) for i in range(order - 1)])
    return came.join(edges.where("out").select(*names[:-1]), names[:-1])


def unary_paths(g: Graph, min_count: int = 10) -> DataFrame:
    """The compacted graph: one row per path with lang, phrase (its words joined by one space), n_words and a (the count of
    every phrase of order words in it). Edges that nothing else joins are paths of their own. A row holds a passage, which
    is no longer than a text. Heads are found by pointers that double their reach each round."""
    order = max(g.phrases)
    edges, _ = _inside(g, order, min_count)
    names = [f"w{i + 1}" for i in range(order)]
    name = lambda cols: [F.xxhash64(*cols).alias("e1"), F.xxhash64(F.lit("b"), *cols).alias("e2")]
    edges = saved(edges.select(*names, "a", "out", "into", *name(names)), "edges")
    came = edges.where("into").select(*[F.col(names[i + 1]).alias(names[i]) for i in range(order - 1)], F.col("e1").alias("p1"), F.col("e2").alias("p2"))
    # A ring of such edges would have no way in, so there is none; every chain of pointers ends at a head.
    at = saved(edges.where("out").join(came, names[:-1]).select("e1", "e2", "p1", "p2", F.lit(1).cast("long").alias("far")), "pointers")
    while True:
        up = at.select(F.col("e1").alias("p1"), F.col("e2").alias("p2"), F.col("p1").alias("h1"), F.col("p2").alias("h2"), F.col("far").alias("more"))
        step = at.join(up, ["p1", "p2"], "left").select("e1", "e2", F.coalesce("h1", "p1").alias("p1"), F.coalesce("h2", "p2").alias("p2"), (F.col("far") + F.coalesce("more", F.lit(0))).alias("far"), F.isnotnull("more").alias("moved"))
        step = saved(step, "pointers")
        at = step.drop("moved")
        if step.where("moved").isEmpty():
            break
    placed = edges.join(at, ["e1", "e2"], "left").select(F.coalesce("p1", "e1").alias("h1"), F.coalesce("p2", "e2").alias("h2"), F.coalesce("far", F.lit(0)).alias("far"), *names, "a")
    # A head gives all its words, the edges after it their last.
    each = F.when(F.col("far") == 0, F.array(*[F.struct((F.lit(i - order + 1).cast("long")).alias("place"), F.col(c).alias("id")) for i, c in enumerate(names)])).otherwise(F.array(F.struct(F.col("far").alias("place"), F.col(names[-1]).alias("id"))))
    steps = placed.select("h1", "h2", "a", F.explode(each).alias("s")).select("h1", "h2", "a", "s.place", "s.id")
    named = steps.join(g.words.drop("n"), "id")
    out = named.groupBy("h1", "h2", "a").agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("place", "word"))).alias("words"))
    return out.select("lang", F.array_join(F.col("words.word"), " ").alias("phrase"), F.size("words").cast("long").alias("n_words"), "a")


def collocations(docs: DataFrame, order: int = 3, min_count: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """Each language's first `top` phrases of 2 to order words: lang, rank, phrase, a, l, r, n, score.

    a: the phrase's count, at least min_count; l and r: the counts of its parts at the cut with the lowest score (of equal
    ones the first); n: all words of the language; score: floor(1000000 a a / (l r)), in decimals of 38 digits. Phrases go
    whose words lie in a longer one that is counted share % as often or more. Order: score, then a, both descending, then
    the phrase's bytes. Texts without words give nothing; an empty table gives an empty one.
    """
    g = graph(docs, order, min_count)
    common = g.words.where(f"n >= {min_count}")
    scored = None
    for j in range(2, order + 1):
        names = [f"w{i + 1}" for i in range(j)]
        one = g.phrases[j]
        if j < order:
            longer = None
            for m in range(j + 1, order + 1):
                for s in range(m - j + 1):
                    part = g.phrases[m].select(*[F.col(f"w{s + i + 1}").alias(names[i]) for i in range(j)], F.col("a").alias("most"))
                    longer = part if longer is None else longer.unionByName(part)
            if j == order - 1:  # compacted ones go first, unscored
                one = one.join(unary_nodes(g, min_count), names, "left_anti")
            one = one.join(longer.groupBy(*names).agg(F.max("most").alias("most")), names, "left").where(f"most is null or 100 * most < {share} * a").drop("most")
        for i, c in enumerate(names):
            word = common.select(F.col("id").alias(c), F.col("word").alias(f"s{i + 1}"), F.col("n").alias(f"f{i + 1}"), *([F.col("lang")] if i == 0 else []))
            one = one.join(word, c)
        cuts = []
        for k in range(1, j):
            for side, part in (("l", names[:k]), ("r", names[k:])):
                if len(part) == 1:
                    one = one.withColumn(f"{side}{k}", F.col(f"f{names.index(part[0]) + 1}"))
                else:
                    one = one.join(g.phrases[len(part)].select(*[F.col(f"w{i + 1}").alias(c) for i, c in enumerate(part)], F.col("a").alias(f"{side}{k}")), part)
            wide = lambda c: f"cast({c} as decimal(19, 0))"
            cuts.append(F.expr(f"struct((1000000 * ({wide('a')} * {wide('a')})) div ({wide(f'l{k}')} * {wide(f'r{k}')}) as score, {k} as k, l{k} as l, r{k} as r)"))
        best = one.withColumn("best", F.array_min(F.array(*cuts)))
        best = best.select("lang", F.concat_ws(" ", *[f"s{i + 1}" for i in range(j)]).alias("phrase"), "a", "best.l", "best.r", "best.score")
        scored = best if scored is None else scored.unionByName(best)
    scored = saved(scored, "scored")
    order_by = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    near = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order_by))).where(F.col("rank") <= top).drop("rank", "salt")
    first = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order_by)).cast("long")).where(F.col("rank") <= top)
    totals = g.words.groupBy("lang").agg(F.sum("n").alias("n"))
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
