"""Operator 5, near-duplicate documents: SuperMinHash signatures, banding, exact verification, union-find grouping.

A document's set is its distinct word shingles. Documents of equal sets fall together first and are represented by the
smallest. Each representative gets a SuperMinHash signature of 128 values: every element carries its own random
permutation of the places and adds its rank there to a random fraction, so the values of one signature are correlated
and vary less than independent ones; elements are taken a rank at a time, and a document stops as soon as all its
places hold a smaller rank than the next. 32 bands of 4 values make buckets. With similarity 0.8 two sets share no
bucket with probability (1 - 0.8^4)^32 = 5e-8.

No bucket is expanded into all its pairs, and none is capped:

1. each member is verified (exact intersection of the full sets) against the bucket's smallest member;
2. buckets that still hold several components verify each member against one more member of the largest component;
3. what then remains outside the largest component of its bucket is verified against the whole bucket, in blocks.

Step 3 makes components exact: a pair in a common bucket that was never compared lies in one component already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, WordHashes, long_array, mix64, saved, sealed, shingle_hashes, texts
from .components import connected_components, union_find

PLACES, BANDS = 128, 32
#: Sets of a block that is compared with another block in one task.
BLOCK = 256
#: Pairs of one hub that are verified together.
HUB_PAIRS = 512
STEP = U64(0x9E3779B97F4A7C15)
STEPS = np.arange(1, PLACES + 1, dtype=U64) * STEP


def shingle_sets(batch_texts: list[bytes | None], k: int, words: WordHashes) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; A-Z in lower case."""
    return [np.unique(shingle_hashes(words.of((t or b"").lower().split()), k)) for t in batch_texts]


def superminhash(elements: np.ndarray, owner: np.ndarray, n: int, places: int = PLACES) -> np.ndarray:
    """Signatures (n, places) of n sets, 128 places at most; elements[i] belongs to set owner[i]. An empty set keeps the largest value."""
    sig = np.full(n * places, np.iinfo(np.uint64).max, dtype=U64)
    owner = owner.astype(np.int64)
    swaps: list[np.ndarray] = []
    for rank in range(places):
        if not len(elements):
            break
        r = mix64(elements + STEPS[rank])
        k = (U64(rank) + (((r & U64(0xFFFFFFFF)) * U64(places - rank)) >> U64(32))).astype(np.int64)
        at = k.copy()
        for t in range(rank - 1, -1, -1):  # where the swaps before have left this place's value
            at[at == swaps[t]] = t
        np.minimum.at(sig, owner * places + at, (U64(rank) << U64(32)) | (r >> U64(32)))
        swaps.append(k)
        live = (sig.reshape(n, places).max(axis=1) >> U64(32)) > U64(rank)
        on = live[owner]
        if not on.all():
            elements, owner, swaps = elements[on], owner[on], [s[on] for s in swaps]
    return sig.reshape(n, places)


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """64-bit bucket keys (n, bands); a band's number is part of its key."""
    n, places = sig.shape
    rows = sig.reshape(n, bands, places // bands)
    key = np.broadcast_to(mix64(STEPS[:bands]), (n, bands)).copy()
    for i in range(rows.shape[2]):
        key = mix64(key ^ rows[:, :, i]) + STEP
    return key


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bands): size and digest of each document's set, and its bucket keys (none if empty)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        words = WordHashes()
        for batch in batches:
            raw = batch.column(1).cast(pa.binary()).to_pylist()
            start = 0
            while start < len(raw):
                end, total = start, 0
                while end < len(raw) and (end == start or total < 4_000_000):  # bytes of text taken at a time
                    total += len(raw[end] or b"")
                    end += 1
                sets = shingle_sets(raw[start:end], k, words)
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                keys = band_keys(superminhash(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets)))[sizes > 0]
                digests = np.frombuffer(b"".join(xxh3_128_digest(s.tobytes()) for s in sets), dtype=np.int64).reshape(-1, 2)
                offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[start:end], pa.array(sizes), pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy()), long_array(offsets, keys.reshape(-1))],
                    names=["doc_id", "n_shingles", "d1", "d2", "bands"],
                )
                start = end

    return texts(docs).mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>")


def full_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(doc_id, shingles) of the documents in ids (doc_id)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        words = WordHashes()
        for batch in batches:
            sets = shingle_sets(batch.column(1).cast(pa.binary()).to_pylist(), k, words)
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            yield pa.RecordBatch.from_arrays([batch.column(0), long_array(offsets, np.concatenate(sets) if sets else np.empty(0, U64))], names=["doc_id", "shingles"])

    ids = ids.select(F.col("doc_id").alias("__id")).hint("shuffle_hash")
    wanted = texts(docs).join(ids, F.col("doc_id") == F.col("__id"), "left_semi")
    return wanted.mapInArrow(run, "doc_id long, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union.

    b is a hub of any number of pairs: these are dealt over salts of about HUB_PAIRS pairs, and b's set goes to each of its
    salts, so that no task gets the sets of all that meet one hub.
    """
    salts = pairs.groupBy("b").agg(F.ceil(F.count("*") / HUB_PAIRS).alias("salts"))
    dealt = pairs.join(salts, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("salts")).alias("salt"))
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("s"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("t")).join(salts, "b").select("b", "t", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    both = dealt.join(one, "a").join(two, ["b", "salt"]).withColumn("common", F.size(F.array_intersect("s", "t")))
    return both.where(F.col("common") * (100 + percent) >= percent * (F.size("s") + F.size("t"))).select("a", "b")


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """members (key, doc_id, n) with the component of each document so far; saved."""
    found = connected_components(links).select(F.col("node").alias("doc_id"), "component")
    return saved(members.join(found, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id")), "members")


def _unresolved(members: DataFrame) -> DataFrame:
    """(key, main, main_hub, size, outside) of buckets that hold several components; main is the largest, main_hub a member of it."""
    parts = members.groupBy("key", "component").agg(F.count("*").alias("c"), F.min_by(F.struct("doc_id", "n"), F.xxhash64("doc_id", "key")).alias("hub"))
    whole = parts.groupBy("key").agg(F.max(F.struct("c", F.col("component").alias("main"), "hub")).alias("top"), F.sum("c").alias("size"), F.count("*").alias("parts"))
    return whole.where("parts > 1").select("key", "top.main", F.col("top.hub").alias("main_hub"), "size", (F.col("size") - F.col("top.c")).alias("outside"))


def _near(n, m, percent: int):
    """Whether sizes n and m allow the similarity at all."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _blocks(members: DataFrame, open_buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between documents outside the main component of their bucket and the whole bucket, block by block."""
    joined = members.join(open_buckets, "key").join(sets, "doc_id")
    joined = joined.withColumn("nl", F.ceil(F.col("outside") / BLOCK)).withColumn("nr", F.ceil(F.col("size") / BLOCK))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(2**40))
    cols = ["key", "i", "j", "doc_id", "component", "shingles"]
    left = joined.where("component <> main").withColumn("i", block % F.col("nl")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nr") - 1))).select(*cols)
    right = joined.withColumn("j", block % F.col("nr")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("nl") - 1))).select(*[F.col(c).alias(f"r_{c}") for c in cols])

    def compare(left, right):
        import pyarrow as pa

        xs: list[int] = []
        ys: list[int] = []
        if left.num_rows and right.num_rows:
            ids = [left["doc_id"].to_numpy(), right["r_doc_id"].to_numpy()]
            groups = [left["component"].to_numpy(), right["r_component"].to_numpy()]
            lists = [left["shingles"].combine_chunks(), right["r_shingles"].combine_chunks()]
            flat = [x.flatten().to_numpy() for x in lists]
            sizes = [x.value_lengths().to_numpy().astype(np.int64) for x in lists]
            common = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
            shared = np.zeros((len(ids[0]), len(ids[1])), dtype=np.float32)
            for lo in range(0, len(common), 8192):  # columns of the incidence matrices taken at a time
                part, sides = common[lo : lo + 8192], []
                for f, s in zip(flat, sizes):
                    at = np.searchsorted(part, f)
                    at[at == len(part)] = 0
                    hit = part[at] == f
                    m = np.zeros((len(s), len(part)), dtype=np.float32)
                    m[np.repeat(np.arange(len(s)), s)[hit], at[hit]] = 1
                    sides.append(m)
                shared += sides[0] @ sides[1].T
            ok = shared.astype(np.int64) * (100 + percent) >= percent * (sizes[0][:, None] + sizes[1][None, :])
            ok &= groups[0][:, None] != groups[1][None, :]
            a, b = np.nonzero(ok)
            ys, xs = union_find(ids[0][a].tolist(), ids[1][b].tolist())
        return pa.table({"a": pa.array(xs, pa.int64()), "b": pa.array(ys, pa.int64())})

    return left.groupBy("key", "i", "j").cogroup(right.groupBy("r_key", "r_i", "r_j")).applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id, kept.

    Links documents whose sets of k-word shingles have 100 * intersection >= percent * union (percent 80 or more: the
    bands are made for it); with fewer than k words the whole sequence is the one shingle. component_id is the
    smallest doc_id reachable. Null or wordless text: empty set, linked with nothing. Null doc_id: linked with nothing,
    component_id null, kept. Rows that share a doc_id are one document, linked by the text of any of them. Texts are
    taken whole; other columns play no part; an empty table gives an empty table.
    """
    sig = saved(signatures(docs, k), "signatures")
    rows = sig.where("doc_id is not null and n_shingles > 0")
    classes = saved(rows.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = rows.join(classes.select(F.col("rep").alias("doc_id"), F.col("d1").alias("e1"), F.col("d2").alias("e2")), "doc_id").where("d1 = e1 and d2 = e2")
    buckets = reps.select(F.explode("bands").alias("key"), "doc_id", F.col("n_shingles").alias("n"))
    shared = buckets.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.min_by("n", "doc_id").alias("lo_n")).where("lo < hi").drop("hi")
    first = saved(buckets.join(shared, "key"), "buckets")
    sets = saved(full_sets(docs, first.select("doc_id").distinct(), k), "sets")
    members = first.select("key", "doc_id", "n").distinct()

    pairs = first.where("doc_id <> lo").where(_near(F.col("n"), F.col("lo_n"), percent)).select(F.col("doc_id").alias("a"), F.col("lo").alias("b")).distinct()
    links = saved(verified(pairs, sets, percent), "links")
    members = _labelled(members, links)
    hubs = _unresolved(members)
    pairs = members.join(hubs, "key").where("component <> main").where(_near(F.col("n"), F.col("main_hub.n"), percent))
    pairs = pairs.select(F.col("doc_id").alias("a"), F.col("main_hub.doc_id").alias("b")).distinct()
    links = saved(links.unionByName(verified(pairs, sets, percent)), "links")
    members = _labelled(members.drop("component"), links)
    links = links.unionByName(_blocks(members, saved(_unresolved(members), "open"), sets, percent))
    # A doc_id of several texts links their classes.
    several = rows.groupBy("doc_id").agg(F.min(F.struct("d1", "d2")).alias("lo"), F.max(F.struct("d1", "d2")).alias("hi")).where("lo <> hi").select("doc_id")
    same = rows.select("doc_id", "d1", "d2").join(several, "doc_id").join(classes, ["d1", "d2"]).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    links = saved(links.unionByName(same), "links")

    found = connected_components(links).select(F.col("node").alias("rep"), "component")
    of_class = classes.join(found, "rep", "left").select("d1", "d2", F.coalesce("component", "rep").alias("c"))
    same = sig.join(of_class, ["d1", "d2"], "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("c")).otherwise(F.col("doc_id")).alias("c"))
    out = same.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("c")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents that are the smallest of their component, with all their columns whatever their names."""
    docs, opened = sealed(docs)
    gone = near_duplicates(docs, k, percent).where("not kept").select(F.col("doc_id").alias("__id")).distinct().hint("shuffle_hash")
    return opened(docs.join(gone, docs["doc_id"].cast("long") == gone["__id"], "left_anti"))
