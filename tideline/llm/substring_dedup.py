"""Operator 3, repeated substrings: a compressed FM-index for each shard of the corpus, searched backward.

A window is `depth` consecutive words. Its anchor is the smallest of the hashes of its `gram`-word runs, so equal
windows have equal anchors, and neighbouring windows mostly share theirs. Windows are routed by their anchor, those of an
anchor found at more than `split` places by the hash of all their words: equal windows have equal routes, and no route
gathers more than `split` places of different windows. Steps:

1. anchors are counted over all documents; one found at a single place can't belong to a repeated window;
2. runs of windows with one route become segments; equal segments are counted. A segment that is its route's only window
   and is found once can't repeat, and goes before its words move;
3. each segment is sent once, with its words and its count, to the shard of its route;
4. each shard builds a compressed FM-index of its segments (a wavelet tree over the Burrows-Wheeler transform, and a bit
   for each suffix that differs from the one before within `depth` words), streams segments through it from their ends by
   backward search, and reports the windows whose interval at full depth holds more than one place;
5. the reports go back to all documents holding the segment, and the words they cover are cut. With keep_first, equal
   windows (which meet in one shard, and have one interval there) are reported but for the first of their places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, WordHashes, saved, sealed, shingle_hashes
from .fm_index import FMIndex

#: Segments of a shard, about, and the least number of shards.
SHARD_SEGMENTS, MIN_SHARDS = 8000, 64
_PLACE = 24  # bits of an anchor's key that hold its place, so that ties go to the left


def anchors(words: np.ndarray, depth: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of depth word hashes: its anchor's hash, and the anchor's place."""
    hashes = shingle_hashes(words, gram)
    place_mask = U64((1 << _PLACE) - 1)
    keys = (hashes & ~place_mask) | (np.arange(len(hashes), dtype=U64) & place_mask)
    width, size, low = depth - gram + 1, 1, keys
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    n = len(keys) - width + 1
    low = np.minimum(low[:n], low[width - size : width - size + n])
    starts = np.arange(n)
    place = starts + (((low & place_mask).astype(np.int64) - starts) % (1 << _PLACE))
    return hashes[place].view(np.int64), place


def anchor_counts(docs: DataFrame, depth: int, gram: int) -> DataFrame:
    """(anchor, doc, mark, places): the anchors of each document (doc, mark, text) and at how many places each stands there."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        words = WordHashes()
        for batch in batches:
            keys, out, counts = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(2)], [], []
            sizes = []
            for text in batch.column(2).cast(pa.binary()).to_pylist():
                w = (text or b"").split()
                if len(w) < depth:
                    sizes.append(0)
                    continue
                hashes, places = anchors(words.of(w), depth, gram)
                first = np.concatenate([[True], places[1:] != places[:-1]])
                found, n = np.unique(hashes[first], return_counts=True)
                out.append(found)
                counts.append(n)
                sizes.append(len(found))
            flat = np.concatenate(out) if out else np.empty(0, dtype=np.int64)
            n = np.concatenate(counts) if counts else np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat), *[pa.array(np.repeat(k, sizes)) for k in keys], pa.array(n.astype(np.int32))], names=["anchor", "doc", "mark", "places"])

    return docs.mapInArrow(run, "anchor long, doc long, mark long, places int")


def segment_refs(docs: DataFrame, depth: int, gram: int) -> DataFrame:
    """Segments of documents (doc, mark, text, anchors, heavy, copies): the place of each, its digest, route, number of windows,
    whether it is all of its route, and in how many copies its document is there."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        words = WordHashes()
        for batch in batches:
            rows, digests = [], []
            for doc, mark, text, known, heavy, copies in zip(*[batch.column(i) for i in range(6)]):
                w = words.of((text.as_py() or "").encode().split())
                if len(w) < depth:
                    continue
                hashes, _ = anchors(w, depth, gram)
                known = np.sort(known.values.to_numpy())
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                live = known[at] == hashes
                route, alone = hashes, np.zeros(len(hashes), dtype=bool)
                if len(heavy := heavy.values.to_numpy()):
                    alone = np.isin(hashes, heavy)
                    route = np.where(alone, shingle_hashes(w, depth).view(np.int64), hashes)
                starts = np.flatnonzero(np.concatenate([[True], route[1:] != route[:-1]]) | alone)
                ends = np.append(starts[1:], len(hashes))
                doc, mark, copies = doc.as_py(), mark.as_py(), copies.as_py()
                for s, e in zip(starts[live[starts]].tolist(), ends[live[starts]].tolist()):
                    digests.append(xxh3_128_digest(w[s : e + depth - 1].tobytes()))
                    rows.append((doc, mark, s, e - s, int(route[s]), bool(alone[s]), copies))
            both = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
            cols = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["doc", "mark", "at", "windows", "route", "alone", "copies", "d1", "d2"])

    return docs.mapInArrow(run, "doc long, mark long, at long, windows int, route long, alone boolean, copies long, d1 long, d2 long")


def segment_words(docs: DataFrame, depth: int) -> DataFrame:
    """The words of segments and their first places: docs (doc, mark, text, list of (d1, d2, route, n, at, windows))."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = []
            for doc, mark, text, wanted in zip(*[batch.column(i).to_pylist() for i in range(2)], batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist()):
                w = (text or b"").split()
                rows += [(x["d1"], x["d2"], x["route"], x["n"], doc, mark, x["at"], b" ".join(w[x["at"] : x["at"] + x["windows"] + depth - 1])) for x in wanted]
            kinds = (*[pa.int64()] * 7, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 8, kinds)], names=["d1", "d2", "route", "n", "doc0", "mark0", "at0", "words"])

    return docs.mapInArrow(run, "d1 long, d2 long, route long, n long, doc0 long, mark0 long, at0 long, words binary")


def _runs(marked: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of marked places as start, end, start, end, ... within their segments, and up to where they reach for each segment."""
    edges = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    up, down = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    owner = np.searchsorted(ends, up)
    pairs = np.stack([up - starts[owner], down - starts[owner]], axis=1).astype(np.int32)
    return pairs.reshape(-1), np.concatenate([[0], 2 * np.cumsum(np.bincount(owner, minlength=len(ends)))]).astype(np.int32)


def search_shard(table, depth: int, keep_first: bool = False):
    """The segments of a shard that hold repeated windows, and where: start, end, start, end, ... of runs of windows.

    With keep_first, also the runs for the segment's first place (doc0, mark0, at0), without the windows found first there."""
    import pyarrow as pa

    ids: dict[bytes, int] = {}
    texts, sizes = [], []
    for words in table["words"].to_pylist():
        own = [ids.setdefault(w, len(ids) + 1) for w in words.split(b" ")]
        sizes.append(len(own))
        texts += own
        texts.append(0)
    text, sizes = np.array(texts, dtype=np.int64), np.array(sizes, dtype=np.int64)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    index = FMIndex(text, np.repeat(table["n"].to_numpy(), sizes + 1), len(ids) + 1, depth)
    begins = (np.zeros(len(text), dtype=np.int64),) if keep_first else ()
    repeated = index.matches(text, starts, ends, *begins) > 1
    pairs, upto = _runs(repeated, starts, ends)
    hit = pa.array(np.flatnonzero(np.diff(upto)))
    columns = {"d1": table["d1"], "d2": table["d2"], "runs": pa.ListArray.from_arrays(pa.array(upto), pa.array(pairs))}
    if keep_first:
        at = np.flatnonzero(repeated)
        owner = np.searchsorted(ends, at)
        doc, mark, place = (table[c].to_numpy()[owner] for c in ("doc0", "mark0", "at0"))
        window = begins[0][at]
        order = np.lexsort((place + at - starts[owner], mark, doc, window))
        repeated[at[order[np.concatenate([[True], window[order][1:] != window[order][:-1]])[: len(at)]]]] = False
        pairs, upto = _runs(repeated, starts, ends)
        columns |= {c: table[c] for c in ("doc0", "mark0", "at0")} | {"first_runs": pa.ListArray.from_arrays(pa.array(upto), pa.array(pairs))}
    return pa.table(columns).take(hit)


def cut_words(words: list[bytes], starts: list[int], runs: list[list[int]], depth: int) -> list[bytes]:
    """The words that no reported window covers."""
    edge = np.zeros(len(words) + 1, dtype=np.int32)
    for start, pairs in zip(starts, runs):
        p = np.array(pairs, dtype=np.int64) + start
        np.add.at(edge, p[0::2], 1)
        np.add.at(edge, p[1::2] + depth - 1, -1)
    keep = np.cumsum(edge[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc, mark, text, doc_id): rows of one doc_id but other texts, and rows without one, are told apart by mark."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc"), _mark(doc_id, text).alias("mark"), text.alias("text"), doc_id.alias("doc_id"))


def _mark(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(text, doc_id.isNull())


def _once(keyed: DataFrame, depth: int) -> DataFrame:
    """keyed without rows whose document has stood in the same task before, where its text is long enough to hold a window:
    anchors tell how many there are of these. What is left of many copies are as many rows as tasks."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: set[tuple[int, int]] = set()
        for batch in batches:
            again = []
            for i, key in enumerate(zip(*[batch.column(i).to_pylist() for i in range(2)])):
                if key in seen and len((batch.column(2)[i].as_py() or "").encode().split()) >= depth:
                    again.append(i)
                seen.add(key)
            if again:
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[again] = False
                batch = batch.filter(pa.array(keep))
            yield batch

    return keyed.mapInArrow(run, keyed.schema)


def scanned(docs: DataFrame, depth: int, gram: int, split: int) -> DataFrame:
    """All documents, saved: doc, mark, doc_id, n_words, and either whole_sha256 (nothing can repeat; one row each) or text,
    anchors, heavy, copies (the first of rows alike in doc_id and text has their number, the others have 0 and no text)."""
    keyed = _keyed(docs)
    found = saved(anchor_counts(keyed.select("doc", "mark", "text"), depth, gram), "anchors")
    counts = found.groupBy("anchor").agg(F.sum("places").alias("n")).where("n > 1")
    lists = found.join(counts, "anchor").groupBy("doc", "mark").agg(F.collect_set("anchor").alias("anchors"), F.collect_set(F.when(F.col("n") > split, F.col("anchor"))).alias("heavy"), F.count("*").alias("rows"))
    # Each row of a document has brought each of its anchors once.
    lists = lists.select(F.col("doc").alias("__doc"), F.col("mark").alias("__mark"), "anchors", "heavy", F.expr("rows div size(anchors)").alias("copies"))
    # Dealt out by hand, so that no task has a part of a document's rows only.
    dealt = _once(keyed.select("doc", "mark", "text", "doc_id"), depth).repartition("doc", "mark")
    joined = dealt.select("doc", "mark", "doc_id", "text").join(lists.hint("shuffle_hash"), (F.col("doc") == F.col("__doc")) & (F.col("mark") == F.col("__mark")), "left").drop("__doc", "__mark")

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        names = ["doc", "mark", "doc_id", "n_words", "whole_sha256", "text", "anchors", "heavy", "copies"]
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            known, keep = batch.column(4).is_valid().to_pylist(), []
            for key, k in zip(zip(*[batch.column(i).to_pylist() for i in range(2)]), known):
                keep.append(not k or key not in seen)
                if k:
                    seen.add(key)
            again = batch.filter(pa.array([not k for k in keep], pa.bool_()))
            if again.num_rows:
                none, empty = pa.nulls(again.num_rows, pa.string()), pa.array([[]] * again.num_rows, again.column(4).type)
                n = pa.array([len(t.split()) for t in again.column(3).cast(pa.binary()).to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([*again.columns[:3], n, none, none, empty, empty, pa.array([0] * again.num_rows, pa.int64())], names=names)
            batch = batch.filter(pa.array(keep, pa.bool_()))
            texts, known = batch.column(3).cast(pa.binary()).to_pylist(), batch.column(4).is_valid().to_pylist()
            words = [t.split() for t in texts]
            n = pa.array([len(w) for w in words], pa.int64())
            sha = pa.array([None if k else hashlib.sha256(b" ".join(w)).hexdigest() for w, k in zip(words, known)], pa.string())
            text = pa.array([t if k else None for t, k in zip(texts, known)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], n, sha, text, *batch.columns[4:]], names=names)

    return saved(joined.mapInArrow(run, "doc long, mark long, doc_id long, n_words long, whole_sha256 string, text string, anchors array<long>, heavy array<long>, copies long"), "scanned")


def reports(scan: DataFrame, depth: int, gram: int, keep_first: bool = False) -> DataFrame:
    """(doc, mark, cuts): per document with repeats, its segments' places and the runs of repeated windows in them."""
    maybe = scan.where("text is not null")
    refs = saved(segment_refs(maybe.select("doc", "mark", "text", "anchors", "heavy", "copies"), depth, gram), "segments")
    counted = refs.groupBy("d1", "d2").agg(F.min(F.struct("doc", "mark", "at", "windows", "route", "alone")).alias("r"), F.sum("copies").alias("n")).where("n > 1 or not r.alone")
    wanted = counted.select("r.doc", "r.mark", F.struct("d1", "d2", "r.route", "n", "r.at", "r.windows").alias("x")).groupBy("doc", "mark").agg(F.collect_list("x").alias("wanted"))
    words = saved(segment_words(maybe.join(wanted, ["doc", "mark"]).select("doc", "mark", "text", "wanted"), depth), "words")
    shards = max(MIN_SHARDS, -(-words.count() // SHARD_SEGMENTS))
    dealt = words.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards)).cast("int")).drop("route")
    schema = "d1 long, d2 long, runs array<int>" + (", doc0 long, mark0 long, at0 long, first_runs array<int>" if keep_first else "")
    found = dealt.repartitionById(shards, "shard").groupBy("shard").applyInArrow(lambda t: search_shard(t, depth, keep_first), schema)
    hits = refs.join(found, ["d1", "d2"])
    if keep_first:
        at_first = (F.col("doc") == F.col("doc0")) & (F.col("mark") == F.col("mark0")) & (F.col("at") == F.col("at0"))
        hits = hits.withColumn("runs", F.when(at_first, F.col("first_runs")).otherwise(F.col("runs"))).where(F.size("runs") > 0)
    return hits.groupBy("doc", "mark").agg(F.collect_list(F.struct("at", "runs")).alias("cuts"))


def _cut(rows: DataFrame, depth: int) -> DataFrame:
    """rows (..., text, cuts) with text's kept words joined by a space, and n_removed in place of cuts; without cuts the text stays."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            at, texts, removed = batch.num_columns - 2, [], []
            for text, cuts in zip(batch.column(at).cast(pa.binary()).to_pylist(), batch.column(at + 1).to_pylist()):
                if cuts:
                    words = (text or b"").split()
                    kept = cut_words(words, [c["at"] for c in cuts], [c["runs"] for c in cuts], depth)
                    text = b" ".join(kept)
                texts.append(text)
                removed.append(len(words) - len(kept) if cuts else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(texts, pa.binary()).cast(pa.string()), pa.array(removed, pa.int64())], names=[*batch.schema.names[:at], "text", "n_removed"])

    schema = T.StructType([*rows.schema.fields[:-2], T.StructField("text", T.StringType()), T.StructField("n_removed", T.LongType())])
    return rows.mapInArrow(run, schema)


def _counted(rows: DataFrame, depth: int) -> DataFrame:
    """rows (doc_id, n_words, copies, text, cuts) with n_removed and kept_sha256 in place of text and cuts: the cuts of a batch are taken
    together, and only digests leave the task."""

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        for batch in batches:
            cuts = batch.column(4)
            of_doc = cuts.fill_null([]).offsets.to_numpy() if cuts.null_count else cuts.offsets.to_numpy()
            cuts = cuts.fill_null([]) if cuts.null_count else cuts
            at, runs = cuts.values.field("at").to_numpy(), cuts.values.field("runs")
            of_cut = runs.offsets.to_numpy()
            places = runs.values.to_numpy().astype(np.int64)
            places = places + np.repeat(at, np.diff(of_cut))[: len(places)] if len(places) else places
            removed, digests = [], []
            for i, text in enumerate(batch.column(3).cast(pa.binary()).to_pylist()):
                words = (text or b"").split()
                low, high = of_cut[of_doc[i]], of_cut[of_doc[i + 1]]
                n = len(words)
                if high > low:
                    pairs, edge = places[low:high], np.zeros(len(words) + 1, dtype=np.int32)
                    np.add.at(edge, pairs[0::2], 1)
                    np.add.at(edge, pairs[1::2] + depth - 1, -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                removed.append(n - len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(removed, pa.int64()), pa.array(digests, pa.string())], names=["doc_id", "n_words", "copies", "n_removed", "kept_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_words long, copies long, n_removed long, kept_sha256 string")


def count_removed(docs: DataFrame, depth: int = 35, gram: int = 16, split: int = 200) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space).

    A word goes if it lies in a window of `depth` words whose words stand, in that order, anywhere else as well. Null and
    empty texts have no words; a null doc_id is a document like others; repeated rows are documents of their own, so
    they repeat each other. Texts are taken whole; an empty table gives an empty table; other columns play no part. split
    changes no result, only how windows of frequent anchors are dealt out.
    """
    scan = scanned(docs, depth, gram, split)
    cuts = reports(scan, depth, gram)
    single = scan.where("whole_sha256 is not null").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("whole_sha256").alias("kept_sha256"))
    rows = scan.where("text is not null").select("doc", "mark", "doc_id", "n_words", "copies", "text").join(cuts, ["doc", "mark"], "left").select("doc_id", "n_words", "copies", "text", "cuts")
    several = _counted(rows, depth).select("doc_id", "n_words", "n_removed", "kept_sha256", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("col")
    return single.unionByName(several)


def remove_repeats(docs: DataFrame, depth: int = 35, gram: int = 16, split: int = 200, keep_first: bool = False) -> DataFrame:
    """docs with their repeated words cut. Texts that lose words have the rest joined by one space; others stay as they are.

    With keep_first a window stays at its first place, by doc_id (null: as 0), then by place in the text: a word goes if a window
    covering it also starts at an earlier place, so each cut word is left in some earlier text. Rows equal in doc_id and text are one
    place then. Null texts stay null; for the rest see count_removed.
    """
    cuts = reports(scanned(docs, depth, gram, split), depth, gram, keep_first).withColumnsRenamed({"doc": "__doc", "mark": "__mark", "cuts": "__cuts"})
    docs, opened = sealed(docs, new_text=True)
    doc, mark = F.coalesce(docs["doc_id"].cast("long"), F.lit(0)), _mark(docs["doc_id"].cast("long"), F.coalesce(docs["text"], F.lit("")))
    joined = docs.join(cuts.hint("shuffle_hash"), (doc == F.col("__doc")) & (mark == F.col("__mark")), "left")
    others = [c for c in docs.columns if c != "text"]
    return opened(_cut(joined.select(*others, "text", F.col("__cuts").alias("cuts")), depth))
