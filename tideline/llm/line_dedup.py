"""Operator 10, line dedup: sharded cuckoo filters in front of exact reference-count tables.

A line's key is the line stripped of ASCII white space, A-Z in lower case. State, each a log that is only appended to:

- `postings` (doc_id, h1, h2, generation, present): which document holds which key (128-bit hash of the key); deleting
  a document appends its postings with present = false, so everything is reversible.
- `counts` (h1, h2, n_docs, owner, generation): the reference counts of all keys: the documents holding each, and the smallest
  of them, the owner.
- `filters` (shard, n_buckets, slots): a cuckoo filter for each shard of keys, over the keys that at least two
  documents share. A key whose count reaches two is inserted into its shard's filter, one that falls back to one is
  deleted from it; filters of other shards are left alone.

The row of the latest generation holds. An insert or delete counts the keys of its own documents only, looks these up in
the tables (a semi-join by key), and writes new rows for them alone.

A line is first looked up in its shard's filter. Most lines are nobody else's and end there; only the rest are joined
with the exact table, which decides. A filter has false positives but no false negatives, so results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved, sealed, texts, without

KEYS = "doc_id long, h1 long, h2 long"
#: Keys of a shard, about: a filter has some 2 * 4 / 3 bytes for each.
SHARD_KEYS = 50_000
#: Rows looked up together with one copy of a filter, about, and the least number of such groups.
GROUP_ROWS, MIN_GROUPS = 50_000, 128


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key has two buckets, found from each other by the fingerprint."""

    def __init__(self, n_buckets: int, slots: np.ndarray | None = None):
        self.n = n_buckets
        self.slots = np.zeros((n_buckets, 4), dtype=np.uint16) if slots is None else slots

    @classmethod
    def of(cls, h1: np.ndarray, h2: np.ndarray) -> CuckooFilter:
        n = 1 << max(2, int(np.ceil(np.log2(max(1, len(h1)) / 3))))
        while True:
            f = cls(n)
            if all(map(f.insert, h1.tolist(), h2.tolist())):
                return f
            n *= 2

    @classmethod
    def read(cls, n_buckets: int, data: bytes) -> CuckooFilter:
        return cls(n_buckets, np.frombuffer(data, dtype=np.uint16).reshape(n_buckets, 4).copy())

    def bytes(self) -> bytes:
        return self.slots.tobytes()

    def _place(self, h1: int, h2: int) -> tuple[int, int]:
        return h2 & (self.n - 1), ((h2 >> 40) & 0xFFFF) or 1

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995) & (self.n - 1))

    def insert(self, h1: int, h2: int) -> bool:
        """False if no room was found after 500 moves: the caller takes a larger filter."""
        b, mark = self._place(h1, h2)
        slots = self.slots
        for at in (b, self._other(b, mark)):
            for i in range(4):
                if not slots[at, i]:
                    slots[at, i] = mark
                    return True
        at = b
        for step in range(500):
            i = (mark + step) & 3
            mark, slots[at, i] = int(slots[at, i]), mark
            at = self._other(at, mark)
            for i in range(4):
                if not slots[at, i]:
                    slots[at, i] = mark
                    return True
        return False

    def delete(self, h1: int, h2: int) -> bool:
        b, mark = self._place(h1, h2)
        for at in (b, self._other(b, mark)):
            for i in range(4):
                if self.slots[at, i] == mark:
                    self.slots[at, i] = 0
                    return True
        return False

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        b = h2 & np.int64(self.n - 1)
        mark = (h2 >> np.int64(40)) & np.int64(0xFFFF)
        mark[mark == 0] = 1
        other = b ^ ((mark * np.int64(0x5BD1E995)) & np.int64(self.n - 1))
        return (self.slots[b] == mark[:, None]).any(1) | (self.slots[other] == mark[:, None]).any(1)


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key, or None if it has fewer than min_chars code points."""
    key = line.strip().lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return key


def line_keys(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(doc_id, h1, h2): the distinct line keys of each document."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        for batch in batches:
            ids, found, counts = batch.column(0).to_numpy(zero_copy_only=False), [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                own = {xxh3_128_digest(k) for line in (text or b"").split(b"\n") if (k := line_key(line, min_chars)) is not None}
                counts.append(len(own))
                found.extend(own)
            both = np.frombuffer(b"".join(found), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, counts)), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["doc_id", "h1", "h2"])

    return texts(docs).where("doc_id is not null").mapInArrow(run, KEYS)


def count_keys(postings: DataFrame) -> DataFrame:
    """Per key the documents holding it and the smallest of them; counted before the shuffle, so common lines don't gather."""
    return postings.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("owner"))


def build_filters(shared: DataFrame, n_shards: int) -> DataFrame:
    """(shard, n_buckets, slots): a cuckoo filter of the keys of each shard."""

    def build(table):
        import pyarrow as pa

        f = CuckooFilter.of(table["h1"].to_numpy(), table["h2"].to_numpy())
        return pa.table({"shard": table["shard"][:1], "n_buckets": pa.array([f.n], pa.int64()), "slots": pa.array([f.bytes()], pa.binary())})

    return shared.select(F.expr(f"pmod(h1, {n_shards})").alias("shard"), "h1", "h2").groupBy("shard").applyInArrow(build, "shard long, n_buckets long, slots binary")


def _probe(postings: DataFrame, filters: DataFrame, n_shards: int, n_rows: int) -> DataFrame:
    """The postings whose key is in its shard's filter. Rows of a shard are dealt over salts by document, each with a copy of the filter."""
    salts = max(1, -(-max(n_rows // GROUP_ROWS, MIN_GROUPS) // n_shards))

    def probe(key, left, right):
        f = CuckooFilter.read(right["n_buckets"][0].as_py(), right["slots"][0].as_py()) if right.num_rows else None
        hit = f.has(left["h1"].to_numpy(), left["h2"].to_numpy()) if f and left.num_rows else np.zeros(left.num_rows, dtype=bool)
        return left.select(["doc_id", "h1", "h2"]).filter(hit)

    rows = postings.select("doc_id", "h1", "h2", F.expr(f"pmod(h1, {n_shards})").alias("shard"), F.expr(f"pmod(xxhash64(doc_id), {salts})").alias("salt"))
    copies = filters.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    return rows.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt")).applyInArrow(probe, KEYS)


@dataclass
class LineState:
    """The tables described above, each a DataFrame over written Parquet; generation is the latest."""

    postings: DataFrame
    counts: DataFrame
    filters: DataFrame
    n_shards: int
    n_rows: int
    generation: int = 0

    def live_postings(self, log: DataFrame | None = None) -> DataFrame:
        """(doc_id, h1, h2) that hold now; log: some of the postings."""
        log = self.postings if log is None else log
        if not self.generation:
            return log.select("doc_id", "h1", "h2")
        last = log.groupBy("doc_id", "h1", "h2").agg(F.max_by("present", "generation").alias("present"))
        return last.where("present").drop("present")

    def live_counts(self, log: DataFrame | None = None) -> DataFrame:
        """(h1, h2, n_docs, owner) that hold now; log: some of the counts."""
        log = self.counts if log is None else log
        if not self.generation:
            return log.select("h1", "h2", "n_docs", "owner")
        last = log.groupBy("h1", "h2").agg(F.max_by(F.struct("n_docs", "owner"), "generation").alias("x"))
        return last.select("h1", "h2", "x.n_docs", "x.owner").where("n_docs > 0")


def _keys_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """line_keys, saved, each key once for a doc_id, also where several rows have that doc_id."""
    keys = line_keys(docs, min_chars)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    if not ids.groupBy("doc_id").count().where("count > 1").isEmpty():
        keys = keys.distinct()
    return saved(keys, "keys")


def _generation(postings: DataFrame, n: int, present: bool = True) -> DataFrame:
    return postings.select("doc_id", "h1", "h2", F.lit(n).alias("generation"), F.lit(present).alias("present"))


def build_state(docs: DataFrame, min_chars: int = 10) -> LineState:
    """State over a whole table. Rows with a null doc_id take no part; several rows of one doc_id count as one document."""
    keys = _keys_of(docs, min_chars)
    counts = saved(count_keys(keys).withColumn("generation", F.lit(0)), "counts")
    shared = counts.where("n_docs > 1")
    n_shards = max(1, -(-shared.count() // SHARD_KEYS))
    return LineState(_generation(keys, 0), counts, saved(build_filters(shared, n_shards), "filters"), n_shards, keys.count())


def insert(state: LineState, docs: DataFrame, min_chars: int = 10) -> LineState:
    """State with more documents. Lines that a document of the same doc_id holds already change nothing."""
    keys = _keys_of(docs, min_chars)
    old = state.live_postings(state.postings.join(keys, ["doc_id", "h1", "h2"], "left_semi"))
    fresh = saved(keys.join(old, ["doc_id", "h1", "h2"], "left_anti"), "fresh")
    delta = saved(count_keys(fresh), "delta")
    before = state.live_counts(state.counts.join(delta, ["h1", "h2"], "left_semi")).withColumnsRenamed({"n_docs": "had", "owner": "first"})
    both = delta.join(before, ["h1", "h2"], "left").withColumn("had", F.coalesce("had", F.lit(0)))
    after = both.select("h1", "h2", "had", (F.col("had") + F.col("n_docs")).alias("n_docs"), F.least("owner", "first").alias("owner"))
    return _moved(state, fresh, True, after)


def delete(state: LineState, doc_ids: DataFrame) -> LineState:
    """State without the documents of doc_ids (doc_id): the reverse of insert."""
    ids = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    gone = saved(state.live_postings(state.postings.join(ids, "doc_id", "left_semi")), "gone")
    delta = saved(gone.select("h1", "h2").distinct(), "delta")
    before = state.live_counts(state.counts.join(delta, ["h1", "h2"], "left_semi")).select("h1", "h2", F.col("n_docs").alias("had"))
    rest = state.live_postings(state.postings.join(delta, ["h1", "h2"], "left_semi")).join(ids, "doc_id", "left_anti")
    after = before.join(count_keys(rest), ["h1", "h2"], "left").withColumn("n_docs", F.coalesce("n_docs", F.lit(0)))
    return _moved(state, gone, False, after)


def _moved(state: LineState, postings: DataFrame, present: bool, after: DataFrame) -> LineState:
    """State with postings that come or go, and the counts (h1, h2, had, n_docs, owner) of their keys."""
    now, n = state.generation + 1, state.n_shards
    after = saved(after.withColumn("generation", F.lit(now)), "counts")
    shard = F.expr(f"pmod(h1, {n})").alias("shard")
    moves = after.where("(had > 1) <> (n_docs > 1)").select(shard, "h1", "h2", (F.col("n_docs") > 1).alias("add"))
    moved = saved(moves, "moves")
    touched = moved.select("shard").distinct()
    out = LineState(
        state.postings.unionByName(_generation(postings, now, present)), state.counts.unionByName(after.drop("had").select(*state.counts.columns)), state.filters, n, state.n_rows + postings.count(), now
    )

    def change(key, left, right):
        import pyarrow as pa

        rows, done = right.to_pydict(), False
        if left.num_rows:
            f = CuckooFilter.read(left["n_buckets"][0].as_py(), left["slots"][0].as_py())
            done = all([f.delete(a, b) for a, b, add in zip(rows["h1"], rows["h2"], rows["add"]) if not add]) and all(f.insert(a, b) for a, b, add in zip(rows["h1"], rows["h2"], rows["add"]) if add)
        slots = f.bytes() if done else None  # no room: built anew below
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "n_buckets": pa.array([f.n if done else 0], pa.int64()), "slots": pa.array([slots], pa.binary())})

    own = state.filters.join(touched, "shard", "left_semi")
    tried = saved(own.groupBy("shard").cogroup(moved.groupBy("shard")).applyInArrow(change, "shard long, n_buckets long, slots binary"), "tried")
    full = tried.where("slots is null").select("shard")
    again = out.live_counts(out.counts.withColumn("shard", shard).join(full, "shard", "left_semi").drop("shard")).where("n_docs > 1")
    changed = tried.where("slots is not null").unionByName(build_filters(again, n))
    out.filters = saved(state.filters.join(touched, "shard", "left_anti").select("shard", "n_buckets", "slots").unionByName(changed), "filters")
    return out


def compacted(state: LineState) -> LineState:
    """The same state in tables of one generation, for when the logs have grown."""
    postings, counts = saved(_generation(state.live_postings(), 0), "postings"), saved(state.live_counts().withColumn("generation", F.lit(0)), "counts")
    return LineState(postings, counts, state.filters, state.n_shards, postings.count())


def dropped_keys(state: LineState) -> DataFrame:
    """(doc_id, keys): for each document that loses lines, the keys it loses, as h1, h2, h1, h2, ..."""
    maybe = _probe(state.live_postings(), state.filters, state.n_shards, state.n_rows)
    lost = maybe.join(state.live_counts().where("n_docs > 1").select("h1", "h2", "owner"), ["h1", "h2"]).where("doc_id > owner")
    return lost.groupBy("doc_id").agg(F.flatten(F.collect_list(F.array("h1", "h2"))).alias("__lost"))


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """docs with their text without repeated lines, and n_lines (before) and n_dropped.

    Keys of at least min_chars code points found in two documents or more lose all their lines except in the smallest
    doc_id. Null text: one empty line, and the text becomes empty; a null doc_id: the row takes no part and stays whole;
    repeated rows of one doc_id are one document, each row keeps or loses the same lines; a long text is one row
    throughout; an empty table gives an empty table. Columns n_lines and n_dropped of docs are replaced, others kept.
    """
    lost = dropped_keys(build_state(docs, min_chars))
    docs, opened = sealed(without(docs, "n_lines", "n_dropped"))
    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    lost = lost.withColumnRenamed("doc_id", "__id").hint("shuffle_hash")
    joined = docs.join(lost, docs["doc_id"].cast("long") == lost["__id"], "left").drop("__id")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        for batch in batches:
            at = next(i for i, n in enumerate(batch.schema.names) if n.lower() == "text")
            lists, out, counts, drops = batch.column(batch.num_columns - 1), [], [], []
            for row, text in enumerate(batch.column(at).cast(pa.binary()).to_pylist()):
                text = text or b""
                if not lists[row].is_valid:
                    out.append(text)
                    counts.append(text.count(b"\n") + 1)
                    drops.append(0)
                    continue
                keys = lists[row].values.to_numpy().tobytes()
                gone = {keys[i : i + 16] for i in range(0, len(keys), 16)}
                lines = text.split(b"\n")
                kept = [x for x in lines if (k := line_key(x, min_chars)) is None or xxh3_128_digest(k) not in gone]
                out.append(b"\n".join(kept))
                counts.append(len(lines))
                drops.append(len(lines) - len(kept))
            cols = [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(drops, pa.int64())]
            cols[at] = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names[:-1], "n_lines", "n_dropped"])

    return opened(joined.mapInArrow(run, schema), "n_lines", "n_dropped")
