"""Operator 8, best-fit packing by minimum bin slack.

Documents become token ids, an end id is added, and only longer ones are cut into pieces of the full length. Pieces are
dealt by a hash into groups of some thousands, each packed by one task: the longest piece left opens a sequence, and a
subset-sum dynamic program over the lengths left (a bitset of reachable sums) finds the fullest way to fill the
rest, which is then removed. A group wastes one partly filled sequence at most, about one in three thousand.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, texts
from .pretokens import pretoken_ids

#: Pieces that one task packs together, about.
GROUP_PIECES = 4096
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def tokenized(docs: DataFrame, path: str, length: int, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents; ids (little-endian uint32) is null without with_ids."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        words, end = pretoken_ids(path, lower=True), int(end_id).to_bytes(4, "little")
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = words.of(text or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    out.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 6, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return texts(docs).mapInArrow(run, PIECES)


def fullest(counts: np.ndarray, lengths: list[int], room: int) -> list[int]:
    """Lengths, at most counts[l] of each l, with the largest sum within room. lengths: those available, longest first."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    goal = 1 << room
    for n in lengths:
        if n > room:
            continue
        for _ in range(min(int(counts[n]), room // n)):
            grown = (reach | (reach << n)) & mask
            if grown == reach:
                break
            steps.append((n, reach))
            reach = grown
            if reach & goal:
                break
        if reach & goal:
            break
    total, taken = reach.bit_length() - 1, []
    for n, before in reversed(steps):
        if not (before >> total) & 1:
            taken.append(n)
            total -= n
    return taken


def pack(lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For pieces of the given lengths (1..length): each one's bin, numbered from 0, and its offset there."""
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    counts = np.bincount(lengths, minlength=length + 1)
    stacks = {n: [] for n in range(length + 1) if counts[n]}
    for i in order.tolist()[::-1]:
        stacks[int(lengths[i])].append(i)
    left, at = sorted(stacks, reverse=True), 0
    while left:
        longest = left[0]
        counts[longest] -= 1
        filled = 0
        for n in [longest, *fullest(counts, left, length - longest)]:
            if n != longest or filled:
                counts[n] -= 1
            i = stacks[n].pop()
            bins[i], offsets[i] = at, filled
            filled += n
        at += 1
        left = [n for n in left if counts[n]]
    return bins, offsets


def pack_documents(docs: DataFrame, path: str, length: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset.

    Null and empty texts are the end id alone. Rows that share a doc_id, or have none, are packed each for itself.
    Groups are dealt by a piece and its place in the written pieces, so repeated rows spread too. A very long text is cut where its pieces end. Other columns play no part; an empty table gives an empty table.
    """
    pieces = saved(tokenized(docs, path, length, end_id, with_ids), "pieces")
    groups = max(1, -(-pieces.count() // GROUP_PIECES))

    def run(key, table):
        import pyarrow as pa

        bins, offsets = pack(table["length"].to_numpy(), length)
        base = np.int64(key[0].as_py()) << np.int64(32)
        return table.drop_columns(["group"]).append_column("sequence_id", pa.array(base + bins)).append_column("offset", pa.array(offsets))

    grouped = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups))).groupBy("group")
    return grouped.applyInArrow(run, f"{PIECES}, sequence_id long, offset long")
