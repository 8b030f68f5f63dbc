"""Operator 9, SentencePiece encoding with seeded merge-dropout, and decoding.

Segmentation of a merge-type model: the characters of a text are merged pairwise, best score first and leftmost among
equals, as long as a pair makes a piece. With dropout each candidate merge that comes up is skipped if a hash keyed by
seed, doc_id, the unit's number in the text and span falls below the rate, so every occurrence of a word is drawn for
itself, and reproducibly. Characters that are no piece are written as bytes, as is a literal U+2581, so decoding gives
back every text.

Texts are taken apart into units no piece can cross: white space and what follows it, and line ends; a unit loses its last
character, mostly a mark, if no piece holds it behind the one before. What is remembered depends on no draw: for a part
and the candidates skipped in it, which merges come up from there and the ids if none of them is skipped. Only parts that
come a second time are remembered; the others, most of all different ones, are drawn for and merged in one go.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, mix64, without
from .context_tree import KeyTable

UNITS = re.compile(" +[^ \n▁]*|[^ \n▁]+|\n|▁")
_MASK = 2**64 - 1
NONE = float("-inf")
#: Parts shorter than this are remembered; a span is begin << 6 | length in them.
LONG = 64
#: What a span adds to the key of a unit, by span.
SPANS = np.arange(LONG * LONG, dtype=U64) // U64(LONG) * U64(0x9E3779B97F4A7C15) + np.arange(LONG * LONG, dtype=U64) % U64(LONG) * U64(0xC2B2AE3D27D4EB4F)
#: Of a unit that isn't remembered.
NEW = -1
LITERAL = "\ue000▁"  # stands for a U+2581 of the text, which is written as bytes; no text part is cut like this


def places(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each row, count of them, one row after the other."""
    return np.arange(count.sum()) + np.repeat(begin - np.cumsum(count) + count, count)


class PieceModel:
    """Pieces, scores and bytes of a merge-type SentencePiece model."""

    def __init__(self, path: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids, self.scores, self.bytes, self.byte_ids = {}, {}, [], {}
        for i in range(m.get_piece_size()):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
                self.bytes.append(b"")
            else:
                self.ids[piece], self.scores[piece] = i, m.get_score(i)
                self.bytes.append(piece.replace("▁", " ").encode())
        self.tables()
        self.pairs = {pair for piece in self.scores for pair in zip(piece, piece[1:])}

    def units(self, text: str) -> list[str]:
        """The text after its leading mark, in units; a space stands as itself."""
        return UNITS.findall(" " + text) if text else []

    def parts(self, unit: str) -> list[str]:
        """The unit, its last character cut off if no piece holds it behind the one before: no merge reaches across. A literal U+2581 is marked as such."""
        if unit == "▁":
            return [LITERAL]
        unit = unit.replace(" ", "▁")
        if len(unit) > 2 and (unit[-2], unit[-1]) not in self.pairs:
            return [unit[:-1], unit[-1]]
        return [unit]

    def segment(self, part: str, key: int, limit: int, skips: tuple | list = (), taken: list[int] | None = None) -> list[int]:
        """Ids of a part. key, limit: a candidate merge is skipped if its hash under key is below limit (0: never).

        skips: spans that are skipped as well. taken: gets the spans merged after the last skip.

        The agenda is a list of the scores of neighbouring pairs, None where they make no piece or were skipped; parts are
        a few characters long, so the best is found by looking at all.
        """
        if part == LITERAL:
            return [self.byte_ids[b] for b in "▁".encode()]
        if len(part) == 1:
            piece = self.ids.get(part)
            return [piece] if piece is not None else [self.byte_ids[b] for b in part.encode()]
        scores = self.scores
        bits, at = list(part), list(range(len(part)))
        agenda = [scores.get(a + b, NONE) for a, b in zip(part, part[1:])]
        while agenda:
            best = max(agenda)
            if best == NONE:
                break
            i = agenda.index(best)
            whole = bits[i] + bits[i + 1]
            if limit and ((((key ^ (at[i] * 0x9E3779B97F4A7C15 + len(whole) * 0xC2B2AE3D27D4EB4F)) * 0xBF58476D1CE4E5B9) & _MASK) >> 11) < limit or skips and at[i] << 6 | len(whole) in skips:
                agenda[i] = NONE
                if taken is not None:
                    taken.clear()
                continue
            if taken is not None:
                taken.append(at[i] << 6 | len(whole))
            bits[i] = whole
            del bits[i + 1], at[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = scores.get(whole + bits[i + 1], NONE)
            if i:
                agenda[i - 1] = scores.get(bits[i - 1] + whole, NONE)
        out = []
        for b in bits:
            piece = self.ids.get(b)
            out += [piece] if piece is not None else [self.byte_ids[x] for x in b.encode()]
        return out

    def tables(self) -> None:
        """Arrays for segment_many: symbols are pieces and their characters, pairs what two neighbouring symbols merge to."""
        symbols = {c: i for i, c in enumerate(dict.fromkeys([*self.scores, *(c for p in self.scores for c in p)]))}
        self.symbol_of = np.full(0x110000, -1, dtype=np.int32)
        for c, i in symbols.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = i
        self.piece_of = np.array([*(self.ids.get(c, -1) for c in symbols), -1], dtype=np.int64)
        found = {}
        for piece, score in self.scores.items():
            for cut in range(1, len(piece)):
                a, b = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if a is not None and b is not None:
                    found[a << 32 | b] = (symbols[piece], score)
        keys = np.array(sorted(found), dtype=U64)
        self.pair_table = KeyTable(keys)
        self.pair_symbol = np.array([found[k][0] for k in keys.tolist()] + [-1], dtype=np.int32)
        self.pair_score = np.array([found[k][1] for k in keys.tolist()] + [NONE], dtype=np.float32)

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged symbol and score of pairs; -1 and NONE where they make no piece."""
        at = self.pair_table.find((a.astype(np.int64).view(U64) << U64(32)) | (b.astype(np.int64).view(U64) & U64(0xFFFFFFFF)))
        at[(a < 0) | (b < 0)] = -1
        return self.pair_symbol[at], self.pair_score[at]

    def segment_many(self, parts: list[str], keys: np.ndarray, limit: int) -> list[bytes]:
        """segment() of many parts at once, a step of every agenda at a time; ids as little-endian uint32."""
        ids, counts = self.together(parts, keys, limit)
        return [x.astype("<u4").tobytes() for x in np.split(ids, np.cumsum(counts)[:-1])] if parts else []

    def follow(self, parts: list[str], skips: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of parts shorter than LONG, if the spans in a row of skips (0: none) are skipped and no others: ids one part after the other and their numbers, the numbers of merges after the last skip, and their spans one part after the other."""
        taken = np.zeros((len(parts), LONG + 1), dtype=np.uint16)  # the count, then spans
        ids, counts = self.together(parts, np.zeros(len(parts), dtype=U64), 0, skips, taken)
        return ids, counts, taken[:, 0].astype(np.int64), taken[:, 1:][np.arange(LONG) < taken[:, :1]]

    def together(self, parts: list[str], keys: np.ndarray, limit: int, skips: np.ndarray | None = None, taken: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of parts one after the other, and how many each has."""
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # rows, ids, numbers of ids
        single: list[int] = np.flatnonzero(sizes >= LONG).tolist()
        for low, high in ((1, 2), (2, 4), (4, 6), (6, 7), (7, 8), (8, 9), (9, 10), (10, 11), (11, 12), (12, 14), (14, 17), (17, 24), (24, LONG)):
            rows = np.flatnonzero((sizes >= low) & (sizes < high))
            if len(rows) < 150:  # not worth the arrays
                single += rows.tolist()
                continue
            for at in range(0, len(rows), 20_000):
                some = rows[at : at + 20_000]
                got.append((some, *self._segment_rows([parts[i] for i in some.tolist()], some, keys, limit, skips, taken)))
        own = []
        for i in single:
            spans: list[int] = []
            own.append(self.segment(parts[i], int(keys[i]), limit, () if skips is None else skips[i].tolist(), spans))
            if taken is not None:
                taken[i, : len(spans) + 1] = [len(spans), *spans]
        got.append((np.array(single, dtype=np.int64), np.array([x for ids in own for x in ids], dtype=np.int64), np.array([len(ids) for ids in own], dtype=np.int64)))
        counts = np.zeros(len(parts), dtype=np.int64)
        for rows, _, n in got:
            counts[rows] = n
        begins, out = np.cumsum(counts) - counts, np.zeros(counts.sum(), dtype=np.uint32)
        for rows, ids, n in got:
            out[places(begins[rows], n)] = ids
        return out, counts

    def _segment_rows(self, parts: list[str], rows: np.ndarray, keys: np.ndarray, limit: int, skips: np.ndarray | None, taken: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """A symbol stays at the place of its first character; -2 stands where none is, behind the last one too."""
        chars = np.array(parts)
        width = chars.dtype.itemsize // 4
        chars = chars.view(np.uint32).reshape(len(parts), width)
        n = np.array([len(p) for p in parts])
        sym = np.full((len(parts), width + 1), -2, dtype=np.int32)
        sym[:, :width] = np.where(np.arange(width) < n[:, None], self.symbol_of[chars], np.int32(-2))
        after = np.broadcast_to(np.arange(1, width + 2, dtype=np.int16), sym.shape).copy()
        before = np.broadcast_to(np.arange(-1, width, dtype=np.int16), sym.shape).copy()
        # Of a symbol and the one after it.
        score = np.full(sym.shape, NONE, dtype=np.float32)
        merged = np.full(sym.shape, -1, dtype=np.int32)
        m, s = self._pair(sym[:, :-1].reshape(-1), sym[:, 1:].reshape(-1))
        merged[:, :-1], score[:, :-1] = m.reshape(len(parts), -1), s.reshape(len(parts), -1)
        key = keys[rows] if skips is None else skips[rows]
        left = np.arange(len(parts))
        done = np.full_like(sym, -2)
        while True:
            line, i = np.arange(len(left)), score.argmax(1)
            live = score[line, i] > NONE
            if 2 * live.sum() < len(left):  # most rows are through: go on with the others only
                done[left[~live]] = sym[~live]
                left, sym, after, before, score, merged, key, i = (x[live] for x in (left, sym, after, before, score, merged, key, i))
                line, live = np.arange(len(left)), np.ones(len(left), dtype=bool)
                if not len(left):
                    break
            second = after[line, i]
            end = after[line, second]
            if skips is not None:
                span = (i << 6 | end - i).astype(np.uint16)
                skip = (key == span[:, None]).any(1) & live
                score[line[skip], i[skip]] = NONE
                live &= ~skip
                taken[rows[left[skip]], 0] = 0
                to = rows[left[live]]
                taken[to, 0] += 1
                taken[to, taken[to, 0]] = span[live]
            elif limit:
                mixed = (key ^ (i.astype(U64) * U64(0x9E3779B97F4A7C15) + (end - i).astype(U64) * U64(0xC2B2AE3D27D4EB4F))) * U64(0xBF58476D1CE4E5B9)
                skip = (mixed >> U64(11)) < U64(limit)
                score[line[skip], i[skip]] = NONE
                live &= ~skip
            go = np.flatnonzero(live)
            at, gone, then = i[go], second[go], end[go]
            whole, ahead = merged[go, at], before[go, at]  # ahead: -1, the last column, where no symbol is, for none
            sym[go, at], sym[go, gone], score[go, gone] = whole, -2, NONE
            after[go, at], before[go, then] = then, at
            m, s = self._pair(np.concatenate([sym[go, ahead], whole]), np.concatenate([whole, sym[go, then]]))
            merged[go, ahead], score[go, ahead] = m[: len(go)], s[: len(go)]
            merged[go, at], score[go, at] = m[len(go) :], s[len(go) :]
        there = done != -2
        counts, ids = there.sum(1), self.piece_of[done[there]]
        odd = np.unique(np.repeat(np.arange(len(parts)), counts)[ids < 0])
        if len(odd):  # characters that are no piece: as bytes
            each = np.split(ids, np.cumsum(counts)[:-1])
            for k in odd.tolist():
                each[k] = np.array(self.segment(parts[k], int(keys[rows[k]]), limit, () if skips is None else skips[rows[k]].tolist()))
                counts[k] = len(each[k])
            ids = np.concatenate(each)
        return ids, counts

    def decode(self, ids: list[int]) -> bytes:
        """The text's UTF-8 bytes: the leading mark goes."""
        return b"".join(map(self.bytes.__getitem__, ids))[1:]


class Column:
    """An array that rows are added to."""

    def __init__(self, dtype: type, *first: int):
        self.data, self.n = np.zeros(1024, dtype=dtype), 0
        self.add(np.array(first, dtype=dtype))

    def add(self, rows: np.ndarray) -> None:
        end = self.n + len(rows)
        if end > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(end, len(self.data)), dtype=self.data.dtype)])
        self.data[self.n : end] = rows
        self.n = end


class SegmentTree:
    """What becomes of parts, whatever is drawn: a node for a part and the candidates skipped in it so far.

    A node has the ids it comes to if no more is skipped, and an edge for each merge on the way there, to the node where
    that one is skipped. A part has nodes from its second time on, each made when first asked for; once there are `limit`
    nodes or units, or eight times as many ids, all is forgotten.
    """

    def __init__(self, model: PieceModel, limit: int = 1_200_000):
        self.model, self.limit = model, limit
        self._clear()

    def _clear(self) -> None:
        self.units: dict[str, int] = {}  # node of the last character cut off << 32 | node of the rest
        self.roots: dict[str, int] = {}
        self.once: set[str] = set()  # parts that came once
        self.text: dict[int, str] = {}
        self.long: dict[int, str] = {}
        # Node 0 has no ids. By node: where its ids and edges end, and the parent, root and span it was skipped at.
        self.ids, self.ids_end, self.edges_end = Column(np.uint32), Column(np.int64, 0, 0), Column(np.int64, 0, 0)
        self.parent, self.root, self.skipped = Column(np.int32, -1), Column(np.int32, 0), Column(np.uint16, 0)
        self.span, self.child = Column(np.uint16), Column(np.int32)

    def _add(self, ids: np.ndarray, counts: np.ndarray, edges: np.ndarray, spans: np.ndarray, parent: np.ndarray, root: np.ndarray | None, skipped: np.ndarray) -> np.ndarray:
        """New nodes; root: None if they are roots themselves."""
        new = np.arange(self.parent.n, self.parent.n + len(counts))
        self.ids_end.add(self.ids.n + np.cumsum(counts))
        self.ids.add(ids)
        self.edges_end.add(self.span.n + np.cumsum(edges))
        self.span.add(spans)
        self.child.add(np.full(len(spans), -1, dtype=np.int32))
        for column, rows in ((self.parent, parent), (self.root, new if root is None else root), (self.skipped, skipped)):
            column.add(rows)
        return new

    def _add_parts(self, parts: list[str]) -> None:
        for some, follow in (([p for p in parts if len(p) < LONG], True), ([p for p in parts if len(p) >= LONG], False)):
            if not some:
                continue
            none = np.zeros(len(some), dtype=np.int64)
            if follow:
                ids, counts, edges, spans = self.model.follow(some, np.zeros((len(some), 1), dtype=np.uint16))
            else:
                (ids, counts), edges, spans = self.model.together(some, none.astype(U64), 0), none, np.zeros(0, dtype=np.uint16)
            new = self._add(ids, counts, edges, spans, none - 1, None, none).tolist()
            self.roots.update(zip(some, new))
            (self.text if follow else self.long).update(zip(new, some))

    def _add_children(self, parents: np.ndarray, edges: np.ndarray) -> None:
        columns, at = [self.span.data[edges]], parents
        while (self.parent.data[at] >= 0).any():
            columns.append(self.skipped.data[at])  # 0 for roots
            at = np.where(self.parent.data[at] >= 0, self.parent.data[at], at)
        root = self.root.data[parents]
        ids, counts, merges, spans = self.model.follow([self.text[r] for r in root.tolist()], np.stack(columns, 1))
        self.child.data[edges] = self._add(ids, counts, merges, spans, parents, root, self.span.data[edges])

    def _nodes(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Nodes of units as in self.units; the rows whose part comes for the first time, with node 0 for it, and these parts."""
        found = np.array(list(map(self.units.get, units, repeat(NEW))), dtype=np.int64)
        rows = np.flatnonzero(found == NEW).tolist()
        if len(self.once) > self.limit // 4:
            self.once.clear()
        split: dict[str, list[str]] = {}
        fresh: dict[str, int] = {}  # rows of parts not met so far
        again: dict[str, None] = {}
        for r in rows:
            u = units[r]
            parts = split.get(u)
            if parts is None:
                parts = split[u] = self.model.parts(u)
                if len(parts) > 1 and parts[1] not in self.roots:
                    again[parts[1]] = None
            first = parts[0]
            if first in self.roots or first in again:
                continue
            if first in fresh or first in self.once:
                again[first] = None
            else:
                fresh[first] = r
        for p in again:
            fresh.pop(p, None)
        self.once.difference_update(again)
        self.once.update(fresh)
        if again:
            self._add_parts(list(again))
        for r in rows:
            u = units[r]
            parts = split[u]
            tail = self.roots[parts[1]] << 32 if len(parts) > 1 else 0
            root = self.roots.get(parts[0])
            if root is None:
                found[r] = tail
            else:
                self.units[u] = found[r] = root | tail
        return found, np.array(list(fresh.values()), dtype=np.int64), list(fresh)

    def encode(self, units: list[str], keys: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units, one after the other, and how many each has. A candidate merge of a unit is skipped if its hash under the unit's key is below limit."""
        if max(self.parent.n, len(self.units)) > self.limit or self.ids.n > 8 * self.limit:
            self._clear()
        both, rows, parts = self._nodes(units)
        node, tail = both & 0xFFFFFFFF, both >> 32
        left = np.arange(len(units)) if limit else np.zeros(0, dtype=np.int64)
        if self.long and limit:
            more = np.flatnonzero(np.isin(node, list(self.long)))
            rows, parts = np.concatenate([rows, more]), [*parts, *(self.long[r] for r in node[more].tolist())]
            node[more] = 0
        while len(left):
            at = node[left]
            begin = self.edges_end.data[at]
            count = self.edges_end.data[at + 1] - begin
            which = np.repeat(np.arange(len(left)), count)
            edge = places(begin, count)
            mixed = (keys[left][which] ^ SPANS[self.span.data[edge]]) * U64(0xBF58476D1CE4E5B9)
            hit = np.flatnonzero((mixed >> U64(11)) < U64(limit))
            which, edge = which[hit], edge[hit]
            first = np.flatnonzero(np.diff(which, prepend=-1))
            which, edge = which[first], edge[first]
            new, one = np.unique(edge[self.child.data[edge] < 0], return_index=True)
            if len(new):
                self._add_children(at[which[self.child.data[edge] < 0][one]], new)
            left = left[which]
            node[left] = self.child.data[edge]
        ids, counts = self.model.together(parts, keys[rows], limit)
        if len(rows):  # nodes of these rows alone, which are not kept
            columns = self.ids, self.ids_end, self.edges_end, self.parent, self.root, self.skipped
            before, none = [c.n for c in columns], np.zeros(len(rows), dtype=np.int64)
            node[rows] = self._add(ids, counts, none, np.zeros(0, dtype=np.uint16), none - 1, None, none)
            for c, n in zip(columns, before):
                c.n = n
        pairs = np.stack([node, tail], 1).reshape(-1)
        begin = self.ids_end.data[pairs]
        count = self.ids_end.data[pairs + 1] - begin
        return self.ids.data[places(begin, count)], count.reshape(-1, 2).sum(1)


@lru_cache(maxsize=1)
def segment_tree(path: str) -> SegmentTree:
    """One for each Python worker, which goes on to the next task with it."""
    return SegmentTree(PieceModel(path))


def encode_texts(docs: DataFrame, path: str, seed: int, rate: float = 0.1) -> DataFrame:
    """docs with `ids`, the piece ids of each text as little-endian uint32, and `lossless`, whether decoding them gave the text back.

    rate 0 gives the library's own segmentation. Null and empty texts have no ids; a null doc_id hashes as 0; repeated
    rows are encoded alike; long texts are taken whole; an empty table gives an empty table. Columns ids and lossless of
    docs are replaced, others kept.
    """
    docs = without(docs, "ids", "lossless").withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.BinaryType()), T.StructField("lossless", T.BooleanType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tree, limit = segment_tree(path), int(rate * 2**53)
        model = tree.model
        for batch in batches:
            at = {c.lower(): i for i, c in enumerate(batch.schema.names)}
            docs_, texts = batch.column(at["doc_id"]).to_pylist(), batch.column(at["text"]).to_pylist()
            ids, same, start = [], [], 0
            while start < len(texts):
                stop, units, keys, counts = start, [], [], []
                while stop < len(texts) and len(units) < 200_000:  # units taken together
                    own = model.units(texts[stop] or "")
                    begin = U64(((int(docs_[stop] or 0) * 0xD6E8FEB86659FD93) ^ (seed * 0xA0761D6478BD642F)) & _MASK)
                    keys.append(begin + np.arange(len(own), dtype=U64))
                    units += own
                    counts.append(len(own))
                    stop += 1
                got, sizes = tree.encode(units, mix64(np.concatenate(keys)), limit)
                bounds = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *counts])].tolist()
                for text, a, b in zip(texts[start:stop], bounds, bounds[1:]):
                    ids.append(got[a:b].tobytes())
                    same.append(model.decode(got[a:b].tolist()) == (text or "").encode())
                start = stop
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary()), pa.array(same)], names=[*batch.schema.names, "ids", "lossless"])

    return docs.mapInArrow(run, schema)


def decode_ids(rows: DataFrame, path: str) -> DataFrame:
    """rows with `text` decoded from `ids` (null for null); a column text of rows is replaced."""
    rows = without(rows, "text")
    schema = T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = PieceModel(path)
        for batch in batches:
            at = next(i for i, c in enumerate(batch.schema.names) if c.lower() == "ids")
            out = [None if x is None else model.decode(np.frombuffer(x, dtype="<u4").tolist()) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary()).cast(pa.string())], names=[*batch.schema.names, "text"])

    return rows.mapInArrow(run, schema)
