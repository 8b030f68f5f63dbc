"""Context-tree weighting over bytes: each byte is eight binary decisions, each context a path of preceding bytes.

A gram is `depth` context bytes and the byte that follows them, as one integer (the last byte lowest). For each decision
(a prefix of the byte's bits) the contexts of 0, 1, ..., depth bytes form a tree; a node that saw n0 zeros and n1 ones
estimates with Krichevsky-Trofimov, and its weighted probability is half its own estimate's and half the product of
its children's. A prediction mixes the estimates along the path by the weights that this leaves them.
"""

from __future__ import annotations

import numpy as np

from .common import U64, mix64

HALF = np.log(0.5)
#: Contexts of this many bytes are the largest groups that a tree is cut into; very frequent ones are cut further (see Cuts).
TOP = 2
#: Ends each text: a byte that UTF-8 has no use for, so that the model's probabilities are those of whole texts.
END = b"\xff"


def _log_gamma_half(n: np.ndarray) -> np.ndarray:
    """log(gamma(n + 1/2) / gamma(1/2)) of whole numbers: exact sums below 64, Stirling's series above."""
    table = np.concatenate([[0.0], np.cumsum(np.log(np.arange(64) + 0.5))])
    x = np.maximum(n, 64) + 0.5
    series = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) - 0.5 * np.log(np.pi)
    return np.where(n < 64, table[np.minimum(n, 63).astype(np.int64)], series)


def _log_factorial(n: np.ndarray) -> np.ndarray:
    table = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 64)))])
    x = np.maximum(n, 63) + 1.0
    series = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(n < 64, table[np.minimum(n, 63).astype(np.int64)], series)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return _log_gamma_half(n0) + _log_gamma_half(n1) - _log_factorial(n0 + n1)


def _weigh(n0: np.ndarray, n1: np.ndarray, below: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(log weighted probability, weight of the node's own estimate); below: the children's log probabilities summed, None for leaves."""
    own = log_kt(n0, n1)
    if below is None:
        return own, np.ones(len(own))
    both = np.logaddexp(HALF + own, HALF + below)
    return both, np.exp(HALF + own - both)


def decisions(symbols: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the j-th bit of each byte: its place (1..255: a one before the bits so far) and its value."""
    return (1 << j) | (symbols >> (8 - j)), (symbols >> (7 - j)) & 1


def deep(grams: np.ndarray, counts: np.ndarray, depth: int, top: int = TOP) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """For all grams of some contexts of `top` bytes: each one's eight predictions by the nodes at depths top to depth,
    and the nodes at depth top: context, place, n0, n1, log weighted probability."""
    symbols = (grams & U64(255)).astype(np.int64)
    contexts = [((grams >> U64(8)) & U64((1 << 8 * d) - 1)).astype(np.int64) for d in range(depth + 1)]
    predicted = np.ones((len(grams), 8))
    tables: list[list[np.ndarray]] = []
    for j in range(8):
        place, bit = decisions(symbols, j)
        zeros, ones = counts * (bit == 0), counts * (bit == 1)
        chain, below, rows = [], None, None
        for d in range(depth, top - 1, -1):
            key = (contexts[d] << 8) | place
            if rows is None:
                nodes, of = np.unique(key, return_inverse=True)
                n0, n1 = np.bincount(of, zeros, len(nodes)), np.bincount(of, ones, len(nodes))
                row_of = of
            else:
                up = (((nodes >> 8) & ((1 << 8 * d) - 1)) << 8) | (nodes & 255)
                above, of = np.unique(up, return_inverse=True)
                n0, n1, below = np.bincount(of, n0, len(above)), np.bincount(of, n1, len(above)), np.bincount(of, logs, len(above))
                nodes, row_of = above, of[row_of]
            logs, weight = _weigh(n0, n1, below)
            rows = nodes
            chain.append((n0, n1, weight, row_of))
        mixed = None
        for n0, n1, weight, at in chain:
            own = (np.where(bit, n1[at], n0[at]) + 0.5) / (n0[at] + n1[at] + 1)
            mixed = own if mixed is None else weight[at] * own + (1 - weight[at]) * mixed
        predicted[:, j] = mixed
        tables.append([nodes >> 8, nodes & 255, n0, n1, logs])
    names = ("context", "place", "n0", "n1", "logs")
    return predicted, {n: np.concatenate([t[i] for t in tables]) for i, n in enumerate(names)}


def context_of(grams: np.ndarray, length: int) -> np.ndarray:
    """The `length` bytes before each gram's last, as an integer."""
    return (grams >> U64(8)) & U64((1 << 8 * length) - 1)


class Cuts:
    """Where trees are cut: hot[d] holds the contexts of d bytes (d = TOP, TOP + 1, ...) that are frequent enough to be divided by
    their next byte. A gram belongs to the shortest of its contexts, from TOP bytes on, that isn't divided."""

    def __init__(self, hot: dict[int, np.ndarray]):
        self.hot = {d: np.sort(np.asarray(c, dtype=U64)) for d, c in hot.items()}

    def divided(self, grams: np.ndarray, length: int) -> np.ndarray:
        """Whether the context of that length is divided; then so are its shorter ones."""
        table = self.hot.get(length)
        if table is None or not len(table):
            return np.zeros(len(grams), dtype=bool)
        context = context_of(grams, length)
        return table[np.minimum(np.searchsorted(table, context), len(table) - 1)] == context

    def lengths(self, grams: np.ndarray) -> np.ndarray:
        out = np.full(len(grams), TOP)
        for d in sorted(self.hot):
            out[self.divided(grams, d)] = d + 1
        return out

    def shards(self, grams: np.ndarray, n: int) -> np.ndarray:
        """A shard for each gram, the same for all grams of a context that isn't divided."""
        length = self.lengths(grams).astype(U64)
        mask = (U64(1) << (U64(8) * length)) - U64(1)
        return mix64((((grams >> U64(8)) & mask) << U64(3)) ^ length) % U64(n)


class DividedNodes:
    """The nodes of divided contexts: counts and weights, by context and place; built from the deepest up.

    sums: for each length d of divided contexts (key, n0, n1, logs), key context << 8 | place: the sums over the nodes one byte
    deeper that shards hold. Nodes that are divided themselves add to those above them; what reaches contexts of one byte is `low`.
    """

    def __init__(self, sums: dict[int, tuple[np.ndarray, ...]]):
        self.tables: dict[int, tuple[np.ndarray, ...]] = {}
        above: tuple[np.ndarray, ...] | None = None
        for d in range(max(sums, default=TOP), TOP - 2, -1):
            parts = [x for x in (sums.get(d), above) if x is not None]
            if not parts:
                continue
            keys, of = np.unique(np.concatenate([p[0] for p in parts]).astype(U64), return_inverse=True)
            n0, n1, logs = (np.bincount(of, np.concatenate([p[i] for p in parts]), len(keys)) for i in (1, 2, 3))
            if d == TOP - 1:
                self.low = keys, n0, n1, logs
                return
            own, weight = _weigh(n0, n1, logs)
            self.tables[d] = keys, n0, n1, weight
            above = ((keys >> U64(8)) & U64((1 << 8 * (d - 1)) - 1)) << U64(8) | (keys & U64(255)), n0, n1, own
        self.low = tuple(np.zeros(0, dtype=t) for t in (U64, float, float, float))

    def mixed(self, grams: np.ndarray, lengths: np.ndarray, predicted: np.ndarray) -> np.ndarray:
        """predicted, by the nodes at depths lengths and deeper, mixed with those of the divided contexts."""
        predicted = predicted.copy()
        symbols = (grams & U64(255)).astype(np.int64)
        for d in sorted(self.tables, reverse=True):
            on = np.flatnonzero(lengths > d)
            keys, n0, n1, weight = self.tables[d]
            for j in range(8):
                place, bit = decisions(symbols[on], j)
                at = np.searchsorted(keys, (context_of(grams[on], d) << U64(8)) | place.astype(U64))
                own = (np.where(bit, n1[at], n0[at]) + 0.5) / (n0[at] + n1[at] + 1)
                predicted[on, j] = weight[at] * own + (1 - weight[at]) * predicted[on, j]
        return predicted


class TopNodes:
    """The nodes at depths 0 and 1: 256 + 256 * 256 places at most, whatever the corpus."""

    def __init__(self, byte: np.ndarray, place: np.ndarray, n0: np.ndarray, n1: np.ndarray, logs: np.ndarray):
        """One row per context byte and place: counts, and the sum of the log probabilities of the nodes below."""
        at = byte.astype(np.int64) * 256 + place
        self.one = [np.zeros(65536) for _ in range(3)]  # n0, n1, weight
        upper, weight = _weigh(n0, n1, logs)
        for table, x in zip(self.one, (n0, n1, weight)):
            table[at] = x
        sums = [np.bincount(place, x, 256) for x in (n0, n1, upper)]
        self.zero = [sums[0], sums[1], _weigh(*sums)[1]]

    def log10(self, grams: np.ndarray, predicted: np.ndarray) -> np.ndarray:
        """log10 of each gram's last byte after the others."""
        symbols, byte = (grams & U64(255)).astype(np.int64), ((grams >> U64(8)) & U64(255)).astype(np.int64)
        out = np.zeros(len(grams))
        for j in range(8):
            place, bit = decisions(symbols, j)
            mixed = predicted[:, j]
            for (n0, n1, weight), at in ((self.one, byte * 256 + place), (self.zero, place)):
                own = (np.where(bit, n1[at], n0[at]) + 0.5) / (n0[at] + n1[at] + 1)
                mixed = weight[at] * own + (1 - weight[at]) * mixed
            out += np.log10(mixed)
        return out


class KeyTable:
    """Places of distinct 64-bit keys in an array, found through a table of slots; keys that lose their slot to another are in a table of their own."""

    def __init__(self, keys: np.ndarray, factor: int = 0x9E3779B97F4A7C15):
        self.keys, self.factor = keys, U64(factor)
        self.shift = U64(64 - max(4, int(8 * len(keys) + 1).bit_length()))
        self.slots = np.zeros(1 << (64 - int(self.shift)), dtype=np.int32)
        at = self._slot(keys)
        self.slots[at] = np.arange(len(keys), dtype=np.int32)
        self.lost = np.flatnonzero(self.slots[at] != np.arange(len(keys)))
        self.rest = KeyTable(keys[self.lost], factor * 0xD1342543DE82EF95 % 2**64) if len(self.lost) else None

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self.factor) >> self.shift).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places, -1 for keys that aren't there."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int64)
        at = self.slots[self._slot(keys)].astype(np.int64)
        miss = np.flatnonzero(self.keys[at] != keys)
        if self.rest and len(miss):
            other = self.rest.find(keys[miss])
            at[miss] = np.where(other >= 0, self.lost[other], -1)
        else:
            at[miss] = -1
        return at


def tally(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each comes with weight 1; those of weight 0 are only to be known."""
    on = weights > 0
    found, n = np.unique(keys if on.all() else keys[on], return_counts=True)
    if on.all():
        return found, n
    other = np.unique(keys[~on], return_counts=True)[0]
    return merged([(found, n), (other, np.zeros(len(other), dtype=np.int64))])


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of several parts as one: the distinct keys in order and their sums."""
    keys, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


class Counter:
    """Counts of 64-bit keys, chunk after chunk: sorted parts, which become one when they hold more than what is known so far."""

    def __init__(self):
        self.parts = [(np.empty(0, dtype=U64), np.empty(0, dtype=np.int64))]
        self.waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """keys: distinct ones."""
        self.parts.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > max(1_000_000, len(self.parts[0][0])):
            self.all()

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """All keys in order, and their counts."""
        if len(self.parts) > 1:
            self.parts, self.waiting = [merged(self.parts)], 0
        return self.parts[0]


def gram_codes(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all bytes of some texts, in order, each text preceded by zero bytes; and where each text begins."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    pad = b"\0" * depth
    raw = np.frombuffer(b"".join(x for t in texts for x in (pad, t)), dtype=np.uint8)
    codes = np.zeros(max(0, len(raw) - depth), dtype=U64)
    for i in range(depth + 1):
        codes |= raw[i : i + len(codes)].astype(U64) << U64(8 * (depth - i))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    if len(texts) > 1:  # windows that end in the padding of a later text
        keep = np.ones(len(codes), dtype=bool)
        ends = begins[1:-1] + depth * np.arange(len(texts) - 1)
        keep[(ends[:, None] + np.arange(depth)[None, :]).reshape(-1)] = False
        codes = codes[keep]
    return codes, begins[:-1]
