"""Cover trees over unit vectors: nested levels of halving radius, and the dual traversal of two of them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Points of a node that is not split further.
LEAF = 16
#: Slack of the bounds: distances come from rounded scalar products.
MARGIN = 1e-6
#: Points closer than this are not told apart by a further level.
SAME = 1e-6
#: Cells of a matrix held at a time.
CELLS = 2_000_000


def unit(points: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision; scaled by their largest component first, so nothing overflows."""
    points = np.asarray(points, dtype=np.float64)
    points = points / np.abs(points).max(axis=1, keepdims=True)
    return points / np.sqrt((points * points).sum(axis=1, keepdims=True))


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[i], ..., starts[i] + sizes[i] - 1 of all i, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def net(points: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of centres, the first point one of them, further apart than half so that each point lies within half of one;
    and which of the centres is nearest to each point."""
    least, centres = 1 - half * half / 2, np.empty(0, dtype=np.int64)
    for at in range(0, len(points), 512):
        part = np.arange(at, min(at + 512, len(points)))
        if len(centres):
            part = part[~(points[part] @ points[centres].T >= least).any(1)]
        near = points[part] @ points[part].T >= least
        covered, new = np.zeros(len(part), dtype=bool), []
        for i in range(len(part)):
            if not covered[i]:
                new.append(i)
                covered |= near[i]
        centres = np.concatenate([centres, part[new]])
    step = max(1, CELLS // len(centres))
    nearest = np.concatenate([(points[at : at + step] @ points[centres].T).argmax(1) for at in range(0, len(points), step)])
    nearest[centres] = np.arange(len(centres))
    return centres, nearest


class CoverTree:
    """points: in tree order. nodes: start, end, first child, number of children (0: a leaf) of each node, whose points are a
    run and whose centre is the run's first. radii: the exact radius that covers each node's points.

    A node of level l covers its points with radius l at most. The centres of its children are further apart than l / 2 and
    its own centre is one of them, so levels are nested; each point goes to the nearest of these, within l / 2. Levels that
    would leave a node whole are skipped. Nodes of LEAF points or fewer are leaves.
    """

    def __init__(self, points: np.ndarray, order: np.ndarray | None, nodes: np.ndarray, radii: np.ndarray):
        self.points, self.order, self.nodes, self.radii = points, order, nodes, radii
        self.start, self.size, self.leaf = nodes[:, 0], nodes[:, 1] - nodes[:, 0], nodes[:, 3] == 0

    @classmethod
    def build(cls, points: np.ndarray) -> CoverTree:
        """points: unit vectors as rows, at least one."""
        order, nodes, radii = np.arange(len(points)), [[0, len(points), 0, 0]], [0.0]
        todo = [(0, 2.0)]
        while todo:
            at, level = todo.pop()
            start, end = nodes[at][:2]
            own = order[start:end].copy()
            radii[at] = float(np.sqrt(np.maximum(0, 2 - 2 * (points[own] @ points[own[0]])).max())) if end - start > 1 else 0.0
            if end - start <= LEAF or radii[at] <= SAME:
                continue
            while level / 2 >= radii[at]:
                level /= 2
            centres, nearest = net(points[own], level / 2)
            other = np.ones(len(own), dtype=bool)
            other[centres] = False
            order[start:end] = own[np.lexsort((other, nearest))]
            nodes[at][2:] = len(nodes), len(centres)
            for size in np.bincount(nearest, minlength=len(centres)).tolist():
                todo.append((len(nodes), level / 2))
                nodes.append([start, start + size, 0, 0])
                radii.append(0.0)
                start += size
        return cls(points[order], order, np.array(nodes, dtype=np.int32), np.array(radii))

    def children(self, node: int) -> np.ndarray:
        """The node's children; of a leaf itself."""
        _, _, first, n = self.nodes[node]
        return np.arange(first, first + n) if n else np.array([node])

    def depth(self) -> int:
        deep = np.ones(len(self.nodes), dtype=np.int64)
        for node, (_, _, first, n) in enumerate(self.nodes.tolist()):
            deep[first : first + n] = deep[node] + 1
        return int(deep.max())


class Groups:
    """Connected components of the places 0, ..., n - 1: label is the smallest place of each one's component."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Puts a[i] and b[i] together for all i."""
        while len(a):
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            up = np.arange(len(self.label))
            np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
            while (higher := up[up]) is not None and (higher != up).any():
                up = higher
            self.label = up[self.label]

    def link_where(self, near: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> None:
        """Puts rows[i] and columns[j] together where near[i, j]; a link for each row and round, not for each cell."""
        while True:
            near = near & (self.label[rows][:, None] != self.label[columns][None, :])
            hit = near.any(1)
            if not hit.any():
                return
            near, rows = near[hit], rows[hit]
            self.link(rows, columns[near.argmax(1)])


@dataclass
class Found:
    """What a traversal found: for each point of the first tree, then (if it is another) of the second, the weight of the
    points that it links with, and the smallest place of its component; node pairs held against the bound, and ruled out."""

    weight: np.ndarray
    label: np.ndarray
    looked: int = 0
    pruned: int = 0


def dual_traversal(one: CoverTree, two: CoverTree, cosine: float, one_weight: np.ndarray, two_weight: np.ndarray) -> Found:
    """All pairs of a point of one and a point of two whose cosine is at or over the threshold; two may be one itself.

    A pair of nodes is ruled out if their centres lie further apart than both radii and the threshold's distance; it links
    whole if they lie so near that no pair can miss the threshold; else its children are held against each other, all at
    once. Points of leaves are compared by their scalar product.
    """
    limit, same = float(np.sqrt(2 - 2 * cosine)), one is two
    shift = 0 if same else len(one.points)
    groups = Groups(shift + len(two.points))
    found = Found(np.zeros(shift + len(two.points), dtype=np.int64), groups.label)
    one_sum, two_sum = (np.concatenate([[0], np.cumsum(w)]) for w in (one_weight, two_weight))

    def compare(rows: np.ndarray, columns: np.ndarray) -> None:
        """All of these points."""
        step = max(1, CELLS // max(1, len(columns)))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            near = one.points[part] @ two.points[columns].T >= cosine
            if same:
                near &= part[:, None] < columns[None, :]
            found.weight[part] += near @ two_weight[columns]
            found.weight[columns + shift] += one_weight[part] @ near
            groups.link_where(near, part, columns + shift)

    def compare_leaves(a: np.ndarray, b: np.ndarray) -> None:
        """The points of leaf a[i] and of leaf b[i], for all i."""
        cells = one.size[a].astype(np.int64) * two.size[b]
        ends = np.searchsorted(np.cumsum(cells), np.arange(CELLS // 32, int(cells.sum()) + CELLS // 32, CELLS // 32), side="right")
        for lo, hi in zip([0, *ends.tolist()], [*ends.tolist(), len(a)]):
            x, y, n = a[lo:hi], b[lo:hi], cells[lo:hi]
            if not len(x):
                continue
            inner = spans(np.zeros(len(x), dtype=np.int64), n)
            width = np.repeat(two.size[y], n)
            i, j = np.repeat(one.start[x], n) + inner // width, np.repeat(two.start[y], n) + inner % width
            if same:
                i, j = i[i < j], j[i < j]
            near = np.einsum("ij,ij->i", one.points[i], two.points[j]) >= cosine
            i, j = i[near], j[near]
            np.add.at(found.weight, i, two_weight[j])
            np.add.at(found.weight, j + shift, one_weight[i])
            groups.link(i, j + shift)

    todo = [np.zeros((1, 2), dtype=np.int64)]
    root = float(np.sqrt(max(0.0, 2 - 2 * float(one.points[0] @ two.points[0]))))
    if root - one.radii[0] - two.radii[0] > limit + MARGIN:
        found.looked, found.pruned, todo = 1, 1, []
    while todo:
        a, b = todo[-1][-1].tolist()
        todo[-1] = todo[-1][:-1]
        if not len(todo[-1]):
            todo.pop()
        twins = same and a == b
        (s, e), (t, f) = one.nodes[a, :2].tolist(), two.nodes[b, :2].tolist()
        far = float(np.sqrt(max(0.0, 2 - 2 * float(one.points[s] @ two.points[t]))))
        if (2 * one.radii[a] if twins else far + one.radii[a] + two.radii[b]) <= limit - MARGIN:
            found.weight[s:e] += two_sum[f] - two_sum[t]
            if twins:
                found.weight[s:e] -= one_weight[s:e]
            else:
                found.weight[t + shift : f + shift] += one_sum[e] - one_sum[s]
            groups.link(np.arange(s, e), np.full(e - s, t + shift))
            groups.link(np.arange(t, f) + shift, np.full(f - t, s))
            continue
        left, right = one.children(a), two.children(b)
        step = max(1, CELLS // len(right))
        for at in range(0, len(left), step):
            part = left[at : at + step]
            gap = np.sqrt(np.maximum(0, 2 - 2 * (one.points[one.start[part]] @ two.points[two.start[right]].T)))
            live = gap <= one.radii[part][:, None] + two.radii[right][None, :] + (limit + MARGIN)
            wanted = part[:, None] <= right[None, :] if twins else np.ones(live.shape, dtype=bool)
            found.looked += int(wanted.sum())
            found.pruned += int((wanted & ~live).sum())
            live &= wanted
            ends = live & one.leaf[part][:, None] & two.leaf[right][None, :]
            i, j = np.nonzero(live & ~ends)
            if len(i):
                todo.append(np.stack([part[i], right[j]], axis=1))
            if twins:  # a leaf of one point has no pair with itself
                ends &= (part[:, None] != right[None, :]) | (one.size[part] > 1)[:, None]
            rows, columns = np.flatnonzero(ends.any(1)), np.flatnonzero(ends.any(0))
            if not len(rows):
                continue
            rows, columns = part[rows], right[columns]
            alone = (ends * one.size[part][:, None]).sum(0) @ two.size[right]  # pairs of points in the leaves that are left
            if 8 * int(alone) < int(one.size[rows].sum()) * int(two.size[columns].sum()):
                i, j = np.nonzero(ends)
                compare_leaves(part[i], right[j])
            else:
                compare(spans(one.start[rows], one.size[rows]), spans(two.start[columns], two.size[columns]))
    found.label = groups.label
    return found
