"""Self-joins of n-gram sets in prefix trees, many trees at once.

A tree holds sets as paths of their n-grams in one order, the most frequent of
the tree first, so that similar sets share long paths.  N-grams of a single set
match nothing and are left out of paths; they count in a set's size.  Every set
goes down its tree as a probe.  What it has in common with a path is counted
once for all sets below; a subtree is left as soon as the overlap and the
lengths that remain, of the probe and of the longest path below, cannot reach
what the smallest set below needs, and also where all its sets are in the
probe's component already.

Trees of a few sets are not built: there each two sets are compared.

Paths are cut into segments at fixed depths, each twice as deep as the one
before, and a node is a run of sorted sets that agree to such a depth.  So one
step of numpy calls takes all probes of all trees one segment down.  Probes go
in turns: the first of each tree, the next two, the next four; links join
components between turns, which spares near copies most of their probes.
"""

from __future__ import annotations

import numpy as np

from . import graph, textvec as tv

#: N-grams compared in one step at most, unless one probe alone has more.
WORK = 500_000
#: Sets of a tree up to which each two are compared at once, if hashes have at most ``SHORT`` bits.
FEW = 8
SHORT = 44


def joined(comp: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component numbers after links between components ``a`` and ``b``."""
    node, top = graph.stars(a, b)
    if not len(node):
        return comp
    at = np.minimum(np.searchsorted(node, comp), len(node) - 1)
    return np.where(node[at] == comp, top[at], comp)


def links(tree: np.ndarray, h: np.ndarray, size: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Similar sets, by number: links that connect what is similar in each tree.

    Short hashes leave room for a pair's number, so sets of small trees go pair by pair.
    """
    bounds = np.r_[0, np.cumsum(size)]
    if not len(h) or int(h.max()) >> SHORT:
        return Forest(tree, h, bounds, t).links()
    small = np.bincount(tree)[tree] <= FEW
    i, j = _paired(np.flatnonzero(small), tree[small], h, bounds, t)
    rest = np.flatnonzero(~small)
    if not len(rest):
        return i, j
    number = np.cumsum(np.r_[False, tree[rest][1:] != tree[rest][:-1]])
    x, y = Forest(number, h[np.repeat(~small, size)], np.r_[0, np.cumsum(size[rest])], t).links()
    return np.r_[i, rest[x]], np.r_[j, rest[y]]


def _paired(row: np.ndarray, tree: np.ndarray, h: np.ndarray, bounds: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """All similar pairs of the sets ``row`` within their trees."""
    size = np.diff(bounds)
    first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]][: len(tree)])
    count = np.diff(np.r_[first, len(tree)])
    i, j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for m in np.unique(count).tolist():
        for side, at in zip((i, j), np.triu_indices(m, 1), strict=True):
            side.append(row[first[count == m][:, None] + at].ravel())
    i, j = np.concatenate(i), np.concatenate(j)
    near = 100 * np.minimum(size[i], size[j]) >= t * np.maximum(size[i], size[j])
    i, j = i[near], j[near]
    both = size[i] + size[j]
    common = np.zeros(len(i), np.int64)
    for lo, hi in tv.blocks(np.r_[0, np.cumsum(both)], WORK):
        two = np.stack([i[lo:hi], j[lo:hi]], 1).ravel()
        key = h[tv.gather(bounds[two], size[two])]
        key |= np.repeat(np.arange(hi - lo, dtype=np.uint64) << np.uint64(SHORT), both[lo:hi])
        key.sort(kind="stable")  # two sorted runs for each pair
        common[lo:hi] = np.bincount((key[1:][key[1:] == key[:-1]] >> np.uint64(SHORT)).astype(np.int64), minlength=hi - lo)
    similar = 100 * common >= t * (both - common)
    return i[similar], j[similar]


class Forest:
    """Trees of sets; ``tree`` numbers each set's tree, rising from 0, ``h`` has the
    distinct n-grams of one set after the other, ``bounds`` their limits."""

    def __init__(self, tree: np.ndarray, h: np.ndarray, bounds: np.ndarray, t: int):
        size, self.t = np.diff(bounds), t
        #: Subtrees met, and those left by the bounds.
        self.met = self.left = 0
        owner = np.repeat(np.arange(len(size)), size)
        key = tv.mix(h ^ tv.mix(tree[owner].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key)
        key = key[order]
        new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        count = np.diff(np.r_[first, len(key)])
        shared = count > 1
        at, token = order[np.repeat(shared, count)], np.repeat(np.cumsum(shared) - 1, count)[np.repeat(shared, count)]
        first, count = first[shared], count[shared]
        number = np.empty(len(first), np.int64)
        number[np.lexsort((key[first], -count, tree[owner[order[first]]]))] = np.arange(len(first))
        paths = np.sort(owner[at] << 32 | number[token])
        length = np.bincount(paths >> 32, minlength=len(size))
        row = np.flatnonzero((length > 0) & (100 * length >= t * size))  # an overlap must reach t hundredths of either set
        start = (np.cumsum(length) - length)[row]
        length, paths = length[row], paths & 0xFFFFFFFF
        raw = paths.astype(">u4").tobytes()
        names = [raw[4 * a : 4 * (a + n)] for a, n in zip(start.tolist(), length.tolist(), strict=True)]
        order = np.array(sorted(range(len(row)), key=names.__getitem__), np.int64)
        self.row, self.length, self.size, self.tree = row[order], length[order], size[row][order], tree[row][order]
        self.path = paths[tv.gather(start[order], self.length)]
        self.end = np.cumsum(self.length)
        self.start = self.end - self.length
        self.keys = np.repeat(np.arange(len(order)), self.length) << 32 | self.path
        self._levels()

    def _levels(self) -> None:
        n = len(self.row)
        least = np.minimum(self.length[1:], self.length[:-1])
        edge = np.cumsum(least) - least
        same = self.path[tv.gather(self.start[1:], least)] == self.path[tv.gather(self.start[:-1], least)]
        place = np.arange(len(same)) - np.repeat(edge, least)
        place[same] = np.iinfo(np.int64).max
        common = np.minimum(np.minimum.reduceat(place, edge), least) if n > 1 else np.zeros(0, np.int64)
        longest = np.maximum(self.length[1:], self.length[:-1])
        self.depth, self.first, self.last, self.low, self.high, self.deep = [0], [], [], [], [], []
        while n:
            d = self.depth[-1]
            cut = common < np.minimum(d, longest) if d else self.tree[1:] != self.tree[:-1]
            first = np.r_[0, np.flatnonzero(cut) + 1]
            self.first.append(first)
            self.last.append(np.r_[first[1:], n] - 1)
            self.low.append(np.minimum.reduceat(self.size, first))
            self.high.append(np.maximum.reduceat(self.size, first))
            self.deep.append(np.maximum.reduceat(self.length, first))
            if d >= self.length.max():
                break
            self.depth.append(2 * d + 2)
        if n:
            self.root = np.repeat(np.arange(len(self.first[0])), self.last[0] - self.first[0] + 1)
            self.place = np.arange(n) - self.first[0][self.root]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Similar sets, by number: links that connect what is similar, not every pair within a component."""
        n = len(self.row)
        comp, found = np.arange(n), []
        lo, width = 0, 1
        while n and lo <= self.place.max():
            probes = np.flatnonzero((self.place >= lo) & (self.place < lo + width))
            a, b = self._descend(probes, comp)
            if len(a):
                found.append((self.row[a], self.row[b]))
                comp = joined(comp, comp[a], comp[b])
            lo, width = lo + width, 2 * width
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])

    def _descend(self, probes: np.ndarray, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        t, out = self.t, []
        one = [(np.minimum.reduceat(comp, f), np.maximum.reduceat(comp, f)) for f in self.first]
        todo = [(0, probes, self.root[probes], np.zeros(len(probes), np.int64))]
        while todo:
            k, q, node, common = todo.pop()
            if not len(q):
                continue
            d, e = self.depth[k], self.depth[k + 1]
            first = self.first[k + 1]
            lo = np.searchsorted(first, self.first[k][node])
            many = np.searchsorted(first, self.last[k][node], "right") - lo
            if len(q) > 1 and int(many.sum()) * (e - d) > WORK:
                half = len(q) // 2
                todo += [(k, q[:half], node[:half], common[:half]), (k, q[half:], node[half:], common[half:])]
                continue
            q, common, c = np.repeat(q, many), np.repeat(common, many), tv.gather(lo, many)
            self.met += len(c)
            low, high = self.low[k + 1][c], self.high[k + 1][c]
            mine = comp[q]
            ok = (self.last[k + 1][c] > q) & ((one[k + 1][0][c] != mine) | (one[k + 1][1][c] != mine))
            ok &= (100 * high >= t * self.size[q]) & (100 * self.size[q] >= t * low)
            q, common, c, low = q[ok], common[ok], c[ok], low[ok]
            head = first[c]
            a, b = self.start[head] + d, self.start[head] + np.minimum(self.length[head], e)
            width = b - a
            wanted = np.repeat(q, width) << 32 | self.path[tv.gather(a, width)]
            at = np.searchsorted(self.keys, wanted)
            hit = self.keys[np.minimum(at, len(self.keys) - 1)] == wanted
            total, edge = np.r_[0, np.cumsum(hit)], np.r_[0, np.cumsum(width)]
            common = common + total[edge[1:]] - total[edge[:-1]]
            rest = self.length[q]
            some = np.flatnonzero(width)
            tip = edge[1:][some] - 1
            rest[some] = self.end[q[some]] - at[tip] - hit[tip]
            leaf = self.deep[k + 1][c] <= e  # not by its first path, which can end at e where others go on
            room = np.where(leaf, 0, np.minimum(self.deep[k + 1][c] - e, rest))
            ok = common + room >= -(-t * (self.size[q] + low) // (100 + t))
            self.left += len(ok) - int(ok.sum())
            done = ok & leaf
            if done.any():
                r, o, v = q[done], common[done], c[done]
                many = self.last[k + 1][v] - first[v] + 1
                j, r, o = tv.gather(first[v], many), np.repeat(r, many), np.repeat(o, many)
                similar = (j > r) & (100 * o >= t * (self.size[r] + self.size[j] - o))
                out.append((r[similar], j[similar]))
            ok &= ~leaf
            todo.append((k + 1, q[ok], c[ok], common[ok]))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])
