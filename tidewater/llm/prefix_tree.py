"""Jaccard join of the sets of one block with a compressed prefix tree."""

from __future__ import annotations

import numpy as np


class Sets:
    """Union-find over the sets of a block."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return int(i)

    def union(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        self.root[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        r = self.root
        while True:
            up = r[r]
            if np.array_equal(up, r):
                return r
            r = up


class PrefixTree:
    """Sets with their items in one global order (items of many sets first),
    stored so that equal beginnings share nodes.

    ``sizes`` are full set sizes; ``items`` may leave out items that no other
    set has.  Sets are numbered in tree (depth-first) order; ``order`` gives
    their positions in the input.
    """

    def __init__(self, items: list[np.ndarray], sizes: np.ndarray):
        flat = np.concatenate(items) if items else np.zeros(0, np.int64)
        values, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
        rank = np.empty(len(values), np.int64)
        rank[np.lexsort((values, -counts))] = np.arange(len(values))
        ends = np.cumsum([len(x) for x in items]).astype(np.int64)
        ranked = [np.sort(rank[inverse[e - len(x): e]]) for x, e in zip(items, ends)]
        self.order = sorted(range(len(items)), key=lambda i: (ranked[i].astype(">i4").tobytes(), i))
        self.ranked = [ranked[i] for i in self.order]
        self.sizes = np.asarray(sizes, dtype=np.int64)[self.order]
        self.n_values = len(values)
        self._build()

    def _build(self) -> None:
        # A node is [depth, parent, first set, end of sets]; each set has a leaf of its own.
        nodes: list[list[int]] = [[0, -1, 0, len(self.ranked)]]
        path, shared = [0], 0
        for i, items in enumerate(self.ranked):
            if i:
                before, m = self.ranked[i - 1], min(len(items), len(self.ranked[i - 1]))
                differ = np.flatnonzero(before[:m] != items[:m])
                shared = int(differ[0]) if len(differ) else m
                last = -1
                while nodes[path[-1]][0] > shared or nodes[path[-1]][3] == -2:
                    last = path.pop()
                    nodes[last][3] = i
                if nodes[path[-1]][0] < shared:  # split the edge to the node just left
                    nodes.append([shared, path[-1], nodes[last][2], -1])
                    nodes[last][1] = len(nodes) - 1
                    path.append(len(nodes) - 1)
            nodes.append([len(items), path[-1], i, -2])
            path.append(len(nodes) - 1)
        for k in path:
            nodes[k][3] = len(self.ranked)
        table = np.array(nodes, dtype=np.int64)
        self.depth, self.parent, self.first, self.end = table.T.copy()
        leaf_of = np.zeros(len(table), bool)
        seen = np.bincount(self.parent[1:], minlength=len(table))
        leaf_of[seen == 0] = True
        self.leaf = leaf_of
        by_parent = np.argsort(self.parent[1:], kind="stable") + 1
        self.children, self.child_at = by_parent, np.concatenate([[0], np.cumsum(seen)])
        above = np.where(self.parent >= 0, self.depth[self.parent], 0)
        self.seg_len = self.depth - above
        self.seg_len[0] = 0
        self.seg_at = np.concatenate([[0], np.cumsum(self.seg_len)])[:-1]
        parts = [self.ranked[f][a:d] for f, a, d in zip(self.first, above, self.depth)]
        self.flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.last_rank = np.full(len(table), -1, np.int64)
        full = self.depth > 0
        self.last_rank[full] = [self.ranked[f][d - 1] for f, d in zip(self.first[full], self.depth[full])]
        lengths = np.array([len(x) for x in self.ranked], dtype=np.int64)
        pick = lambda fn, x: np.array([fn(x[f:e]) for f, e in zip(self.first, self.end)])
        self.longest, self.least, self.most = pick(np.max, lengths), pick(np.min, self.sizes), pick(np.max, self.sizes)

    def partners(self, i: int, wanted: np.ndarray, percent: int) -> np.ndarray:
        """Sets j with ``wanted[j]`` whose Jaccard similarity to set i is at
        least ``percent`` / 100.

        Goes down the tree level by level; a node's overlap is its parent's
        plus that of its own items, and a subtree is left as soon as even all
        remaining items could not reach the overlap its smallest set needs.
        """
        items, a = self.ranked[i], int(self.sizes[i])
        mark = np.zeros(self.n_values + 1, np.int64)
        mark[items] = 1
        some = np.concatenate([[0], np.cumsum(wanted)])
        front, overlap = np.zeros(1, np.int64), np.zeros(1, np.int64)
        found = []
        while len(front):
            counts = self.child_at[front + 1] - self.child_at[front]
            up = np.repeat(np.arange(len(front)), counts)
            offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            nodes = self.children[self.child_at[front][up] + offset]
            keep = ((some[self.end[nodes]] > some[self.first[nodes]])
                    & (100 * self.most[nodes] >= percent * a) & (100 * a >= percent * self.least[nodes]))
            nodes, base = nodes[keep], overlap[up[keep]]
            if not len(nodes):
                break
            lens = self.seg_len[nodes]
            owner = np.repeat(np.arange(len(nodes)), lens)
            at = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens) + self.seg_at[nodes][owner]
            c = base + np.bincount(owner, mark[self.flat[at]], minlength=len(nodes)).astype(np.int64)
            left = len(items) - np.searchsorted(items, self.last_rank[nodes], "right")
            bound = c + np.minimum(self.longest[nodes] - self.depth[nodes], left)
            # 100 * o >= percent * (a + b - o)
            alive = (100 + percent) * bound >= percent * (a + self.least[nodes])
            ends = self.leaf[nodes]
            hit = alive & ends & ((100 + percent) * c >= percent * (a + self.sizes[self.first[nodes]]))
            found.append(self.first[nodes[hit]])
            front, overlap = nodes[alive & ~ends], c[alive & ~ends]
        out = np.concatenate(found) if found else np.zeros(0, np.int64)
        return out[wanted[out]]


def link_block(items: list[np.ndarray], sizes: np.ndarray, labels: list, percent: int) -> list:
    """New label of each set: the smallest label that links within the block
    reach.  Sets with equal labels are known to be connected; only pairs of
    sets not yet connected are looked for, until all are or none is left."""
    tree = PrefixTree(items, sizes)
    known = [labels[i] for i in tree.order]
    sets, first = Sets(len(known)), {}
    for j, label in enumerate(known):
        sets.union(first.setdefault(label, j), j)
    for i in range(len(known)):
        roots = sets.roots()
        wanted = roots != roots[i]
        if not wanted.any():
            break
        for j in tree.partners(i, wanted, percent):
            sets.union(i, int(j))
    roots, least = sets.roots(), {}
    for r, label in zip(roots, known):
        least[r] = min(least.get(r, label), label)
    out = [None] * len(known)
    for place, r in zip(tree.order, roots):
        out[place] = least[r]
    return out
