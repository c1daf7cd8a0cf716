"""Metric tree of a bounded set of integer points by the anchors hierarchy, and
nearest-entry assignment with candidate lists handed down it."""

from __future__ import annotations

import numpy as np

LEAF = 48


def _distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - to).astype(np.float64) ** 2).sum(axis=-1))


def anchors(points: np.ndarray, most: int) -> list[np.ndarray]:
    """Split points (by number) among up to ``most`` anchors: the farthest
    point of the widest anchor becomes the next one and takes from the others
    the points nearer to it.  Points nearer to their own pivot than half the
    distance between the pivots can't be nearer to the new one, so each list,
    sorted by falling distance, is looked at only as far as that."""
    first = _distances(points, points[0])
    order = np.argsort(-first, kind="stable")
    pivots, lists, far = [0], [order], [first[order]]
    while len(pivots) < most:
        widest = int(np.argmax([d[0] for d in far]))
        if far[widest][0] == 0:
            break
        new = int(lists[widest][0])
        taken, distances = [], []
        for k, pivot in enumerate(pivots):
            half = _distances(points[pivot], points[new]) / 2
            n = int(np.searchsorted(-far[k], -half * (1 - 1e-12), "right"))
            if not n:
                continue
            head = lists[k][:n]
            d = _distances(points[head], points[new])
            nearer = d < far[k][:n]
            if nearer.any():
                taken.append(head[nearer])
                distances.append(d[nearer])
                stay = np.concatenate([~nearer, np.ones(len(lists[k]) - n, bool)])
                lists[k], far[k] = lists[k][stay], far[k][stay]
        own, d = np.concatenate(taken), np.concatenate(distances)
        order = np.argsort(-d, kind="stable")
        pivots.append(new)
        lists.append(own[order])
        far.append(d[order])
    return lists


def _merged(points: np.ndarray, parts: list) -> list:
    """Binary tree over the anchors' subtrees, joining again and again the two
    whose common ball is smallest."""
    groups = [p[1] for p in parts]
    trees = [p[0] for p in parts]
    center = np.array([points[g].mean(axis=0) for g in groups])
    count = np.array([len(g) for g in groups], float)
    radius = np.array([_distances(points[g], c).max() for g, c in zip(groups, center)])
    cost = (np.sqrt(((center[:, None] - center[None]) ** 2).sum(axis=2)) + radius[:, None] + radius[None]) / 2
    np.fill_diagonal(cost, np.inf)
    alive = len(trees)
    while alive > 1:
        i, j = divmod(int(np.argmin(cost)), len(trees))
        middle = (center[i] * count[i] + center[j] * count[j]) / (count[i] + count[j])
        radius[i] = max(np.linalg.norm(middle - center[i]) + radius[i], np.linalg.norm(middle - center[j]) + radius[j])
        trees[i], center[i], count[i] = [trees[i], trees[j]], middle, count[i] + count[j]
        cost[j], cost[:, j] = np.inf, np.inf
        others = np.isfinite(cost[i])
        cost[i, others] = cost[others, i] = (np.sqrt(((center[others] - middle) ** 2).sum(axis=1))
                                             + radius[i] + radius[others]) / 2
        alive, last = alive - 1, i
    return trees[last] if len(parts) > 1 else trees[0]


def _grown(points: np.ndarray, own: np.ndarray):
    """Nested pairs with arrays of point numbers as leaves, middle out: about
    sqrt(n) anchors, the tree above them by merging, the ones below by the
    same again."""
    if len(own) <= LEAF:
        return own
    lists = anchors(points[own], max(2, int(np.sqrt(len(own)))))
    if len(lists) == 1:  # all points are equal
        return own
    return _merged(points, [(_grown(points, own[x]), own[x]) for x in lists if len(x)])


class BallTree:
    """Balls in depth-first order.  Ball i holds points order[start[i]:end[i]]
    and caches their sum, mean and radius; its children are i + 1 and
    second[i] (0: a leaf)."""

    def __init__(self, points: np.ndarray):
        self.points = points
        order, start, end, second, total = [], [], [], [], 0
        stack: list = [(_grown(points, np.arange(len(points))), -1)]
        while stack:
            tree, parent = stack.pop()
            if parent == -2:  # both children are done
                end[tree] = total
                continue
            me = len(start)
            if parent >= 0:
                second[parent] = me
            start.append(total)
            end.append(total)
            second.append(0)
            if isinstance(tree, list):
                stack += [(me, -2), (tree[1], me), (tree[0], -1)]
            else:
                order.append(tree)
                total += len(tree)
                end[me] = total
        self.order = np.concatenate(order)
        self.start, self.end, self.second = np.array(start), np.array(end), np.array(second)
        sorted_points = points[self.order]
        sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(sorted_points, axis=0)])
        self.sums = sums[self.end] - sums[self.start]
        self.mean = self.sums / (self.end - self.start)[:, None]
        self.radius = np.array([_distances(sorted_points[s:e], m).max()
                                for s, e, m in zip(self.start, self.end, self.mean)])

    def assign(self, entries: np.ndarray, owned=None) -> np.ndarray | None:
        """Nearest entry of every point, ties to the lower index.

        With ``owned(entry, count, sum)``, balls that an entry owns wholly are
        reported by their cached sums, other points by leaf and entry, and no
        assignment of single points is made.
        """
        table = entries.astype(np.float64)
        _, distinct = np.unique(entries, axis=0, return_index=True)
        out = None if owned else np.zeros(len(self.points), np.int64)
        stack = [(0, np.sort(distinct))]  # of equal entries the first one counts
        while stack:
            ball, left = stack.pop()
            d2 = ((table[left] - self.mean[ball]) ** 2).sum(axis=1)
            best = int(np.argmin(d2))
            # Largest possible lead of any other entry over the best one, within the ball.
            lead = d2[best] - d2 + 2 * self.radius[ball] * np.sqrt(((table[left] - table[left[best]]) ** 2).sum(axis=1))
            margin = 1e-9 * (d2 + self.radius[ball] ** 2 + 1)
            keep = lead >= -margin
            keep[best] = True
            left = left[keep]
            s, e = self.start[ball], self.end[ball]
            if len(left) == 1:
                if owned:
                    owned(int(left[0]), int(e - s), self.sums[ball])
                else:
                    out[self.order[s:e]] = left[0]
            elif self.second[ball]:
                stack += [(self.second[ball], left), (ball + 1, left)]
            else:
                own = self.order[s:e]
                some = self.points[own]
                to = left[((some[:, None] - entries[left][None]) ** 2).sum(axis=2).argmin(axis=1)]
                if owned:
                    for k in np.unique(to):
                        owned(int(k), int((to == k).sum()), some[to == k].sum(axis=0))
                else:
                    out[own] = to
        return out
