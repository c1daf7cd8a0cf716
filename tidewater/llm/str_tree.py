"""R-tree of a bounded set of labelled integer vectors, packed by
sort-tile-recursive, and best-first inner-product search in it."""

from __future__ import annotations

import heapq

import numpy as np

LEAF = 128
FAN = 16


def tile(points: np.ndarray, own: np.ndarray, dims: np.ndarray, page: int) -> list[np.ndarray]:
    """Sort-tile-recursive: pages of up to ``page`` points.  The points are
    sorted along the first dimension and cut into the same number of slabs
    that every dimension gets (at least two), each slab tiled along the rest."""
    pages = -(-len(own) // page)
    if pages <= 1:
        return [own]
    if not len(dims):
        return [own[i: i + page] for i in range(0, len(own), page)]
    slabs = max(2, int(np.ceil(pages ** (1 / len(dims)))))
    size = -(-pages // slabs) * page
    own = own[np.argsort(points[own, dims[0]], kind="stable")]
    return [p for i in range(0, len(own), size) for p in tile(points, own[i: i + size], dims[1:], page)]


class STRTree:
    """Levels of boxes over points in packed order: rows first[i]:last[i] of the
    level below (of the points, for leaves) are in box i.  ``exact_float``: all
    inner products are below 2^53, so floating point gives them exactly."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray, exact_float: bool = False):
        # Labels are the first dimension; the others by falling spread.
        dims = np.argsort(-points.astype(float).std(axis=0), kind="stable")
        pages = []
        by_label = np.argsort(labels, kind="stable")
        for own in np.split(by_label, np.flatnonzero(np.diff(labels[by_label])) + 1):
            pages += tile(points, own, dims, LEAF)
        order = np.concatenate(pages)
        self.ids, self.labels, self.points = ids[order], labels[order], points[order]
        if exact_float:
            self.points = self.points.astype(np.float64)
        ends = np.cumsum([len(p) for p in pages])
        self.levels = []
        first, last = np.concatenate([[0], ends[:-1]]), ends
        low, high = self.points, self.points
        least, most = self.labels, self.labels
        while True:
            low, high = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
            least, most = np.minimum.reduceat(least, first), np.maximum.reduceat(most, first)
            self.levels.append((first, last, low, high, least, most))
            if len(first) == 1:
                break
            first = np.arange(0, len(first), FAN)
            last = np.minimum(first + FAN, len(low))
        self.levels.reverse()

    def intervals(self, level: int, boxes: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product with the points of some boxes, from
        the per-coordinate intervals of their corners."""
        _, _, low, high, _, _ = self.levels[level]
        a, b = low[boxes] * query, high[boxes] * query
        return np.minimum(a, b).sum(axis=1), np.maximum(a, b).sum(axis=1)

    def search(self, query: np.ndarray, label: int, own_id: int, windows: list[tuple[int, int, int | None]], k: int,
               same_label: bool) -> list[list[tuple[int, int]]]:
        """For each window (least score, largest score, score below which
        nothing is wanted), the k best (score, id) within it, highest scores
        first, ties by smaller id, among the points of the same label (those
        of ``own_id`` aside) or of other labels.

        One best-first queue serves all windows: a box is left out if for each
        window its interval lies outside or strictly below the k-th score."""
        least = np.array([w[0] if w[2] is None else max(w[0], w[2]) for w in windows])
        most = np.array([w[1] for w in windows])
        best: list[list[tuple[int, int]]] = [[] for _ in windows]
        query = query.astype(self.points.dtype)
        queue: list[tuple[int, int, int, int]] = []

        def push(level: int, boxes: np.ndarray) -> None:
            _, _, _, _, label_low, label_high = self.levels[level]
            one = (label_low[boxes] == label) & (label_high[boxes] == label)
            boxes = boxes[((label_low[boxes] <= label) & (label_high[boxes] >= label)) if same_label else ~one]
            lows, highs = self.intervals(level, boxes, query)
            wanted = ((highs[:, None] >= least) & (lows[:, None] <= most)).any(axis=1)
            for i in np.flatnonzero(wanted):
                heapq.heappush(queue, (-int(highs[i]), int(lows[i]), level, int(boxes[i])))

        push(0, np.zeros(1, np.int64))
        while queue:
            up, low, level, box = heapq.heappop(queue)
            if -up < least.min():
                break  # so are all that remain
            if not ((-up >= least) & (low <= most)).any():
                continue
            first, last = self.levels[level][0][box], self.levels[level][1][box]
            if level + 1 < len(self.levels):
                push(level + 1, np.arange(first, last))
                continue
            rows = slice(first, last)
            fits = self.labels[rows] == label
            fits = fits & (self.ids[rows] != own_id) if same_label else ~fits
            scores = self.points[rows] @ query
            hits = fits & (scores >= least[:, None]) & (scores <= most[:, None])
            for w in np.flatnonzero(hits.any(axis=1)):
                found = best[w] + list(zip(scores[hits[w]].astype(np.int64).tolist(),
                                           self.ids[rows][hits[w]].tolist()))
                found.sort(key=lambda x: (-x[0], x[1]))
                best[w] = found[:k]
                if len(best[w]) == k:
                    least[w] = max(least[w], best[w][-1][0])
        return best
