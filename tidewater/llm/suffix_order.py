"""Suffix order and longest-previous-factor arrays of a bounded byte string."""

from __future__ import annotations

import numpy as np

FIRST = 8


class SuffixOrder:
    """Ranks of the substrings of 8, 16, ... bytes at every position, by prefix
    doubling, and of ``cap`` bytes, which orders the suffixes as far as that.
    Memory: 4 bytes a position and level kept; without ``levels`` only the last
    one is, which is enough to see matches of ``cap`` bytes."""

    def __init__(self, data: np.ndarray, cap: int, levels: bool = True):
        self.data, self.cap = data, cap
        n = len(data)
        padded = np.concatenate([data, np.zeros(FIRST, np.uint8)])
        word = np.zeros(n, np.uint64)
        for k in range(FIRST):
            word = (word << np.uint64(8)) | padded[k: k + n]
        self.levels = [(FIRST, self._rank(word))]
        length = FIRST
        while length * 2 <= cap:
            self.levels.append((length * 2, self._pair(self.levels[-1][1], self.levels[-1][1], length)))
            length *= 2
            if not levels:
                del self.levels[0]
        self.rank = self.levels[-1][1] if length == cap else self._pair(
            self.levels[-1][1], self.levels[-1][1], cap - length)
        if not levels:
            self.levels = []

    @staticmethod
    def _rank(keys: np.ndarray) -> np.ndarray:
        order = np.argsort(keys, kind="stable")
        new = np.ones(len(keys), bool)
        new[1:] = keys[order[1:]] != keys[order[:-1]]
        rank = np.empty(len(keys), np.int32)
        rank[order] = np.cumsum(new)
        return rank

    def _pair(self, left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
        n = len(left)
        behind = np.zeros(n, np.int64)
        if shift < n:
            behind[: n - shift] = right[shift:]
        return self._rank(left.astype(np.int64) << 32 | behind)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common prefixes, up to ``cap``, of the suffixes at a and b."""
        n, out = len(self.data), np.zeros(len(a), np.int64)
        for length, rank in reversed(self.levels):
            at = np.maximum(a, b) + out + length <= n
            same = np.zeros(len(a), bool)
            same[at] = rank[a[at] + out[at]] == rank[b[at] + out[at]]
            out[same] += length
        for _ in range(FIRST - 1):
            at = np.maximum(a, b) + out < n
            same = np.zeros(len(a), bool)
            same[at] = self.data[a[at] + out[at]] == self.data[b[at] + out[at]]
            if not same.any():
                break
            out[same] += 1
        return np.minimum(out, self.cap)


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each place, the nearest place before it with a smaller value, or
    -1: all candidates jump along each other's until none is larger."""
    out = np.arange(-1, len(values) - 1)
    while True:
        ahead = np.flatnonzero(out >= 0)
        wrong = ahead[values[out[ahead]] >= values[ahead]]
        if not len(wrong):
            return out
        out[wrong] = out[out[wrong]]


def longest_previous_factors(order: SuffixOrder, starts: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each start, the length (up to the cap) of its longest match with a
    start of a smaller ``place``: the better of the previous and the next
    smaller place in suffix order."""
    by_suffix = np.lexsort((place, order.rank[starts]))
    at, sorted_place = starts[by_suffix], place[by_suffix]
    before = nearest_smaller(sorted_place)
    after = len(at) - 1 - nearest_smaller(sorted_place[::-1])[::-1]
    best = np.zeros(len(at), np.int64)
    for other, exists in ((before, before >= 0), (after, after < len(at))):
        i = np.flatnonzero(exists)
        best[i] = np.maximum(best[i], order.common(at[i], at[other[i]]))
    out = np.empty(len(at), np.int64)
    out[by_suffix] = best
    return out


def reached_both_ways(order: SuffixOrder, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each start, whether its longest previous factor has ``cap`` bytes
    or more, in rising and in falling order of starts: whether the previous or
    the next smaller (larger) start in suffix order is equal as far as that."""
    by_suffix = np.argsort(order.rank[starts], kind="stable")
    rank, place = order.rank[starts][by_suffix], starts[by_suffix]
    out = []
    for key in (place, -place):
        before = nearest_smaller(key)
        after = len(key) - 1 - nearest_smaller(key[::-1])[::-1]
        hit = (before >= 0) & (rank[before] == rank)
        hit |= (after < len(key)) & (rank[np.minimum(after, len(key) - 1)] == rank)
        flag = np.empty(len(key), bool)
        flag[by_suffix] = hit
        out.append(flag)
    return out[0], out[1]
