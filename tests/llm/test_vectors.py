"""Hard negatives and vector codes against plain versions, and the trees alone."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import code_compression, hard_negatives
from tidewater.llm.ball_tree import BallTree
from tidewater.llm.str_tree import STRTree


SCHEMA = "vec_id long, embedding array<float>, label int, size int, v int, x int, shard int, error int, code string"


def table(spark, rows, parts=4):
    out = [(i, v, y, 1, 2, 3, 4, 5, "c") for i, v, y in rows]
    return spark.createDataFrame(out, SCHEMA).repartition(parts)


def vectors(n, dim=32, seed=1, labels=4):
    r = np.random.default_rng(seed)
    centers = r.normal(0, 0.2, (6, dim))
    rows = []
    for i in range(n):
        v = (centers[r.integers(6)] + r.normal(0, 0.08, dim)).astype(np.float32)
        if i % 5 == 0:
            v = np.round(v, 1).astype(np.float32)
        rows.append((i, v.tolist(), int(r.integers(labels))))
    rows += [(n + k, rows[3][1], rows[3][2]) for k in range(40)]  # one very common vector
    rows += [(n + 50, None, 1), (n + 51, [0.5] * dim, None), (n + 52, [None] + [0.5] * (dim - 1), 1),
             (n + 53, [float("nan")] * dim, 1), (n + 54, [float("inf")] + [0.1] * (dim - 1), 1), (n + 55, [], 2),
             (n + 56, [0.5, -0.25], 3), rows[7]]
    return rows


def whole(v):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(256 * float(np.float32(x))) for x in v]


def plain_negatives(rows, every=100):
    kept = [(i, whole(v), y) for i, v, y in rows if i is not None and y is not None and whole(v) is not None]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, v, y in {r[0]: r for r in reversed(kept) if r[0] % every == 0}.values():
        ranked = sorted(((-dot(v, w), j, z) for j, w, z in kept), key=lambda x: x[:2])
        for p, pid, _ in [x for x in ranked if x[2] == y and x[1] != i][:5]:
            inside = [x for x in ranked if x[2] != y and 30 * -p <= 100 * -x[0] <= 90 * -p][:10]
            out += [(i, pid, k + 1, j, -p, -s) for k, (s, j, _) in enumerate(inside)]
    return sorted(out)


def got(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score)
                  for r in df.collect())


@pytest.mark.parametrize("shard_rows", [60, 10_000])
def test_hard_negatives_match_all_scores(spark, shard_rows):
    rows = vectors(600) + [(None, [0.1] * 32, 1)]
    found = got(hard_negatives.mine(table(spark, rows), F.col("vec_id") % 100 == 0, shard_rows=shard_rows))
    assert found == plain_negatives(rows) and len(found) > 100


def test_hard_negatives_of_few_rows(spark):
    for rows in ([], [(1, [0.5], 1)], [(0, [0.5], 1)], [(0, [0.5], 1), (1, [0.5], 1), (2, [0.3], 2)],
                 [(0, [], 1), (1, [], 1), (2, [], 2)], [(0, [-0.5], 1), (1, [0.5], 1), (2, [0.3], 2)]):
        assert got(hard_negatives.mine(table(spark, rows, 1), F.col("vec_id") % 100 == 0)) == plain_negatives(rows)


@pytest.mark.parametrize("exact_float", [False, True])
def test_str_tree_finds_what_a_scan_finds(exact_float):
    r = np.random.default_rng(5)
    points = r.integers(-90, 90, (3000, 12))
    labels, ids = np.sort(r.integers(0, 3, 3000)), r.permutation(3000)
    tree = STRTree(ids, labels, points, exact_float)
    assert sorted(tree.ids.tolist()) == list(range(3000))
    for q in range(20):
        query, window = points[q], (-4000 + 700 * q, 9000 + 500 * q, None if q % 2 else -1000)
        score = points @ query
        for same in (True, False):
            fits = (labels == 1) & (ids != 7) if same else labels != 1
            want = sorted((-int(s), int(i)) for s, i, f in zip(score, ids, fits)
                          if f and max(window[0], window[2] or window[0]) <= s <= window[1])[:9]
            found = tree.search(query, 1, 7, [window, window], 9, same)
            assert [[(-s, i) for s, i in x] for x in found] == [want, want]


def plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, whole(v), y) for i, v, y in rows if whole(v) is not None]
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts))
    points = np.array([v + [0] * (parts * width - len(v)) for _, v, _ in kept], dtype=object)
    points = points.reshape(len(kept), parts, width)
    first = {}
    for (i, _, _), p in sorted(zip(kept, points.tolist()), key=lambda x: (x[0][0] is None, x[0][0] or 0, x[0][1])):
        if i is not None:
            first.setdefault(i, p)
    start = list(first.values())[:entries]
    book = [[list(v[p]) for v in start] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book[p]))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for x in points[:, p].tolist():
                own.setdefault(nearest(p, x)[1], []).append(x)
            for k, xs in own.items():
                book[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    out = []
    for (i, _, y), x in zip(kept, points.tolist()):
        near = [nearest(p, x[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in near), sum(d for d, _ in near), y))
    total = {}
    for *_, e, y in out:
        total[y] = total.get(y, 0) + e
    flat = ",".join(str(c) for part in book for e in part for c in e)
    return sorted(((i, c, e, total[y]) for i, c, e, y in out), key=str), hashlib.sha256(flat.encode()).hexdigest()


@pytest.mark.parametrize("shard_rows", [100, 10_000])
def test_codes_match_plain_refinement(spark, shard_rows):
    rows = vectors(400) + [(None, [0.1] * 32, None)]
    df, book = code_compression.compress(table(spark, rows), shard_rows=shard_rows)
    found = sorted([(r.vec_id, r.code, r.error, r.label_error) for r in df.collect()], key=str)
    want, digest = plain_codes(rows)
    assert found == want
    assert code_compression.digest(book) == digest


def test_codes_of_few_rows(spark):
    for rows in ([(1, [0.5, 0.25], None)], [(5, [], 1)], [(3, [0.1] * 20, 1), (3, [0.1] * 20, 1), (1, [0.2] * 20, 2)]):
        df, book = code_compression.compress(table(spark, rows, 1))
        want, digest = plain_codes(rows)
        assert sorted([(r.vec_id, r.code, r.error, r.label_error) for r in df.collect()], key=str) == want
        assert code_compression.digest(book) == digest
    df, book = code_compression.compress(table(spark, [(1, None, 2)], 1))
    assert df.collect() == [] and book.size == 0


@pytest.mark.parametrize("spread", [3, 400])
def test_ball_tree_assigns_as_a_scan_does(spread):
    """Small spreads have many equal points and ties."""
    r = np.random.default_rng(spread)
    points = r.integers(-spread, spread, (2500, 4))
    entries = np.concatenate([r.integers(-spread, spread, (30, 4)), points[:3], points[:3]])
    tree = BallTree(points)
    assert sorted(tree.order.tolist()) == list(range(2500))
    want = ((points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert np.array_equal(tree.assign(entries), want)
    counts, sums, calls = np.zeros(36, int), np.zeros((36, 4), int), []

    def owned(k, n, total):
        counts[k] += n
        sums[k] += total
        calls.append(n)
    tree.assign(entries, owned)
    assert np.array_equal(counts, np.bincount(want, minlength=36))
    assert np.array_equal(sums, [points[want == k].sum(axis=0) for k in range(36)])
    assert max(calls) > 1


