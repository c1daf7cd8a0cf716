"""SimHash near-dedup against all pairs, with Spark's own XXH64."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import simhash

from .helpers import awkward, frame, prose, rng, words

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=3):
    w = [x.translate(UPPER) for x in words(text)]
    return [" ".join(w[i: i + n]) for i in range(max(1, len(w) - n + 1))] if w else []


def by_spark(spark, texts):
    """Fingerprints from Spark's xxhash64 (seed 42) of every shingle."""
    rows = [(i, s) for i, t in enumerate(texts) for s in shingles(t)]
    h = spark.createDataFrame(rows, "i int, s string").select("i", F.xxhash64("s").alias("h")).collect()
    out = []
    for i in range(len(texts)):
        own = [r.h for r in h if r.i == i]
        out.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in own) > len(own)))
    return out


def components(fps, ids, bits=2):
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                label[max(find(a), find(b))] = min(find(a), find(b))
    return [min((ids[j] for j in range(len(fps)) if find(j) == find(k) and ids[j] is not None), default=None)
            for k in range(len(fps))]


def test_matches_all_pairs(spark):
    r = rng(8)
    rows = [(i, t) for i, t, *_ in awkward()]
    for k in range(30):
        base = prose(r, r.choice([1, 2, 3, 9, 60, 400])).split()
        for j in range(r.choice([1, 2, 4])):
            copy = list(base)
            for _ in range(r.randrange(0, 3)):
                copy[r.randrange(len(copy))] = f"edit{r.randrange(9)}"
            rows.append((10_000 - 10 * k - j, ("\x0b" if k % 3 else " ").join(copy).upper() if j % 2 else
                         " ".join(copy)))
    fps = by_spark(spark, [t for _, t in rows])
    want = sorted(zip([i for i, _ in rows], fps, components(fps, [i for i, _ in rows])), key=str)
    docs = frame(spark, [(i, t, None, None, None) for i, t in rows])
    got = sorted([(x.doc_id, x.fp % (1 << 64), x.component_id) for x in simhash.simhash_groups(docs).collect()],
                 key=str)
    assert got == want
    assert len({c for *_, c in want}) < len({f for _, f, _ in want})  # some are linked without being equal


def test_a_very_long_text_in_pieces():
    text = prose(rng(2), 30_000) + " " + "y" * 5000 + " Z \t" + prose(rng(4), 500)
    want = [s.encode() for s in shingles(text)]
    for piece in (7, 1000, 1 << 20):
        found = [b" ".join(x[i: i + 3]) for x in simhash.word_pieces(text.encode(), 3, piece)
                 for i in range(len(x) - 2)]
        assert found == want
    whole = simhash.fingerprint(text)
    simhash.PIECE, before = 100, simhash.PIECE
    try:
        assert simhash.fingerprint(text) == whole
    finally:
        simhash.PIECE = before


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_any_close_pair_shares_a_bucket_of_both_steps(bits):
    r = np.random.default_rng(bits)
    coarse, fine, most = simhash.plan(bits)
    assert most <= (1 << 8 if bits == 2 else 1 << 12)
    for _ in range(300):
        flip = sum(1 << int(b) for b in r.choice(64, bits, replace=False))
        shared = [k for k, m in enumerate(coarse) if not flip & m]
        assert shared
        assert all(any(not flip & m for m in fine[k]) for k in shared)
        assert all(m & coarse[k] == coarse[k] for k in shared for m in fine[k])


def test_a_hot_bucket_is_cut_and_loses_no_link(spark):
    """A third of a dense cloud of near fingerprints, in one bucket of step 2."""
    r = np.random.default_rng(1)
    base = 0x0123456789ABCDEF
    fps = {base}
    while len(fps) < 900:
        x = base
        for b in r.choice(24, r.integers(1, 7), replace=False):
            x ^= 1 << int(b)
        fps.add(x)
    far = {int(x) for x in r.integers(0, 2**63, 300)}
    values = sorted(fps | far)
    assert max(np.unique([v & simhash.plan(2)[0][0] for v in values], return_counts=True)[1]) > 256
    table = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    links = [(x.a % (1 << 64), x.b % (1 << 64)) for x in simhash.close_pairs(table).collect()]
    assert all((a ^ b).bit_count() for a, b in links)
    place = {v: i for i, v in enumerate(values)}
    label = list(range(len(values)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for a, b in links:
        x, y = find(place[a]), find(place[b])
        label[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(values))] == components(values, list(range(len(values))))


def test_empty_table(spark):
    assert simhash.simhash_groups(frame(spark, [])).collect() == []
