"""Repeated byte spans against a count of all windows of a small table."""

import hashlib

import pytest

from tidewater.llm import suffix_dedup

from .helpers import awkward, frame, prose, rng


def brute(rows, span):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = {}
    for k, (_, b) in enumerate(texts):
        for s in range(len(b) - span + 1):
            seen.setdefault(b[s: s + span], []).append((k, s))
    out = []
    for k, (i, b) in enumerate(texts):
        gone = bytearray(len(b))
        for s in range(len(b) - span + 1):
            if len(seen[b[s: s + span]]) > 1:
                gone[s: s + span] = b"\1" * span
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def corpus():
    r = rng(8)
    passages = [prose(r, 30, 5000) for _ in range(5)]
    rows = []
    for i in range(40):
        parts = [prose(r, r.randrange(0, 30), 5000)]
        for _ in range(r.randrange(0, 3)):
            p = r.choice(passages)
            parts += [p[r.randrange(20):len(p) - r.randrange(20)], prose(r, r.randrange(0, 6), 5000)]
        rows.append((i, r.choice([" ", "", "\n"]).join(parts)))
    rows += [(50, "ab" * 200), (51, "a" * 300), (52, "é€" * 40 + passages[0]), (53, passages[0])]
    return rows + [(a, b) for a, b, *_ in awkward()]


@pytest.mark.parametrize("max_kinds", [2000, 1])
def test_matches_a_count_of_windows(spark, max_kinds):
    rows = corpus()
    docs = frame(spark, [(i, t, None, None, None) for i, t in rows])
    got = suffix_dedup.remove_repeats(docs, span=40, gram=12, max_kinds=max_kinds).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest())
                   for r in got), key=str) == brute(rows, 40)


def test_periodic_and_multi_piece_texts(spark, monkeypatch):
    """Texts over many pieces and sorts, periodic ones among them, and a passage in a third of all documents."""
    monkeypatch.setattr(suffix_dedup, "PIECE", 70)
    monkeypatch.setattr(suffix_dedup, "SORT_BYTES", 200)
    monkeypatch.setattr(suffix_dedup, "TASK_BYTES", 1000)
    r = rng(11)
    common = prose(r, 25, 5000)
    rows = [(i, prose(r, 40, 5000) + (f" {common[i % 7:]} " if i % 3 == 0 else "") + prose(r, 10, 5000)) for i in range(45)]
    rows += [(90, "abc" * 300), (91, "abc" * 100 + "x" + "bca" * 100), (92, "z" * 500), (93, "abcabd" * 60)]
    docs = frame(spark, [(i, t, None, None, None) for i, t in rows])
    got = suffix_dedup.remove_repeats(docs, span=40, gram=12).collect()
    assert sorted(((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, hashlib.sha256(bytes(x.kept)).hexdigest())
                   for x in got), key=str) == brute(rows, 40)


def test_factor_step_memory_of_a_task():
    """A task of TASK_BYTES whose anchors fill one sort each stays far below a worker's share."""
    import tracemalloc

    import numpy as np
    import pandas as pd
    r = np.random.default_rng(2)
    rows = []
    for k in range(suffix_dedup.TASK_BYTES // 700):
        rows.append((k // 300, k, 0, 0, r.integers(97, 101, 700).astype(np.uint8).tobytes()))
    group = pd.DataFrame(rows, columns=["key", "doc_id", "text_hash", "start", "data"])
    tracemalloc.start()
    suffix_dedup._factors(400)(group)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20


def test_first_copy_stays(spark):
    p = prose(rng(), 40, 9999)
    docs = frame(spark, [(2, "x " + p, None, None, None), (1, p + " y", None, None, None), (3, p, None, None, None)])
    kept = {r.doc_id: bytes(r.kept) for r in
            suffix_dedup.remove_repeats(docs, span=40, gram=12, keep_first=True).collect()}
    assert kept == {1: (p + " y").encode(), 2: b"x ", 3: b""}


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(frame(spark, [])).collect() == []
