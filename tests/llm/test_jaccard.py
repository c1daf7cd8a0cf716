"""N-gram Jaccard join against all pairs of a small table."""

import numpy as np
import pytest

from tidewater.llm import jaccard, prefix_tree

from .helpers import awkward, frame, prose, rng, words


def shingles(text, n=5):
    w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in words(text)]
    return {tuple(w[i: i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    label = list(range(len(sets)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                label[max(find(a), find(b))] = min(find(a), find(b))
    out = []
    for k, (i, s) in enumerate(sets):
        ids = [sets[j][0] for j in range(len(sets)) if find(j) == find(k) and sets[j][0] is not None]
        out.append((i, len(s), min(ids, default=None) if s else i))
    return sorted(out, key=str)


def corpus():
    r = rng()
    rows, i = [], 0
    for _ in range(12):
        base = prose(r, r.choice([3, 6, 30, 120, 400])).split()
        for _ in range(r.choice([1, 2, 5, 9])):
            copy = list(base)
            for _ in range(r.randrange(0, max(1, len(copy) // 25) + 1)):
                copy[r.randrange(len(copy))] = f"edit{r.randrange(99)}"
            i += 1
            rows.append((i * 7 % 1000, (" " if i % 3 else "\n").join(copy).upper() if i % 4 == 0 else " ".join(copy)))
    rows += [(800 + k, "a very common passage that many documents share in full " + prose(r, 40)) for k in range(10)]
    return rows + [(a, b) for a, b, *_ in awkward()]


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_matches_all_pairs(spark):
    rows = corpus()
    docs = frame(spark, [(i, t, None, None, None) for i, t in rows])
    assert got(jaccard.jaccard_groups(docs)) == components(rows)


def test_groups_over_a_block_are_split_without_loss(spark, monkeypatch):
    """A chain of copies, each near the next only, over many small blocks."""
    r = rng(5)
    base = prose(r, 100, 10_000).split()
    rows = []
    for k in range(25):
        rows.append((k + 1, " ".join(base)))
        base[(k * 4) % 100] = f"edit{k}"
    monkeypatch.setattr(jaccard, "BLOCK_ITEMS", 300)
    monkeypatch.setattr(jaccard, "BUCKET_ITEMS", 100)
    docs = frame(spark, [(i, t, None, None, None) for i, t in rows], clash=False)
    assert got(jaccard.jaccard_groups(docs)) == components(rows)


def test_a_shingle_in_a_third_of_all_documents_is_dealt_by_class(spark, monkeypatch):
    r = rng(6)
    common = "one very common passage that a third of all documents hold in full length and word by word"
    rows = []
    for i in range(150):
        body = prose(r, 12 if i % 5 else 80, 3000)
        rows += [(3 * i, body), (3 * i + 1, common + " " + prose(r, r.choice([2, 40]), 3000))]
        if i % 7 == 0:
            rows.append((3 * i + 2, body + " tail"))
    docs = frame(spark, [(i, t, None, None, None) for i, t in rows], clash=False)
    hot = []
    real = jaccard.hot_items
    monkeypatch.setattr(jaccard, "hot_items", lambda table: hot.append(real(table)) or hot[-1])
    monkeypatch.setattr(jaccard, "BUCKET_ITEMS", 500)
    monkeypatch.setattr(jaccard, "SMALL", 16)
    assert got(jaccard.jaccard_groups(docs)) == components(rows)
    assert len(hot[0]) >= 10


def test_structured_words_do_not_meet():
    """Complementary Thue-Morse words, on which polynomial hashes modulo 2^64 agree whatever their base."""
    a = b"a"
    for _ in range(10):
        a += a.translate(bytes.maketrans(b"ab", b"ba"))
    b = a.translate(bytes.maketrans(b"ab", b"ba"))
    assert jaccard.shingle_set(a.decode())[0] != jaccard.shingle_set(b.decode())[0]


def test_the_border_counts_as_a_link(spark):
    a = [f"x{k}" for k in range(11)]  # 7 shingles
    rows = [(1, " ".join(a)), (2, " ".join(a[:-1])), (3, " ".join(["y", *a[:-1]]))]
    docs = frame(spark, [(i, t, None, None, None) for i, t in rows], clash=False)
    assert got(jaccard.jaccard_groups(docs)) == components(rows)
    assert 100 * len(shingles(rows[0][1]) & shingles(rows[2][1])) == 75 * 8


def test_empty_table(spark):
    assert jaccard.jaccard_groups(frame(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_tree_finds_the_partners_of_all_pairs(seed):
    r = np.random.default_rng(seed)
    sets = [np.unique(r.integers(0, 30, r.integers(1, 25))).astype(np.uint64) for _ in range(60)]
    tree = prefix_tree.PrefixTree(sets, np.array([len(x) for x in sets]))
    for i, place in enumerate(tree.order):
        x = set(sets[place].tolist())
        want = {j for j, p in enumerate(tree.order)
                if 100 * len(x & set(sets[p].tolist())) >= 75 * len(x | set(sets[p].tolist()))}
        assert set(tree.partners(i, np.ones(len(sets), bool), 75).tolist()) == want
