"""Benchmark decontamination: rare n-gram seeds, then local alignment.

Word n-grams of the benchmark items are the seeds.  One pass over the corpus
counts in how many documents each occurs; the rarer half of each item's
distinct n-grams (of long items, of every stretch of PIECE n-grams), and all that
at most RARE_SHARE of the documents have, stay.
A second pass looks the seeds up in every document, gathers the hits of an item
that lie on nearby diagonals, and aligns that stretch of the document with the
whole item word by word (Smith-Waterman).  An item's score is the best
alignment's score over that of a verbatim copy; edited and paraphrased copies
lose only what was changed.  A hit has MIN_SCORE, or, of items of which QUOTE_WORDS
words are less than that, a quote: an alignment that scores as much as QUOTE_WORDS
verbatim words when every word changed, added or dropped costs STRICT.  So the
share that is required falls with the length of the item.

The benchmark is a query set of its own: it is taken in blocks of at most
BLOCK_CHARS characters (one item at least), each broadcast, and every block
is held against all documents, whole.  Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ngrams import shingle_hashes, words_of
from .storage import pick

SEED_WORDS = 3
RARE_SHARE = 0.001
MIN_SCORE = 0.5
#: Of all words of the benchmark; larger items get a block each.
BLOCK_CHARS = 4_000_000
#: Hits further apart than this many diagonals (words inserted or dropped) start a new stretch.
MAX_SHIFT = 16
MATCH, MISMATCH, GAP = 2, -1, -1
#: A quote: so many verbatim words, and four more for each that differs (more than 80 % of its words match).
QUOTE_WORDS = 30
STRICT = -8
#: A quote has QUOTE_WORDS - SEED_WORDS + 1 n-grams in a row: some stretch of this many of the item is within it.
PIECE = 14

HIT = T.StructType([T.StructField(n, t) for n, t in (
    ("item_id", T.LongType()), ("score", T.DoubleType()), ("matched_words", T.IntegerType()),
    ("item_words", T.IntegerType()), ("first_word", T.IntegerType()), ("last_word", T.IntegerType()))])


def align(item: np.ndarray, text: np.ndarray, mismatch: int = MISMATCH, gap: int = GAP) -> tuple[int, int, int, int]:
    """Smith-Waterman over word numbers: (score, matches, first, last + 1) of
    the best local alignment, in words of ``text``.  Row by row; gaps within a
    row by a running maximum; memory of four rows."""
    n = len(text)
    column = np.arange(n + 1)
    h = np.zeros(n + 1, np.int64)
    start, hits = column.copy(), np.zeros(n + 1, np.int64)
    best = (0, 0, 0, 0)
    for w in item:
        same = text == w
        diagonal = h[:-1] + np.where(same, MATCH, mismatch)
        up = h[1:] + gap
        take = diagonal >= up
        row = np.concatenate([[0], np.maximum(np.where(take, diagonal, up), 0)])
        new_start = np.concatenate([[0], np.where(take, start[:-1], start[1:])])
        new_hits = np.concatenate([[0], np.where(take, hits[:-1] + same, hits[1:])])
        fresh = row == 0
        new_start[fresh], new_hits[fresh] = column[fresh], 0
        # A gap in the text costs -gap a word: best over j of row[j] + gap * (k - j).
        lifted = row - gap * column
        top = np.maximum.accumulate(lifted)
        origin = np.maximum.accumulate(np.where(lifted == top, column, 0))
        h = top + gap * column
        start, hits = new_start[origin], new_hits[origin]
        k = int(np.argmax(h))
        if h[k] > best[0]:
            best = (int(h[k]), int(hits[k]), int(start[k]), k)
    return best


def is_long(item_words: int, min_score: float) -> bool:
    """Whether a quote can be a hit that is less than ``min_score`` of the item."""
    return QUOTE_WORDS < min_score * item_words


class Seeds:
    """The n-grams of a block of items, in order, and where they occur."""

    def __init__(self, items: list[tuple[int, str | None]], n: int):
        self.ids, self.words, grams, owner, place = [], [], [], [], []
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            g = shingle_hashes(words, n)
            grams.append(g)
            owner.append(np.full(len(g), len(self.ids)))
            place.append(np.arange(len(g)))
            self.ids.append(item_id)
            self.words.append(words)
        cat = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
        self.gram, self.owner, self.place = cat(grams, np.uint64), cat(owner, np.int64), cat(place, np.int64)
        self.distinct = np.unique(self.gram)
        self.n = n

    def look_up(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``grams`` that are seeds, and their numbers in ``distinct``."""
        if not len(self.distinct) or not len(grams):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.distinct, grams), len(self.distinct) - 1)
        found = np.flatnonzero(self.distinct[at] == grams)
        return found, at[found]

    def keep_rare(self, df: np.ndarray, n_docs: int, rare_share: float, min_score: float) -> None:
        """Leave out n-grams that are neither rare in the corpus nor among the
        rarer half of an item's, or of a long item's stretch."""
        number = np.searchsorted(self.distinct, self.gram)
        keep = df[number] <= rare_share * n_docs
        for i in range(len(self.ids)):
            own = np.arange(*np.searchsorted(self.owner, [i, i + 1]))  # owners are in order here
            keep[own] |= df[number[own]] <= np.median(df[number[own]])
            if is_long(len(self.words[i]), min_score):
                for a in range(0, len(own), PIECE):
                    piece = own[a:a + PIECE]
                    keep[piece] |= df[number[piece]] <= np.median(df[number[piece]])
        self.gram, self.owner, self.place = self.gram[keep], self.owner[keep], self.place[keep]
        order = np.argsort(self.gram, kind="stable")
        self.gram, self.owner, self.place = self.gram[order], self.owner[order], self.place[order]
        self.distinct, self.start = np.unique(self.gram, return_index=True)
        self.start = np.append(self.start, len(self.gram))

    def hits(self, text: str | None, min_score: float) -> list[tuple]:
        """(item, score, matched words, item words, first and last word) of the
        items that the text contains, each at its best place."""
        words = words_of(text)
        grams = shingle_hashes(words, self.n)
        at, number = self.look_up(grams)
        if not len(at):
            return []
        counts = self.start[number + 1] - self.start[number]
        source = np.repeat(self.start[number] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        owner, place, position = self.owner[source], self.place[source], np.repeat(at, counts)
        order = np.lexsort((position, position - place, owner))
        owner, place, position = owner[order], place[order], position[order]
        diagonal = position - place
        cut = np.flatnonzero((owner[1:] != owner[:-1]) | (diagonal[1:] - diagonal[:-1] > MAX_SHIFT)) + 1
        best: dict[int, tuple] = {}
        for a, b in zip(np.append(0, cut), np.append(cut, len(owner))):
            i, m = int(owner[a]), len(self.words[owner[a]])
            low, high = int(diagonal[a]) - MAX_SHIFT, int(diagonal[b - 1]) + m + MAX_SHIFT
            low, high = max(0, low), min(len(words), high)
            number_of = {w: k for k, w in enumerate(dict.fromkeys(self.words[i]))}
            item = np.array([number_of[w] for w in self.words[i]])
            stretch = np.array([number_of.get(w, -1) for w in words[low:high]])
            # An upper bound first: no more words can match than occur in the stretch.
            most = np.minimum(np.bincount(stretch[stretch >= 0], minlength=len(number_of)), np.bincount(item)).sum()
            if most < (QUOTE_WORDS if is_long(m, min_score) else min_score * m):
                continue
            score, matched, first, last = align(item, stretch)
            hit = score >= min_score * MATCH * m
            if not hit and is_long(m, min_score):
                score, matched, first, last = align(item, stretch, STRICT, STRICT)
                hit = score >= QUOTE_WORDS * MATCH
            if hit and (i not in best or score > best[i][0]):
                best[i] = (score, matched, low + first, low + last - 1)
        return [(self.ids[i], round(s / (MATCH * len(self.words[i])), 6), k, len(self.words[i]), f, e)
                for i, (s, k, f, e) in sorted(best.items())]


def blocks(items: list[tuple[int, str | None]], most: int) -> Iterator[list]:
    part, size = [], 0
    for row in items:
        length = len(row[1] or "")
        if part and size + length > most:
            yield part
            part, size = [], 0
        part.append(row)
        size += length
    if part:
        yield part


def item_blocks(benchmark: DataFrame, item_id: str, text: str, most: int) -> Iterator[list]:
    """The items in blocks, read one range of ids after another, so that the
    driver holds about one block at a time."""
    rows = pick(benchmark, item_id=item_id, text=text).where("text is not null")
    yield from blocks(((r["item_id"], r["text"]) for r in rows.orderBy("item_id", "text").toLocalIterator()), most)


def _document_counts(texts: DataFrame, seeds: Seeds) -> tuple[np.ndarray, int]:
    """In how many documents each distinct seed occurs, and how many there are."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(seeds)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = shared.value
        total, n = np.zeros(len(s.distinct), np.int64), 0
        for b in batches:
            for t in b["text"]:
                n += 1
                total[np.unique(s.look_up(shingle_hashes(words_of(t), s.n))[1])] += 1
        used = np.flatnonzero(total)
        yield pd.DataFrame({"seed": np.append(used, -1), "n": np.append(total[used], n)})

    df = np.zeros(len(seeds.distinct), np.int64)
    n_docs = 0
    # One row per distinct n-gram of the block at most.
    for seed, n in texts.mapInPandas(count, "seed long, n long").groupBy("seed").agg(F.sum("n")).collect():
        if seed < 0:
            n_docs = n
        else:
            df[seed] = n
    shared.unpersist()
    return df, n_docs


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", n_words: int = SEED_WORDS, min_score: float = MIN_SCORE,
               rare_share: float = RARE_SHARE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with ``leaks``: an array of (item_id, score, matched_words,
    item_words, first_word, last_word) per document, by item, empty if clean.
    Of a long item, a quote is enough; its score can be below ``min_score``.

    Null and blank texts and items have no words and no leaks.  An item with
    fewer than ``n_words`` words is no evidence inside longer prose: it is
    found in a document of just the same words.  Repeated documents
    each get their leaks; repeated items are reported once each.
    """
    texts = pick(docs, text=text).where("text is not null")
    out, columns = docs, [c for c in docs.columns if c != "leaks"]
    made = []
    for k, items in enumerate(item_blocks(benchmark, item_id, item_text, block_chars)):
        seeds = Seeds(items, n_words)
        df, n_docs = _document_counts(texts, seeds)
        seeds.keep_rare(df, n_docs, rare_share, min_score)
        out = out.withColumn(f"__leaks_{k}__", _finder(docs.sparkSession, seeds, min_score)(F.col(f"`{text}`")))
        made.append(F.col(f"__leaks_{k}__"))
    found = F.concat(*made) if made else F.array().cast(T.ArrayType(HIT))
    return out.withColumn("__leaks__", F.array_sort(found)).select(
        *[F.col(f"`{c}`") for c in columns], F.col("__leaks__").alias("leaks"))


def _finder(spark, seeds: Seeds, min_score: float):
    shared = spark.sparkContext.broadcast(seeds)

    @F.pandas_udf(T.ArrayType(HIT))
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        s = shared.value
        for batch in batches:
            yield pd.Series([[dict(zip(HIT.names, h)) for h in s.hits(t, min_score)] for t in batch], dtype=object)

    return find
