"""Cumulative-link (proportional-odds) regression on sparse hashed text features.

One weight vector w is shared by all grades; ordered thresholds t_1 < t_2 < ...
split the score w.x into grades: P(grade <= k) = sigmoid(t_k - w.x).  Features
are the distinct hash buckets of a whole text, of one of two kinds: ``words``
(words and word beginnings) or ``shapes`` (n-grams of letters and of character
shapes, length, repetition).

Fitting takes a bounded sample: MAX_TRAIN_DOCS documents per grade, first in
order of a hash of the id, at most MAX_GRADES grades.  Their features are
extracted in Spark tasks; one task then runs FTRL-proximal descent (sparse
weights by an L1 penalty) over the bounded rows in a fixed order, so reruns
agree.  Prediction broadcasts 2^BITS weights and covers all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ngrams import gram_buckets, letter_codes, mix, range_hashes, windows, words_of
from .storage import pick

BITS = 20
MAX_GRADES = 20
MAX_TRAIN_DOCS = 4_000
LETTER_ORDERS = (4, 5)
SHAPE_ORDERS = (3, 4)
PREFIXES = (4, 5, 6)
#: Bounds of the buckets for the share of words that repeat the word before.
REPEAT_BOUNDS = (0.0, 0.02, 0.1, 0.3)


def shape_codes(text: str) -> np.ndarray:
    """Code points with letters as a or A, digits as 0, other characters kept."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lower = np.frombuffer("".join(c if len(c) == 1 else c[0] for c in map(str.lower, text))
                          .encode("utf-32-le", "surrogatepass"), dtype=np.uint32) if not text.isascii() else \
        np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
    out = codes.copy()
    out[codes != lower] = ord("A")
    plain = (codes == lower) & (((codes >= 97) & (codes <= 122)) | (codes > 127))
    out[plain] = ord("a")
    out[(codes >= 48) & (codes <= 57)] = ord("0")
    return out


def shape_buckets(text: str) -> Iterator[np.ndarray]:
    """How a text is written: n-grams of its letters and of its character
    shapes, its length, and its share of words that repeat the one before.
    All hash buckets, repeats included, in pieces."""
    for salt, codes, orders in ((0, letter_codes(text), LETTER_ORDERS), (1, shape_codes(text), SHAPE_ORDERS)):
        for n in orders:
            for piece in windows(codes, n - 1):
                yield gram_buckets(piece, n, BITS, salt)
    words = words_of(text)
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    share = repeats / max(1, len(words) - 1)
    bucket = sum(share > b for b in REPEAT_BOUNDS)
    marks = np.array([1 << 40 | len(words).bit_length(), 1 << 41 | bucket], dtype=np.uint64)
    yield (mix(marks) >> np.uint64(64 - BITS)).astype(np.int64)


def word_buckets(text: str) -> Iterator[np.ndarray]:
    """What a text says: its lower-cased words and their first letters, which
    the forms of one stem share."""
    codes = letter_codes(text)
    spaces = np.flatnonzero(codes == 32)
    starts, ends = spaces[:-1] + 1, spaces[1:]
    for k in (None, *PREFIXES):
        h = range_hashes(codes, starts, ends if k is None else np.minimum(ends, starts + k))
        with np.errstate(over="ignore"):
            yield (mix(h + np.uint64(k or 0)) >> np.uint64(64 - BITS)).astype(np.int64)


BUCKETS = {"shapes": shape_buckets, "words": word_buckets}


def features(text: str | None, kind: str) -> np.ndarray:
    """Distinct buckets of a whole text; none for a null text."""
    if text is None:
        return np.zeros(0, np.int32)
    return np.unique(np.concatenate([np.unique(b) for b in BUCKETS[kind](text)])).astype(np.int32)


@dataclass
class Model:
    kind: str
    grades: list[int]
    thresholds: np.ndarray
    weights: np.ndarray

    def probabilities(self, score: float) -> np.ndarray:
        """P(grade) for each grade, in order."""
        below = _sigmoid(self.thresholds - score)
        return np.diff(np.concatenate([[0.0], below, [1.0]]))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, dtype=np.float64)))


def _thresholds(raw: np.ndarray) -> np.ndarray:
    """First value free, further gaps positive, hence ordered."""
    return np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))


def descend(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, epochs: int = 6, batch: int = 32,
            alpha: float = 0.1, l1: float = 1.0, l2: float = 1.0, step: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal weights and ordered thresholds for rows of feature ids."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    raw = np.zeros(n_grades - 1)
    if n_grades > 2:
        raw[0], raw[1:] = -1.0, np.log(2.0 / max(1, n_grades - 2))
    seen = np.zeros_like(raw)

    def weights(ids: np.ndarray) -> np.ndarray:
        zi = z[ids]
        return np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / (l2 + (1 + np.sqrt(n[ids])) / alpha))

    rng = np.random.default_rng(7)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            part = order[at: at + batch]
            lengths = [len(rows[i]) for i in part]
            ids, inverse = np.unique(np.concatenate([rows[i] for i in part]), return_inverse=True)
            owner = np.repeat(np.arange(len(part)), lengths)
            w = weights(ids)
            score = np.bincount(owner, w[inverse], minlength=len(part))
            t = _thresholds(raw)
            edges = np.concatenate([[-np.inf], t, [np.inf]])
            k = grades[part]
            low, high = _sigmoid(edges[k] - score), _sigmoid(edges[k + 1] - score)
            slope = 1 - high - low  # of the loss, by the score
            g = np.bincount(inverse, slope[owner], minlength=len(ids))
            sigma = (np.sqrt(n[ids] + g * g) - np.sqrt(n[ids])) / alpha
            z[ids] += g - sigma * w
            n[ids] += g * g
            p = np.maximum(high - low, 1e-9)
            by_edge = np.zeros(n_grades + 1)
            np.add.at(by_edge, k + 1, -high * (1 - high) / p)
            np.add.at(by_edge, k, low * (1 - low) / p)
            by_t = by_edge[1:-1]
            g_raw = np.cumsum(by_t[::-1])[::-1].copy()  # each gap moves all later thresholds
            g_raw[1:] *= np.exp(raw[1:])
            seen += g_raw ** 2
            raw -= step * g_raw / np.sqrt(seen + 1e-6)
    return weights(np.arange(1 << BITS)), _thresholds(raw)


def fit(docs: DataFrame, ratings: DataFrame, kind: str, text: str = "text", doc_id: str = "doc_id",
        grade: str = "grade", max_train_docs: int = MAX_TRAIN_DOCS, **options) -> Model:
    """Fit on the rated documents.  Null ids, texts and grades teach nothing;
    of several ratings of a document the highest counts.  Fewer than two
    grades give a model without weights that always predicts the one grade
    (0 without any)."""
    rated = (pick(ratings, doc_id=doc_id, grade=grade).where("doc_id is not null and grade is not null")
             .groupBy("doc_id").agg(F.max(F.col("grade").cast("int")).alias("grade")))
    known = sorted(r["grade"] for r in rated.select("grade").distinct().limit(MAX_GRADES + 1).collect())
    if len(known) > MAX_GRADES:
        raise ValueError(f"more than {MAX_GRADES} grades")
    if len(known) < 2:
        return Model(kind, known or [0], np.zeros(0), np.zeros(1 << BITS, np.float32))
    sample = None
    for k, g in enumerate(known):
        first = (rated.where(F.col("grade") == g).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_docs)
                 .select("doc_id", F.lit(k).alias("k")))
        sample = first if sample is None else sample.unionByName(first)
    # At most MAX_GRADES x max_train_docs ids, 16 bytes each.
    rows = pick(docs, doc_id=doc_id, text=text).where("text is not null").join(F.broadcast(sample), "doc_id")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "k": b["k"],
                                "ids": [features(t, kind).tobytes() for t in b["text"]]})

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "ids"]).drop_duplicates("doc_id")
        found = [np.frombuffer(x, np.int32) for x in group["ids"]]
        w, t = descend(found, group["k"].to_numpy(), len(known), **options)
        return pd.DataFrame({"weights": [w.astype(np.float32).tobytes()], "thresholds": [t.tobytes()]})

    fitted = (rows.mapInPandas(extract, "doc_id long, k int, ids binary")
              .groupBy(F.lit("all")).applyInPandas(learn, "weights binary, thresholds binary").collect())
    if not fitted:
        return Model(kind, [known[0]], np.zeros(0), np.zeros(1 << BITS, np.float32))
    return Model(kind, known, np.frombuffer(fitted[0]["thresholds"]), np.frombuffer(fitted[0]["weights"], np.float32))


def score_text(text: str | None, weights: np.ndarray, kind: str) -> float:
    """w.x over the distinct buckets of the whole text."""
    if not text:
        return 0.0
    used = [b[weights[b] != 0] for b in BUCKETS[kind](text)]
    ids = np.unique(np.concatenate(used))
    return float(weights[ids].sum(dtype=np.float64))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with expected_grade, grade_pred (the most probable grade) and
    tail_probabilities (P(grade >= g) for each grade but the lowest, in
    order).  A null or empty text scores as one without features, 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("expected_grade double, grade_pred int, tail_probabilities array<double>")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        levels = np.array(m.grades, dtype=float)
        for batch in batches:
            out = []
            for value in batch:
                p = m.probabilities(score_text(value, m.weights, m.kind))
                tails = np.cumsum(p[::-1])[::-1][1:]
                out.append((round(float(levels @ p), 6), m.grades[int(np.argmax(p))], np.round(tails, 6).tolist()))
            yield pd.DataFrame(out, columns=["expected_grade", "grade_pred", "tail_probabilities"])

    made = ["expected_grade", "grade_pred", "tail_probabilities"]
    keep = [c for c in docs.columns if c not in made]
    return (docs.withColumn("__rate__", rate(F.col(f"`{text}`")))
            .select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"__rate__.{c}") for c in made]))
