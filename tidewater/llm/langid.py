"""Language identification: multinomial naive Bayes over hashed character
n-grams (orders 1-3 over lower-cased letters, other characters as one space).

Fitting counts n-grams per language in Spark tasks and sums them by language
and bucket; the matrix of log probabilities (languages x buckets, float32) is
broadcast, and each batch of texts is scored in numpy by gathering the matrix
rows of the n-grams that occur and adding them up per text.

Bounds: at most MAX_LANGS languages (more are an error) and, for fitting only,
about MAX_TRAIN_DOCS distinct texts per language, picked by a hash of the
text; copies of a text teach once.  The matrix has at most MAX_LANGS x 2^BITS floats.  Prediction covers
every document and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ngrams import gram_buckets, letter_codes, windows
from .storage import pick

ORDERS = (1, 2, 3)
BITS = 15
MAX_LANGS = 200
MAX_TRAIN_DOCS = 20_000
SMOOTHING = 0.1
UNKNOWN = "und"


def _buckets(text: str) -> Iterator[np.ndarray]:
    codes = letter_codes(text)
    for n in ORDERS:
        for piece in windows(codes, n - 1):
            yield gram_buckets(piece, n, BITS)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    totals: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"]):
            if not has_letter(text):
                continue
            if lang not in totals:
                totals[lang] = np.zeros(1 << BITS, np.int64)
            docs[lang] = docs.get(lang, 0) + 1
            for b in _buckets(text):
                totals[lang] += np.bincount(b, minlength=1 << BITS)
    for lang, counts in totals.items():
        used = np.flatnonzero(counts)
        yield pd.DataFrame({"lang": lang, "bucket": np.append(used, -1),
                            "n": np.append(counts[used], docs[lang])})


def _log_probs(group: pd.DataFrame) -> pd.DataFrame:
    counts = np.zeros(1 << BITS)
    docs = 0
    for b, n in zip(group["bucket"].to_numpy(), group["n"].to_numpy()):
        if b < 0:
            docs = int(n)
        else:
            counts[b] = n
    counts += SMOOTHING
    row = np.log(counts / counts.sum()).astype(np.float32)
    return pd.DataFrame({"lang": [group["lang"].iloc[0]], "docs": [docs], "row": [row.tobytes()]})


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang",
        max_train_docs: int = MAX_TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the matrix whose row i holds log P(bucket | language i).

    Rows with a null text or language, or without a letter, teach nothing; an
    empty table gives no languages.  The class prior is uniform.  More than
    MAX_LANGS languages are a ValueError: none is left out unseen.
    """
    rows = pick(labelled, text=text, lang=lang).where("text is not null and lang is not null")
    # Languages are few; MAX_LANGS + 1 rows reach the driver at most.  Texts are counted by their hashes.
    sizes = (rows.select("lang", F.xxhash64("text").alias("text")).distinct()
             .groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS + 1).collect())
    if not sizes:
        return [], np.zeros((0, 1 << BITS), np.float32)
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages to learn")
    share = F.create_map(*[x for r in sizes for x in
                           (F.lit(r["lang"]), F.lit(min(1.0, max_train_docs / r["count"])))])
    unit = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # The hash takes or leaves all copies of a text, so only what is taken is made distinct.
    sample = rows.where(unit < F.try_element_at(share, F.col("lang"))).distinct()
    counts = (sample.mapInPandas(_count, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    found = counts.groupBy("lang").applyInPandas(_log_probs, "lang string, docs long, row binary").collect()
    found.sort(key=lambda r: r["lang"])
    if not found:
        return [], np.zeros((0, 1 << BITS), np.float32)
    return [r["lang"] for r in found], np.stack([np.frombuffer(r["row"], np.float32) for r in found])


def score_text(text: str, matrix: np.ndarray) -> tuple[np.ndarray, int]:
    """Log likelihood of the whole text under each language, and its number of
    n-grams; matrix is (buckets, languages), so that one n-gram's values lie
    together."""
    total, n = np.zeros(matrix.shape[1]), 0
    for b in _buckets(text):
        total += matrix[b].sum(axis=0, dtype=np.float64)
        n += len(b)
    return total, n


def own_range(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per language (matrix row), the mean log probability of an n-gram of its
    own texts, and that of one it has never seen."""
    logs = matrix.astype(np.float64)
    return (np.exp(logs) * logs).sum(axis=1), logs.min(axis=1)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text",
            with_fit: bool = False) -> DataFrame:
    """``docs`` with lang_pred, score (posterior of the predicted language) and,
    for ``with_fit``, fit: the mean log probability of the text's n-grams in
    that language, from 0 (all unseen) to 1 (as in the texts it was learnt
    from) and a little above.  The posterior compares the learnt languages
    only and is near 1 for any longer text; the fit doesn't depend on the
    length and is low for a text in none of them.

    ``und`` with score 0 for a null text, a text without letters, or when
    no language was learnt.  A tie goes to the language first in order.
    Other columns, also ones that are called like working columns, stay as
    they are; only the text column goes to Python.
    """
    langs, matrix = model
    usual, unseen = own_range(matrix) if langs else (np.zeros(0), np.zeros(0))
    shared = docs.sparkSession.sparkContext.broadcast((langs, np.ascontiguousarray(matrix.T)))

    @F.pandas_udf("lang_pred string, score double, fit double")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, table = shared.value
        for batch in batches:
            out = []
            for value in batch:
                if not names or not has_letter(value):
                    out.append((UNKNOWN, 0.0, 0.0))
                    continue
                logs, n = score_text(value, table)
                best = int(np.argmax(logs))
                fit = (logs[best] / n - unseen[best]) / max(usual[best] - unseen[best], 1e-9)
                out.append((names[best], round(float(1 / np.exp(logs - logs[best]).sum()), 6), round(float(fit), 6)))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "fit"])

    found = ["lang_pred", "score", *["fit"] * with_fit]
    keep = [c for c in docs.columns if c not in found]
    guess = "__guess__"
    return (docs.withColumn(guess, classify(F.col(f"`{text}`")))
            .select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"{guess}.{c}") for c in found]))


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of the documents that never teach (null id: taught from)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
