"""Small documents with the awkward cases, and plain brute-force versions."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward():
    """Null ids, texts, languages and sources, blank and short texts, repeated rows."""
    return [(None, "some text without an id that is long enough to have shingles", "en", "a", 1),
            (901, None, None, None, None), (902, "", "en", "a", 0), (903, " \n\t ", None, "b", 4),
            (904, "short", "en", None, 5), (905, "same row twice over and over again", "en", "a", 34),
            (905, "same row twice over and over again", "en", "a", 34), (906, "1234 5678 !!", "en", "b", 12)]


def frame(spark, rows, clash=True):
    """A documents table; with ``clash`` it has columns that are called like
    the operators' working columns."""
    df = spark.createDataFrame(rows, DOCS)
    if clash:
        df = df.selectExpr("*", "1 AS size", "'x' AS `group`", "2 AS class", "3 AS score", "4 AS leaks", "5 AS task",
                           "6 AS `text_hash`", "7 AS label", "8 AS host", "9 AS words", "10 AS p", "11 AS block")
    return df


def rng(seed=3):
    return random.Random(seed)
