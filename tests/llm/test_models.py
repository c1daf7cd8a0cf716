"""Language ID and the two ordinal classifiers: held-out accuracy and edge cases."""

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import langid, quality, queries, toxicity

from .helpers import awkward, frame, prose, rng

SF, LARGE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
has_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@has_tables
def test_languages_of_held_out_documents(spark):
    got = queries.QUERIES["op5_language_id"](spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = truth.join(got, "doc_id").collect()
    assert len(rows) == truth.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    judged = [r for r in rows if r.held_out and r.lang and r.lang_pred != langid.UNKNOWN]
    assert sum(r.lang == r.lang_pred for r in judged) >= 0.95 * len(judged)


def test_language_of_awkward_documents(spark):
    docs = frame(spark, [*awkward(), (1, "der die das und nicht ein", "de", "a", 1), (2, "the and not a of", "en", "a", 1)])
    got = langid.predict(docs, langid.fit(docs))
    assert got.columns == [c for c in docs.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score"]
    for r in got.collect():
        known = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not known)
    assert langid.predict(docs, langid.fit(docs.limit(0))).where("lang_pred != 'und'").isEmpty()
    assert langid.predict(docs.limit(0), langid.fit(docs)).collect() == []


@pytest.mark.skipif(not os.path.isdir(LARGE), reason="driver tables not present")
@pytest.mark.parametrize("label, rate, flag, least, found", [
    ("toxic", toxicity.rate_severity, "toxic", 0.95, 0.75), ("quality", quality.grade_quality, "selected", 0.85, 0.85)])
def test_grades_of_held_out_documents(spark, label, rate, flag, least, found):
    """Learned from three quarters of some 4,000 labels; a few hundred teach the toxic words only in part."""
    labels = (spark.read.parquet(f"{LARGE}/labels.parquet").select("doc_id", F.col(label).alias("grade"))
              .groupBy("doc_id").agg(F.max("grade").alias("grade")))
    docs = spark.read.parquet(f"{LARGE}/documents.parquet").select("doc_id", "text")
    out = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    got = rate(docs, labels.where(~out)).join(labels.where(out), "doc_id").select(flag, "grade").collect()
    assert sum(bool(r[flag]) == (r.grade >= 1) for r in got) >= least * len(got)
    positive = [r for r in got if r.grade >= 1]
    assert sum(bool(r[flag]) for r in positive) >= found * len(positive)


def test_ratings_of_awkward_documents(spark):
    docs = frame(spark, awkward())
    ratings = spark.createDataFrame([(902, 0), (904, 1), (905, 0), (None, 1), (906, None), (7777, 1)],
                                    "doc_id long, grade int")
    for rate, flag in ((toxicity.rate_severity, "toxic"), (quality.grade_quality, "selected")):
        for given in (ratings, ratings.limit(0), ratings.where("doc_id = 904")):
            got = rate(docs, given)
            assert got.count() == docs.count()
            assert got.where(f"(text is null or trim(text) = '') and {flag} and doc_id != 903").isEmpty()
        assert rate(docs.limit(0), ratings).collect() == []


def test_copies_of_a_text_teach_once_and_no_language_is_dropped(spark, monkeypatch):
    one = [(f"der hund {k} und die katze {chr(97 + k)}", "de") for k in range(10)]
    two = [(f"the dog {k} and the cat {chr(97 + k)}", "en") for k in range(10)]
    table = lambda rows: spark.createDataFrame(rows, "text string, lang string")
    plain, copied = (langid.fit(table(rows), max_train_docs=10) for rows in (one + two, one * 3 + two + two[:1] * 500))
    assert plain[0] == copied[0] == ["de", "en"] and (plain[1] == copied[1]).all()
    monkeypatch.setattr(langid, "MAX_LANGS", 1)
    with pytest.raises(ValueError):
        langid.fit(table(one + two))


def test_language_scores_equal_a_dictionary_naive_bayes(spark):
    """Counts in dictionaries, n-grams cut by hand, exact logarithms."""
    import math
    from collections import Counter

    from tidewater.llm.ngrams import gram_buckets, letter_codes
    r = rng(21)
    texts = {"xx": "ka to mi su re la", "yy": "der und das ein ich", "zz": "los que una con por"}
    rows = [(i, " ".join(r.choice(v.split()) for _ in range(r.randrange(1, 30))) + r.choice(["", "!", " 12 Ä"]), g)
            for i in range(60) for g, v in texts.items()]
    docs = spark.createDataFrame([(i * 3 + k, t, g) for k, (i, t, g) in enumerate(rows)], "doc_id long, text string, lang string")

    def grams(text):
        letters = "".join(c if c.isalpha() else " " for c in text.lower())
        line = " " + " ".join(letters.split()) + " "
        return [line[i: i + n] for n in langid.ORDERS for i in range(len(line) - n + 1)]

    def bucket(g):
        codes = np.array([ord(c) for c in g], np.uint32)
        return int(gram_buckets(codes, len(g), langid.BITS)[0])
    assert letter_codes("Ab, c1d").tobytes() == np.array([ord(c) for c in " ab c d "], np.uint32).tobytes()
    counts = {g: Counter() for g in texts}
    for t, g in {(t, g) for _, t, g in rows}:
        counts[g].update(map(bucket, grams(t)))
    size = 1 << langid.BITS

    def logs(text, g):
        total = sum(counts[g].values()) + langid.SMOOTHING * size
        return sum(math.log((counts[g][bucket(x)] + langid.SMOOTHING) / total) for x in grams(text))
    asked = ["ka der", "los", "to mi das ein", "su", "q", "una mi"]
    got = langid.predict(spark.createDataFrame(list(enumerate(asked)), "i int, text string"), langid.fit(docs)).collect()
    for row in got:
        found = {g: logs(asked[row.i], g) for g in texts}
        best = max(sorted(found), key=found.get)
        posterior = 1 / sum(math.exp(v - found[best]) for v in found.values())
        assert row.lang_pred == best and row.score == pytest.approx(posterior, abs=2e-3)


@pytest.mark.parametrize("grades", [[0, 1, 2], [-1, 3, 4, 9, 20]])
def test_grades_above_two_are_learned_in_order(spark, grades):
    """Graded by how many marker words a text holds; thresholds rise, tails fall."""
    from tidewater.llm import ordinal
    r = rng(31)
    docs, ratings = [], []
    for i in range(150 * len(grades)):
        k = i % len(grades)
        body = prose(r, 40, 60).split()
        for m in range(k):
            body.insert(r.randrange(len(body)), f"marker{'abcd'[m]}")
        docs.append((i, " ".join(body)))
        ratings.append((i, grades[k]))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    held_out = lambda i: i // len(grades) % 5 == 0
    taught = spark.createDataFrame([x for x in ratings if not held_out(x[0])], "doc_id long, grade int")
    model = ordinal.fit(table, taught, "words", epochs=20)
    assert len(model.thresholds) == len(grades) - 1 and (np.diff(model.thresholds) > 0).all()
    got = {x.doc_id: x for x in ordinal.predict(table, model).collect()}
    held = [(got[i], g) for i, g in ratings if held_out(i)]
    assert sum(x.grade_pred == g for x, g in held) >= 0.9 * len(held)
    for x, _ in held:
        assert len(x.tail_probabilities) == len(grades) - 1
        assert all(a >= b for a, b in zip(x.tail_probabilities, x.tail_probabilities[1:]))
        p = -np.diff([1.0, *x.tail_probabilities, 0.0])
        assert x.expected_grade == pytest.approx(float(np.dot(p, grades)), abs=1e-3)


def test_result_columns_replace_input_columns_of_their_names(spark):
    docs = spark.createDataFrame([(1, "a b c", 7.0, "x"), (2, "d e", 8.0, "y")],
                                 "doc_id long, text string, expected_grade double, toxic string")
    ratings = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, grade int")
    got = toxicity.rate_severity(docs, ratings)
    assert len(set(got.columns)) == len(got.columns) and "expected_grade" not in got.columns
    assert dict(got.dtypes)["toxic"] == "boolean"
