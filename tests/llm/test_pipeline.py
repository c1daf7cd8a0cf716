"""The pipeline's stages on awkward documents, and its first tables whole."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

from .helpers import awkward, frame, prose, rng, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    r = rng(12)
    items = [(k, prose(r, 25, 3000)) for k in range(3)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    rows = [(i, prose(r, 40, 3000), "en", r.choice("ab"), 1) for i in range(30)]
    rows += [(50, rows[3][1], "en", "a", 1), (51, rows[3][1] + " more", "en", "b", 1),
             (60, "intro " + items[1][1], "en", "a", 1)] + awkward()
    frame(spark, rows, clash=False).write.parquet(f"{d}/documents.parquet")
    return d


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_keep_the_columns_and_stand_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("*", "1 AS `group`", "2 AS leaks", "3 AS score")
    for name, f in corpus_pipeline.STAGES:
        none = f(spark, docs.limit(0), sf_dir)
        assert none.collect() == []
        if name != "mix":
            assert none.columns == docs.columns
            assert f(spark, docs, sf_dir).columns == docs.columns


def test_one_of_each_group_stays(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = [r.doc_id for r in stage("jaccard")(spark, docs, sf_dir).collect()]
    assert sorted(got, key=str) == sorted([*range(30), 60, 901, 902, 903, 904, 905, 906, None], key=str)


def test_the_row_that_stays_does_not_depend_on_the_input_order(spark, sf_dir):
    text = prose(rng(3), 40)
    rows = [(7, text, "en", s, 1) for s in "cab"] + [(8, text, "de", "z", 2), (7, text, None, "a", 1)]
    for k in range(3):
        docs = frame(spark, rows[k:] + rows[:k], clash=False).repartition(3)
        got = stage("jaccard")(spark, docs, sf_dir).collect()
        assert [tuple(r) for r in got] == [(7, text, None, "a", 1)]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_texts_in_no_learnt_language_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    r = rng(9)
    cyrillic = "съешь же ещё этих мягких французских булок да выпей чаю в лесу родилась ёлочка в лесу она росла "
    planted = [(9001, cyrillic * 5, None, "p", 1), (9002, cyrillic, None, "p", 1), (9003, None, None, "p", 1),
               (9004, "το γρήγορο καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί " * 4, None, "p", 1),
               (9005, "1234 !!", None, "p", 1),
               (9006, " ".join("".join(r.choice("bcdfghjklmnpqrstvwxz") for _ in range(9)) for _ in range(80)), None, "p", 1)]
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        spark.createDataFrame(planted, "doc_id long, text string, lang string, source string, n_chars long")
        .withColumn("n_chars", F.col("n_chars").cast(docs.schema["n_chars"].dataType)))
    kept = {x.doc_id for x in stage("language")(spark, rows, SF).select("doc_id").collect()}
    assert not kept & {9001, 9002, 9003, 9004, 9005, 9006}
    words_of = {x.doc_id: len(words(x.text)) for x in docs.where("lang is not null").collect()}
    clean = {i for i, n in words_of.items() if n >= 5}
    assert len(kept & clean) >= 0.995 * len(clean)


def test_planted_secrets_are_marked_and_all_documents_stay(spark, sf_dir):
    r = rng(4)
    rows = [(i, prose(r, 30) + (f' token = "AKIA{i:02d}FODNN7EXAMPLE" ' if i % 2 else " 4785380592391139 ") + prose(r, 5),
             "en", "a", 1) for i in range(20)] + awkward()
    docs = frame(spark, rows, clash=False)
    got = stage("secrets")(spark, docs, sf_dir).collect()
    assert len(got) == len(rows)
    marked = {x.doc_id: x for x in got if x.text and "[SECRET]" in x.text}
    assert set(marked) == set(range(1, 20, 2))
    assert all(x.n_chars == len(x.text) and "AKIA" not in x.text for x in marked.values())


def test_the_mix_takes_words_near_the_targets(spark, sf_dir):
    r = rng(5)
    rows = [(i, prose(r, r.randrange(5, 60)), "en", r.choice("abc"), 1) for i in range(600)]
    got = stage("mix")(spark, frame(spark, rows, clash=False), sf_dir).collect()
    target = {x.source: x.target for x in got}
    for s, aim in target.items():
        assert abs(sum(x.taken for x in got if x.source == s) - aim) <= max(80, 0.03 * aim)
    assert all(1 <= x.copies <= 3 and x.taken == x.copies * x.size for x in got)


def test_leaks_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = stage("decontamination")(spark, docs, sf_dir)
    assert got.count() == docs.count() - 1 and got.where("doc_id = 60").isEmpty()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_run_mixes_documents_of_the_corpus(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows)
    for r in rows:
        assert r.source == docs[r.doc_id].source and r.taken == r.size * r.copies
    plain = [r for r in rows if "=" not in docs[r.doc_id].text]
    assert all(r.size == len(words(docs[r.doc_id].text)) for r in plain)
