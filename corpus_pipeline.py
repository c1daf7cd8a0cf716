"""From raw documents to a training mix: the stages in order, each a function
(spark, docs, sf_dir) -> DataFrame whose result is written as Parquet and read
again as the next stage's documents.

Each stage takes any further columns along and holds for an empty table.  Nulls,
blank texts and repeated rows: see the stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, jaccard, langid, mixing, secrets
from tidewater.llm.storage import drop_table, read, write_table

#: Least fit (langid.predict) that a document keeps: 1 is as the texts its language was learnt from, 0 nothing known.
MIN_FIT = 0.65


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in one of the learnt languages; null texts, texts without
    a letter and texts whose letter sequences are mostly unseen in the language
    that they are nearest to go.  The stated languages are learned from, never
    trusted for a document of its own.  Without a language to learn all go."""
    model = langid.fit(docs.where(~langid.held_out()))
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))
    guess = langid.predict(plain, model, with_fit=True)
    return guess.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("fit") >= MIN_FIT)).select("row.*")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays
    (null ids last, ties by a hash of the text).  Documents without words are
    linked with nothing and stay; of rows with equal id and text the first by
    its other columns, in their order, stays (columns of maps aside)."""
    found = jaccard.jaccard_groups(docs)
    no_id, own_id = F.col("doc_id").isNull().alias("__no_id__"), F.coalesce("doc_id", F.lit(0)).alias("__id__")
    first = F.min(F.struct(no_id, own_id, F.col("text_hash").alias("__hash__")))
    alone = found.where("`group` is null").select(no_id, own_id, F.col("text_hash").alias("__hash__"))
    kept = found.where("`group` is not null").groupBy("group").agg(first.alias("rep")).select("rep.*")
    key = ["__no_id__", "__id__", "__hash__"]
    keyed = docs.select(*docs.columns, no_id, own_id, F.xxhash64("text").alias("__hash__"))
    order = [c for c, kind in docs.dtypes if c != "text" and "map<" not in kind and "variant" not in kind]
    first_row = F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.struct(*[F.col(f"`{c}`") for c in order]))
    return (keyed.join(kept.unionByName(alone), key, "left_semi").groupBy(*key).agg(first_row.alias("row"))
            .select("row.*"))


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or an edited copy of one, go."""
    found = decontaminate.find_leaks(docs, read(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks") == 0).select(docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Confirmed secrets are replaced by a mark, and n_chars follows the text;
    every document stays."""
    clean = secrets.redact(docs, secrets.scan(docs))
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars"))).select(docs.columns)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: one row per document it takes, with ``copies`` (how often) and
    ``taken`` (words in all); documents it doesn't take go."""
    return mixing.mix_sources(docs).where("copies > 0").select(
        "doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("language", identify_language),
    ("jaccard", keep_one_of_each_group),
    ("decontamination", remove_benchmark_leaks),
    ("secrets", redact_secrets),
    ("mix", mix_to_targets),
]

#: Naive Bayes, alignment and random forest have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one's table is dropped once the next
    one's is written."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_table(before)
    return docs
