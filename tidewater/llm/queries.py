"""Registered queries of the training-data operators (digest columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (code_compression, decontaminate, hard_negatives, jaccard, langid, mixing, quality, quality_rules, secrets,
               simhash, sql, suffix_dedup, toxicity, url_filter)
from .storage import read

QUERIES: dict = {}
ORACLE: dict[str, str] = {"op12_hard_negatives": sql.HARD_NEGATIVES, "op13_vector_codes": sql.vector_codes()}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", langid.held_out())
    model = langid.fit(docs.where("not held_out"))
    return langid.predict(docs.select("doc_id", "text", "held_out"), model).select(
        "doc_id", "held_out", "lang_pred", "score")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity grades are the labels' toxic column."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    severities = read(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("grade"))
    return toxicity.rate_severity(docs, severities).select("doc_id", "toxic", "severity", "severity_pred", "p_toxic")


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings are the labels' quality column; selected from grade 1."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    ratings = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("grade"))
    return quality.grade_quality(docs, ratings).select("doc_id", "selected", "quality", "grade_pred", "p_good")


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.jaccard_groups(docs).select("doc_id", "n_shingles", "component_id")


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item it contains."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate and its verdict; values are shown by their first four characters only."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    masked = F.concat(F.left("value", F.lit(4)), F.lit("..."))
    return secrets.scan(docs).select("doc_id", "word_no", masked.alias("masked"), F.length("value").alias("n_chars"),
                                     "assigned", "probability", "is_secret")


@query
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "p_good")


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.simhash_groups(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose vec_id is divisible by 100; labels of rows whose vec_id is divisible by 7 are moved
    to the next one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = code_compression.compress(read(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error",
                        F.lit(code_compression.digest(codebooks)).alias("codebooks_sha256"))
