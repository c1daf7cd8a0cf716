"""Dead-letter rows (K4): every stage's failures in one common schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.errors import classify_error

# ---- fixed values (must equal the reference's behaviour) -------------------
STAGES = ["extract", "article_insert", "company_insert", "person_insert", "relation_link"]
INSERT_ERROR, PERMANENT_WRITE = "InsertError", "permanent_write"
MISSING_PERSON_ID, DEPENDENT_WRITE = "MissingPersonId", "dependent_write"
INSERT_MESSAGES = {
    "article_insert": "Failed to insert article row into BigQuery.",
    "company_insert": "Failed to insert company row into BigQuery.",
    "person_insert": "Failed to insert person row into BigQuery.",
}
MISSING_PERSON_MESSAGE = "Skipped article-person relation because person ID was unavailable."
# -----------------------------------------------------------------------------

COLUMNS = ["failure_id", "article_url", "article_title", "stage", "error_type", "error_kind", "error_message",
           "run_id", "window_start", "window_end", "created_at"]


def failure_rows(df: DataFrame, stage: str, id_parts: list, error_type: Column, error_kind: Column,
                 error_message: Column, run_id: Column, window_start: Column, window_end: Column,
                 created_at: Column, url: str = "article_url", title: str = "article_title") -> DataFrame:
    """Project one stage's failing rows onto the dead-letter schema; the id
    is the stable hash of ('failure', run_id, *id_parts, stage)."""
    return df.select(
        ids.stable_id(ids.FAILURE, run_id, *id_parts, F.lit(stage)).alias("failure_id"),
        F.col(url).alias("article_url"), F.col(title).alias("article_title"), F.lit(stage).alias("stage"),
        error_type.alias("error_type"), error_kind.alias("error_kind"), error_message.alias("error_message"),
        run_id.alias("run_id"), window_start.cast("date").alias("window_start"),
        window_end.cast("date").alias("window_end"), created_at.alias("created_at"))


def extract_failures(df: DataFrame, run_id, ws, we, now) -> DataFrame:
    """Stage 'extract': kind classified from (error_type, error_message)."""
    return failure_rows(df, "extract", [F.col("article_url")], F.col("error_type"),
                        classify_error("error_type", "error_message"),
                        F.coalesce(F.col("error_message"), F.lit("unknown")), run_id, ws, we, now)


def insert_failures(df: DataFrame, stage: str, id_col: str, run_id, ws, we, now) -> DataFrame:
    """Stages article_insert / company_insert / person_insert."""
    return failure_rows(df, stage, [F.col(id_col)], F.lit(INSERT_ERROR), F.lit(PERMANENT_WRITE),
                        F.lit(INSERT_MESSAGES[stage]), run_id, ws, we, now)


def link_failures(df: DataFrame, run_id, ws, we, now) -> DataFrame:
    """Stage relation_link: a link whose person has no id."""
    return failure_rows(df, "relation_link", [F.col("article_url"), F.col("person_key")],
                        F.lit(MISSING_PERSON_ID), F.lit(DEPENDENT_WRITE), F.lit(MISSING_PERSON_MESSAGE),
                        run_id, ws, we, now)


def union_failures(parts: list[DataFrame]) -> DataFrame:
    """All branches in one frame (by name)."""
    out = parts[0].select(*COLUMNS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*COLUMNS))
    return out
