"""The six stored tables as StructTypes (nullable=False marks REQUIRED)."""

from __future__ import annotations

from pyspark.sql import types as T


def _f(name: str, typ, required: bool = False) -> T.StructField:
    return T.StructField(name, typ, nullable=not required)


S, L, TS, D, B = T.StringType(), T.LongType(), T.TimestampType(), T.DateType(), T.BooleanType()

ARTICLES = T.StructType([
    _f("article_id", L, True), _f("title", S, True), _f("author", S), _f("summary", S, True),
    _f("url", S, True), _f("source_name", S, True), _f("publish_datetime", TS), _f("language", S, True),
    _f("country", S), _f("full_text", S), _f("mentions_cooling_or_water", B, True),
    _f("cooling_water_summary", S), _f("created_at", TS, True), _f("updated_at", TS, True)])

PEOPLE = T.StructType([
    _f("person_id", L, True), _f("full_name", S, True), _f("primary_title", S), _f("primary_company", S),
    _f("email_if_public", S), _f("linkedin_if_public", S), _f("lead_relevance", S, True), _f("notes", S),
    _f("created_at", TS, True), _f("updated_at", TS, True)])

COMPANIES = T.StructType([
    _f("company_id", L, True), _f("name", S, True), _f("sector", S), _f("country", S), _f("notes", S),
    _f("created_at", TS, True), _f("updated_at", TS, True)])

ARTICLE_PEOPLE = T.StructType([
    _f("article_id", L, True), _f("person_id", L, True), _f("role_in_article", S),
    _f("relation_description", S), _f("created_at", TS, True)])

INGESTION_STATE = T.StructType([
    _f("state_id", L, True), _f("backfill_start_date", D, True), _f("backfill_end_date", D, True),
    _f("backfill_progress_cutoff", D), _f("backfill_complete", B, True), _f("last_daily_run_start", TS),
    _f("last_daily_run_end", TS), _f("lock_owner", S), _f("lock_expires_at", TS), _f("updated_at", TS, True)])

EXTRACTION_FAILURES = T.StructType([
    _f("failure_id", L, True), _f("article_url", S), _f("article_title", S), _f("stage", S, True),
    _f("error_type", S), _f("error_kind", S), _f("error_message", S), _f("run_id", S),
    _f("window_start", D), _f("window_end", D), _f("created_at", TS, True)])

TABLES = {
    "articles": ARTICLES, "people": PEOPLE, "companies": COMPANIES, "article_people": ARTICLE_PEOPLE,
    "ingestion_state": INGESTION_STATE, "extraction_failures": EXTRACTION_FAILURES,
}
