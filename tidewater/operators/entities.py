"""Entity explode and link building.

Each article carries arrays of companies and people; ``posexplode`` turns
them into rows with their article provenance and element position, which
is what makes "first wins" deterministic downstream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.llm_json import DEFAULT_ROLE
from .dedupe import person_key

PROVENANCE = ["article_id", "article_pos", "article_url", "article_title"]


def explode_companies(articles: DataFrame, col: str = "companies", keep=()) -> DataFrame:
    """D14 (companies): one row per company element, with provenance."""
    e = articles.select(*PROVENANCE, *keep, F.posexplode(col).alias("elem_pos", "_c"))
    return e.select(*PROVENANCE, *keep, "elem_pos", *[F.col(f"_c.{f}").alias(f) for f in
                                                      ("name", "sector", "country", "notes")])


def explode_people(articles: DataFrame, col: str = "people", keep=()) -> DataFrame:
    """D14 (people): one row per person element; a role that the element
    carries is kept, else it is 'Mentioned'; ``person_key`` is NULL for a
    blank name."""
    e = articles.select(*PROVENANCE, *keep, F.posexplode(col).alias("elem_pos", "_p"))
    fields = ("full_name", "primary_title", "primary_company", "lead_relevance", "notes")
    role = F.lit(DEFAULT_ROLE)
    if "role_in_article" in e.schema["_p"].dataType.names:
        role = F.coalesce("_p.role_in_article", role)
    out = e.select(*PROVENANCE, *keep, "elem_pos", *[F.col(f"_p.{f}").alias(f) for f in fields],
                   role.alias("role_in_article"))
    return out.withColumn("person_key", person_key("full_name", "primary_company"))


def links_from_people(people_rows: DataFrame, keep=()) -> DataFrame:
    """Article-person link candidates (rows whose person has a key)."""
    return people_rows.filter(F.col("person_key").isNotNull()).select(
        *PROVENANCE, *keep, "elem_pos", "person_key", "role_in_article",
        F.col("notes").alias("relation_description"))


def ids_after_insert(resolved: DataFrame, insert_ok) -> DataFrame:
    """person_key -> person_id for existing people and new people whose
    insert succeeded (failed inserts lose their id, as in the reference)."""
    return resolved.filter(~F.col("is_new") | insert_ok).select("person_key", "person_id")
