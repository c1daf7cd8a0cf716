"""Joins against stored tables.

The reference issues one lookup query per article / entity / link; here
each is one join.  Lookup sides are pre-aggregated to one row per join key
before the join, so an existing table with duplicate names cannot multiply
rows, and the join never needs a driver-side id list.  Physical strategy is
left to Catalyst/AQE (broadcast when the statistics say small, otherwise
sort-merge with skew splitting).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids


def new_vs_known(entries: DataFrame, known_urls: DataFrame, url_col: str = "url",
                 known_col: str = "url") -> tuple[DataFrame, DataFrame]:
    """Split entries into (new, known) by exact URL match.

    Both outputs are lazy; ``known`` is what the reference counts as
    'updated' without modifying anything.
    """
    k = known_urls.select(F.col(known_col).alias("_known_url")).filter(F.col("_known_url").isNotNull())
    cond = F.col(url_col) == F.col("_known_url")
    new = entries.join(k, cond, "left_anti")
    known = entries.join(k, cond, "left_semi")
    return new, known


def subtract_known(entries: DataFrame, known_urls: DataFrame, url_col: str = "url",
                   known_col: str = "url") -> DataFrame:
    """Drop entries whose raw URL is known; duplicates inside the
    batch are kept (anti join, not EXCEPT)."""
    entries = entries.filter(F.coalesce(F.col(url_col), F.lit("")) != "")
    return new_vs_known(entries, known_urls, url_col, known_col)[0]


def resolve_companies(companies: DataFrame, existing: DataFrame, name_col: str = "name") -> DataFrame:
    """Existing company_id by lower(name), else a new stable id.

    Adds ``company_id`` and ``is_new``.  The lookup uses the untrimmed name
    (as the reference does); existing duplicates resolve to the smallest id.
    """
    ex = (existing.filter(F.col("name").isNotNull())
          .groupBy(F.lower("name").alias("_lname"))
          .agg(F.min("company_id").alias("_existing_id")))
    j = companies.join(ex, F.lower(F.col(name_col)) == F.col("_lname"), "left")
    return (j.withColumn("is_new", F.col("_existing_id").isNull())
             .withColumn("company_id", F.coalesce("_existing_id", ids.stable_id(ids.COMPANY, F.col(name_col))))
             .drop("_lname", "_existing_id"))


def resolve_people(people: DataFrame, existing: DataFrame, name_col: str = "full_name",
                   company_col: str = "primary_company") -> DataFrame:
    """Match lower(full_name) and null-safe lower(primary_company)."""
    ex = (existing.filter(F.col("full_name").isNotNull())
          .groupBy(F.lower("full_name").alias("_lname"), F.lower("primary_company").alias("_lcomp"))
          .agg(F.min("person_id").alias("_existing_id")))
    cond = (F.lower(F.col(name_col)) == F.col("_lname")) & \
        F.lower(F.col(company_col)).eqNullSafe(F.col("_lcomp"))
    j = people.join(ex, cond, "left")
    return (j.withColumn("is_new", F.col("_existing_id").isNull())
             .withColumn("person_id", F.coalesce("_existing_id",
                                                 ids.stable_id(ids.PERSON, F.col(name_col), F.col(company_col))))
             .drop("_lname", "_lcomp", "_existing_id"))


def relation_exists(links: DataFrame, existing: DataFrame) -> DataFrame:
    """Links already present in article_people (semi join on both ids)."""
    return links.join(existing.select("article_id", "person_id"), ["article_id", "person_id"], "left_semi")


LINKED, MISSING = "linked", "missing"


def with_person_ids(links: DataFrame, person_ids: DataFrame) -> DataFrame:
    """``person_id`` by person_key and its ``outcome`` (linked, missing):
    one join, both outcomes are filters of it."""
    # one id per key (the smallest, should a key ever carry two): deterministic
    pid = person_ids.groupBy("person_key").agg(F.min("person_id").alias("person_id"))
    return links.join(pid, "person_key", "left").withColumn(
        "outcome", F.when(F.col("person_id").isNull(), MISSING).otherwise(LINKED))


def link_person_ids(links: DataFrame, person_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """J6 as two frames: (linked, missing)."""
    j = with_person_ids(links, person_ids)
    return tuple(j.filter(F.col("outcome") == o).drop("outcome") for o in (LINKED, MISSING))


def case_insensitive_equal(a, b):
    """P12"""
    return F.lower(a) == F.lower(b)


def null_safe_company_match(a, b):
    """LOWER(a) = LOWER(b) OR both NULL."""
    return F.lower(a).eqNullSafe(F.lower(b))


def first_link_per_pair(links: DataFrame, order=("article_pos", "elem_pos")) -> DataFrame:
    """Links of one run that resolve to the same (article_id, person_id):
    the first in list order wins, as it would for one MERGE per link."""
    from .dedupe import first_per_pair
    return first_per_pair(links, ["article_id", "person_id"], list(order))
