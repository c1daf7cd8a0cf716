"""E1 as a run on stored tables: read the newest version, ingest, and commit
all tables and the advanced state together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import state as st
from ..schemas import TABLES
from ..sinks import commits, tables
from .ingest import ingest

RUN_STATS = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("mode", T.StringType()),
                          T.StructField("window_start", T.DateType()), T.StructField("window_end", T.DateType())]
                         + [T.StructField(n, T.LongType()) for n in
                            ("processed", "inserted", "updated", "people_added", "companies_added", "skipped",
                             "dropped")])
RUN_EVENTS = T.StructType([T.StructField("event_json", T.StringType())])
STORED = {**TABLES, "run_stats": RUN_STATS, "run_events": RUN_EVENTS}


def advance(state: DataFrame, plans: DataFrame, now: Column) -> DataFrame:
    """The state after the planned windows have been ingested."""
    patch = st.backfill_advance(plans).join(st.daily_advance(plans, now), "state_id", "full")
    return tables.patch(state, patch, "state_id", now)


def read(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    return commits.read(spark, root, table, STORED[table], version)


def run_ingest(spark: SparkSession, root: str, entries: DataFrame, pages: DataFrame, run_id: str, now: Column,
               plans: DataFrame | None = None, **options) -> int:
    """One run as one commit; returns its version.

    What is known is what the newest version holds.  ``plans`` are the state
    rows with their planned windows (``state.plan_runs``); their advance is
    part of the commit, so the cutoff moves if and only if the rows are there.
    A run that dies anywhere leaves the tables and the state as they were; the
    same run id can then run again, and one that has committed is not run
    again.  ``options`` are those of ``ingest``.
    """
    past = commits.history(spark, root)
    for m in past:
        if m["run_id"] == run_id:
            return m["version"]
    base = past[-1]["version"] if past else -1
    stored = {name: read(spark, root, name, base) for name in
              ("articles", "companies", "people", "article_people", "ingestion_state")}
    out = ingest(entries, pages, stored["articles"].select("url"), stored["companies"], stored["people"],
                 stored["article_people"], run_id, now, **options)
    appends = {"articles": out.articles, "companies": out.companies, "people": out.people,
               "article_people": out.article_people, "extraction_failures": out.failures,
               "run_stats": out.stats.withColumn("run_id", F.lit(run_id)), "run_events": out.events}
    replaces = {} if plans is None else {"ingestion_state": advance(stored["ingestion_state"], plans, now)}
    return commits.commit(spark, root, run_id, appends, replaces, STORED, base)
