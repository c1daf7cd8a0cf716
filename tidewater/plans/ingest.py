"""One ingestion run over landed feed entries, as a single Spark plan.

entries -> first-wins URL dedupe (-> first N per window) -> canonical URL ->
one status per entry (skipped, updated, new) -> page text + heuristics (+
landed model answers) -> article rows -> entities (exploded, deduped,
resolved) -> links (deduped, id-joined, insert-only merge) -> dead-letter
rows, run stats and event rows.

Every step is a DataFrame transform on all windows at once (``window_start``
/``window_end`` columns); the reference's one-query-per-row lookups are
joins.  The cheap dedupe and the join to known URLs run before any text work.

Each stage tags its rows with an ``outcome`` and is written once: tables,
dead-letter rows and counters are filters and counts of these few tables, so
no branch is computed twice, and none that isn't asked for.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, text, urls
from ..functions.dates import iso_utc
from ..functions.strings import let
from ..functions import llm_json as lj
from ..operators import dedupe, entities, resolve
from ..schemas import ARTICLES, COMPANIES, PEOPLE
from ..session import materialize
from ..sinks import failures as fl
from ..sinks import tables

# ---- fixed values (must equal the reference's behaviour) -------------------
DEFAULT_TITLE, DEFAULT_SOURCE, LANGUAGE = "Untitled", "Unknown", "en"
INSERTED_EVENT, INSERTED_PREFIX = "pipeline_inserted_article", "Inserted Article: "
# -----------------------------------------------------------------------------


def heuristic_payload(title="title", summary="summary", full_text="full_text", source="source_name",
                      keywords: list[str] = text.TOPIC_KEYWORDS) -> Column:
    """The extraction payload without a model.

    The inputs are bound once (``let``): the page text is referenced by
    several parts and must not be recomputed per reference.
    """
    def c(x):
        return F.col(x) if isinstance(x, str) else x
    pat = text.keyword_pattern(keywords)
    inputs = F.struct(c(title).alias("t"), c(summary).alias("s"), c(full_text).alias("f"), c(source).alias("src"))

    def body(r):
        t, s, f = r["t"], r["s"], r["f"]
        return let(text.article_text(t, s, f), lambda b: let(F.lower(b).rlike(pat), lambda flag: F.struct(
            text.build_summary(t, s, f).alias("summary"),
            flag.alias("mentions_cooling_or_water"),
            F.when(flag, text.keyword_sentences(b, pat)).alias("cooling_water_summary"),
            F.array().cast(f"array<{lj.PERSON_T}>").alias("people"),
            text.heuristic_companies(r["src"], b).alias("companies"),
            f.alias("full_text"),
            F.lit("US").alias("country"))))
    return let(inputs, body)


def article_rows(df: DataFrame, extracted: str, now: Column, keep=()) -> DataFrame:
    """The stored article row of each extracted entry (``keep`` columns
    are passed through)."""
    x = F.col(extracted)
    title = F.coalesce(F.col("title"), F.lit(DEFAULT_TITLE))
    summary = F.coalesce(F.when(x["summary"] != "", x["summary"]),
                         F.when(F.col("summary") != "", F.col("summary")), title)
    published = F.col("publish_datetime")
    if df.schema["publish_datetime"].dataType.typeName() != "string":  # a text is validated with the row
        published = published.cast("timestamp")
    return df.select(
        ids.stable_id(ids.ARTICLE, F.col("url")).alias("article_id"), title.alias("title"),
        F.lit(None).cast("string").alias("author"), summary.alias("summary"), F.col("url"),
        F.coalesce(F.col("source_name"), F.lit(DEFAULT_SOURCE)).alias("source_name"),
        published.alias("publish_datetime"),
        F.lit(LANGUAGE).alias("language"), x["country"].alias("country"), x["full_text"].alias("full_text"),
        F.coalesce(x["mentions_cooling_or_water"], F.lit(False)).alias("mentions_cooling_or_water"),
        x["cooling_water_summary"].alias("cooling_water_summary"),
        now.alias("created_at"), now.alias("updated_at"), *keep)


def inserted_events(articles: DataFrame, run_id: Column, now: Column) -> DataFrame:
    """One JSON event row per inserted article."""
    return articles.select(F.to_json(F.struct(
        iso_utc(now).alias("ts"), F.lit("INFO").alias("level"),
        F.lit(INSERTED_EVENT).alias("event"), run_id.alias("run_id"),
        F.concat(F.lit(INSERTED_PREFIX), F.col("title")).alias("detail"))).alias("event_json"))


def run_stats(entries: DataFrame, articles: DataFrame, companies: DataFrame, people: DataFrame,
              dropped: DataFrame | None, mode: str | None) -> DataFrame:
    """A3: counters per window, each stage's rows counted by outcome first, so
    that only a few rows per window meet.  ``dropped`` are the entries beyond
    the run's limit; the reference forgets them."""
    win = ["window_start", "window_end"]
    o = F.col("outcome")
    counters = ["processed", "inserted", "updated", "people_added", "companies_added", "skipped", "dropped"]

    def counts(df: DataFrame, **c: Column) -> DataFrame:
        d = df.groupBy(*win).agg(*[F.count_if(cond).alias(n) for n, cond in c.items()])
        return d.select(*win, *[F.col(n) if n in c else F.lit(0).cast("long").alias(n) for n in counters])

    parts = [counts(entries, processed=F.lit(True), updated=o == UPDATED, skipped=o == SKIPPED),
             counts(articles, inserted=o == INSERTED, skipped=o != INSERTED),
             counts(companies, companies_added=o == INSERTED), counts(people, people_added=o == INSERTED)]
    if dropped is not None:
        parts.append(counts(dropped, dropped=F.lit(True)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(*win).agg(*[F.sum(n).alias(n) for n in counters]).select(
        F.lit(mode).cast("string").alias("mode"), *win, *counters)


NEW, UPDATED, SKIPPED = "new", "updated", "skipped"
INSERTED, REJECTED, KNOWN, FAILED = "inserted", "rejected", "known", "failed"
WINDOW = ["window_start", "window_end"]


def entry_outcomes(entries: DataFrame, known_urls: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(entries with ``outcome``, entries dropped by the limit).

    Raw URLs are deduped per window, as the fetch does.  Of the rest, entries
    without a URL are skipped; those whose canonical URL is stored already, or
    is that of an earlier entry of the run, are updated; others are new.
    """
    pos = ["window_start", "kw_pos", "entry_pos"]
    e = entries.withColumn("_key", F.when(F.coalesce(F.col("url"), F.lit("")) != "", F.col("url")))
    missing = e.filter(F.col("_key").isNull()).drop("_key")
    first = dedupe.first_wins(e.filter(F.col("_key").isNotNull()), F.struct(*WINDOW, F.col("_key")),
                              ["kw_pos", "entry_pos"], "_dk").drop("_dk", "_key")
    dropped = first.limit(0)
    if limit is not None:
        ranked = first.withColumn("_rank", F.row_number().over(
            Window.partitionBy(*WINDOW).orderBy("kw_pos", "entry_pos")))
        dropped = ranked.filter(F.col("_rank") > limit).drop("_rank")
        first = dedupe.first_n_per_group(first, limit, WINDOW, ["kw_pos", "entry_pos"], "_rank").drop("_rank")
    canon = materialize(urls.with_canonical_url(first.unionByName(missing), "url", "canonical_url"), "ingest_entries")
    ok = F.coalesce(F.col("canonical_url"), F.lit("")) != ""
    firsts = dedupe.first_wins(canon.filter(ok).select("canonical_url", *pos), F.col("canonical_url"), pos, "_ck") \
        .select(F.col("canonical_url").alias("_u"), *[F.col(c).alias(f"_{c}") for c in pos])
    known = known_urls.filter("url is not null").select(F.col("url").alias("_known")).distinct()
    same = [F.col("canonical_url") == F.col("_u"), *[F.col(c).eqNullSafe(F.col(f"_{c}")) for c in pos]]
    tagged = (canon.join(firsts, reduce(and_, same), "left")
              .join(known, F.col("canonical_url") == F.col("_known"), "left"))
    outcome = (F.when(~ok, SKIPPED).when(F.col("_known").isNotNull() | F.col("_u").isNull(), UPDATED).otherwise(NEW))
    return materialize(tagged.withColumn("outcome", outcome).drop("_u", "_known", *[f"_{c}" for c in pos]),
                       "ingest_outcomes"), dropped


@dataclass
class RunOutput:
    """What one run adds to each table, its counters and events.  Entities are
    resolved when a table that needs them is first asked for, once."""
    entry_outcomes: DataFrame
    dropped: DataFrame | None
    article_outcomes: DataFrame
    existing_companies: DataFrame
    existing_people: DataFrame
    existing_links: DataFrame
    run_id: Column
    now: Column
    limits: dict[str, dict[str, int]]
    mode: str | None

    def _inserted(self, df: DataFrame, schema) -> DataFrame:
        return tables.align_to_schema(df.filter(F.col("outcome") == INSERTED), schema)

    def _tagged(self, found: DataFrame, schema, table: str) -> DataFrame:
        stamped = found.withColumns({"created_at": self.now, "updated_at": self.now})
        ok = tables.required_ok(stamped, schema, self.limits.get(table))
        return materialize(stamped.withColumn("outcome", F.when(~F.col("is_new"), KNOWN).when(ok, INSERTED)
                                              .otherwise(REJECTED)), f"ingest_{table}")

    @cached_property
    def _provenance(self) -> DataFrame:
        """Inserted articles with their entities and position."""
        return self.article_outcomes.filter(F.col("outcome") == INSERTED).select(
            "article_id", F.struct("window_start", "kw_pos", "entry_pos").alias("article_pos"),
            F.col("url").alias("article_url"), F.col("title").alias("article_title"), *WINDOW,
            F.col("_x.companies").alias("companies"), F.col("_x.people").alias("people"))

    @cached_property
    def _mentions(self) -> DataFrame:
        return entities.explode_people(self._provenance, keep=WINDOW)

    @cached_property
    def company_outcomes(self) -> DataFrame:
        found = dedupe.dedupe_companies(entities.explode_companies(self._provenance, keep=WINDOW))
        return self._tagged(resolve.resolve_companies(found, self.existing_companies), COMPANIES, "companies")

    @cached_property
    def person_outcomes(self) -> DataFrame:
        found = resolve.resolve_people(dedupe.dedupe_people(self._mentions), self.existing_people)
        none = {c: F.lit(None).cast("string") for c in ("email_if_public", "linkedin_if_public")}
        return self._tagged(found.withColumns(none), PEOPLE, "people")

    @cached_property
    def link_outcomes(self) -> DataFrame:
        ids_of = self.person_outcomes.filter(F.col("outcome") != REJECTED).select("person_key", "person_id")
        return materialize(resolve.with_person_ids(dedupe.dedupe_relations(
            entities.links_from_people(self._mentions, keep=WINDOW)), ids_of), "ingest_links")

    @cached_property
    def articles(self) -> DataFrame:
        return self._inserted(self.article_outcomes, ARTICLES)

    @cached_property
    def companies(self) -> DataFrame:
        return self._inserted(self.company_outcomes, COMPANIES)

    @cached_property
    def people(self) -> DataFrame:
        return self._inserted(self.person_outcomes, PEOPLE)

    @cached_property
    def article_people(self) -> DataFrame:
        linked = resolve.first_link_per_pair(self.link_outcomes.filter(F.col("outcome") == resolve.LINKED))
        rows = linked.select("article_id", "person_id", "role_in_article", "relation_description",
                             self.now.alias("created_at"))
        return tables.merge_insert_only(rows, self.existing_links, ["article_id", "person_id"])

    @cached_property
    def failures(self) -> DataFrame:
        common = self.run_id, F.col("window_start"), F.col("window_end"), self.now
        of_article = self.article_outcomes.withColumn("article_url", F.col("url")).withColumn("article_title", F.col("title"))
        o = F.col("outcome")
        return fl.union_failures([
            fl.extract_failures(of_article.filter(o == FAILED), *common),
            fl.insert_failures(of_article.filter(o == REJECTED), "article_insert", "url", *common),
            fl.insert_failures(self.company_outcomes.filter(o == REJECTED), "company_insert", "name", *common),
            fl.insert_failures(self.person_outcomes.filter(o == REJECTED), "person_insert", "full_name", *common),
            fl.link_failures(self.link_outcomes.filter(o == resolve.MISSING), *common),
        ])

    @cached_property
    def stats(self) -> DataFrame:
        return run_stats(self.entry_outcomes, self.article_outcomes, self.company_outcomes, self.person_outcomes,
                         self.dropped, self.mode)

    @cached_property
    def events(self) -> DataFrame:
        return inserted_events(self.article_outcomes.filter(F.col("outcome") == INSERTED), self.run_id, self.now)


def ingest(entries: DataFrame, pages: DataFrame, known_urls: DataFrame, existing_companies: DataFrame,
           existing_people: DataFrame, existing_links: DataFrame, run_id: str, now: Column,
           answers: DataFrame | None = None, limit: int | None = None,
           keywords: list[str] = text.TOPIC_KEYWORDS, page_order: str | None = None,
           errors: DataFrame | None = None, limits: dict[str, dict[str, int]] | None = None,
           mode: str | None = None, max_paragraphs: int | None = None) -> RunOutput:
    """One run over all windows of ``entries``.

    entries: window_start, window_end, kw_pos, entry_pos, title, url,
    source_name, publish_datetime, summary.  pages: url (canonical), html
    and, when ``page_order`` names it, a fetch position (non-null, unique
    within a URL): several fetches of one URL may have landed and the first
    wins (without it, pages must hold one row per URL).  answers (optional):
    url, answer.  errors (optional): url, error_type, error_message of
    extractions that failed; these entries are skipped (answers and errors
    hold one row per canonical URL).  limit (optional):
    first entries of each window that the run looks at; all by default.
    limits (optional): {table: {column: most characters}} beyond which a row
    is rejected.  max_paragraphs: paragraphs of a page's text; all by default.
    """
    rid, limits = F.lit(run_id), limits or {}
    tagged, dropped = entry_outcomes(entries, known_urls, limit)
    new = tagged.filter(F.col("outcome") == NEW).drop("outcome") \
        .withColumn("url", F.col("canonical_url")).drop("canonical_url")
    if errors is not None:
        new = new.join(errors.select("url", "error_type", "error_message"), "url", "left")
    else:
        new = new.withColumns({c: F.lit(None).cast("string") for c in ("error_type", "error_message")})

    # Fetch only what is new, then extract text for those pages alone.  Of
    # several fetches of a URL the first is found on narrow rows (a hash
    # aggregate with a map-side step), and HTML is joined on the pair, so the
    # refetches of one hot URL never meet in one task.
    keys, by = new.select("url"), ["url"]
    if page_order:
        by = ["url", page_order]
        keys = pages.groupBy("url").agg(F.min(page_order).alias(page_order)).join(keys, "url", "left_semi")
    wanted = pages.select(*by, "html").join(keys, by, "left_semi").select("url", "html")
    fetched = new.join(wanted, "url", "left").withColumn(
        "full_text", text.page_main_text("html", max_paragraphs)).drop("html")
    fetched = fetched.withColumn("_heur", heuristic_payload("title", "summary", "full_text", "source_name",
                                                            keywords))
    if answers is not None:
        fetched = lj.with_extraction_choice(fetched.join(answers.select("url", "answer"), "url", "left"),
                                            "answer", "_heur", "_xc")
        fetched = fetched.withColumn("_x", F.col("_xc.payload")).drop("_xc")
    else:
        fetched = fetched.withColumn("_x", F.col("_heur"))

    # Page text and extraction are the expensive part: written once under
    # spark.checkpoint.dir and read by all that follow.
    rows = article_rows(fetched, "_x", now, keep=[*WINDOW, "kw_pos", "entry_pos", "error_type", "error_message", "_x"])
    rows = materialize(rows.withColumn("outcome", F.when(F.col("error_type").isNotNull(), FAILED).when(
        tables.required_ok(rows, ARTICLES, limits.get("articles")), INSERTED).otherwise(REJECTED)), "ingest_rows")

    return RunOutput(tagged, dropped if limit is not None else None, rows, existing_companies, existing_people,
                     existing_links, rid, now, limits, mode)
