"""Lookback report (E2): scans, joins, counts, orderings, Markdown lines.

The reference collects article ids to the driver and sends them back as an
array parameter; here the recent-article set stays a DataFrame and the
people query is a semi join against it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import in_lookback, iso_utc
from .numbering import numbered

# ---- fixed values (must equal the reference's behaviour) -------------------
REPORT_TITLE = "# Data Center Water News Report"
TOP_RELEVANT = 10
RELEVANCE_RANK = {"High": 1, "Medium": 2, "Low": 3}
ARTICLE_CSV_COLUMNS = ["article_id", "title", "source_name", "publish_datetime", "url",
                       "mentions_cooling_or_water", "cooling_water_summary"]
PEOPLE_CSV_COLUMNS = ["article_id", "full_name", "primary_title", "primary_company", "lead_relevance",
                      "role_in_article"]
FAILURE_CSV_COLUMNS = ["stage", "failure_count"]
NO_RELEVANT = "No relevant articles in the selected window."
NO_FAILURES = "No failures recorded in the selected window."
# -----------------------------------------------------------------------------


def recent_articles(articles: DataFrame, as_of: Column, days: int) -> DataFrame:
    """P6 + S4: the report's article columns in the lookback window."""
    return articles.filter(in_lookback("publish_datetime", as_of, days)).select(
        "article_id", "title", "source_name", "publish_datetime", "url", "mentions_cooling_or_water",
        "cooling_water_summary")


def newest_first(df: DataFrame) -> DataFrame:
    """O1 (article_id breaks ties)."""
    return df.orderBy(F.col("publish_datetime").desc(), "article_id")


def people_links(article_people: DataFrame, people: DataFrame, recent: DataFrame) -> DataFrame:
    """J7 + J8: people of the recent articles (inner join + semi join)."""
    ap = article_people.join(recent.select("article_id"), "article_id", "left_semi")
    return ap.join(people, "person_id", "inner").select(
        "article_id", "full_name", "primary_title", "primary_company", "lead_relevance", "role_in_article")


def people_order(df: DataFrame, rank_order: bool = False) -> DataFrame:
    """O2: lead_relevance DESC (string order: Medium > Low > High), then
    full_name; ``rank_order`` sorts High, Medium, Low instead."""
    if rank_order:
        rank = F.coalesce(*[F.when(F.col("lead_relevance") == k, F.lit(v)) for k, v in RELEVANCE_RANK.items()],
                          F.lit(len(RELEVANCE_RANK) + 1))
        return df.orderBy(rank, "full_name")
    return df.orderBy(F.col("lead_relevance").desc(), "full_name")


def failures_by_stage(failures: DataFrame, as_of: Column, days: int) -> DataFrame:
    """A1: failure count per stage in the lookback window."""
    f = failures.filter(in_lookback("created_at", as_of, days))
    return f.groupBy("stage").agg(F.count(F.lit(1)).alias("failure_count"))


def stages_by_count(df: DataFrame) -> DataFrame:
    """O3 (stage breaks ties)."""
    return df.orderBy(F.col("failure_count").desc(), "stage")


def totals(recent: DataFrame, links: DataFrame) -> DataFrame:
    """A4: total articles, relevant articles, people links (one row)."""
    a = recent.agg(F.count(F.lit(1)).alias("total_articles"),
                   F.count_if(F.coalesce(F.col("mentions_cooling_or_water"), F.lit(False))).alias("relevant_articles"))
    p = links.agg(F.count(F.lit(1)).alias("people_links"))
    return a.crossJoin(p)  # 1 x 1 rows


def top_relevant(recent: DataFrame, n: int = TOP_RELEVANT) -> DataFrame:
    """O5 + W1: the n newest relevant articles, numbered 1..n (the window
    runs after the limit, so its single partition holds at most n rows)."""
    top = recent.filter(F.coalesce(F.col("mentions_cooling_or_water"), F.lit(False))) \
        .orderBy(F.col("publish_datetime").desc(), "article_id").limit(n)
    w = Window.orderBy(F.col("publish_datetime").desc(), "article_id")
    return top.withColumn("position", F.row_number().over(w))


def presentation(df: DataFrame) -> DataFrame:
    """NULL -> '' for text, ISO text for timestamps, bool kept."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        t = f.dataType.typeName()
        if t in ("timestamp", "timestamp_ntz"):
            out.append(F.coalesce(iso_utc(c.cast("timestamp")), F.lit("")).alias(f.name))
        elif t == "string":
            out.append(F.coalesce(c, F.lit("")).alias(f.name))
        elif t == "boolean":
            out.append(F.coalesce(c, F.lit(False)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def markdown_lines(totals_df: DataFrame, top: DataFrame, stages: DataFrame, *, generated: Column,
                   project: str, dataset: str, days: int, files: dict[str, str]) -> DataFrame:
    """K7: the report as (section, line_no, line) rows; sorting by
    (section, line_no) gives the file (one totals row, <= 10 articles, a line
    per stage, numbered without a single task for all of them)."""
    def lit_lines(section: int, lines: list[str]) -> list[Column]:
        return [F.struct(F.lit(section).alias("section"), F.lit(i).alias("line_no"), F.lit(s).alias("line"))
                for i, s in enumerate(lines)]

    def fmt(label: str, c: Column, pre: str = "- ") -> Column:
        return F.concat(F.lit(f"{pre}{label}: `"), c.cast("string"), F.lit("`"))

    head = totals_df.select(F.explode(F.array(
        *lit_lines(0, [REPORT_TITLE, ""]),
        F.struct(F.lit(0).alias("section"), F.lit(2).alias("line_no"),
                 F.concat(F.lit("- Generated UTC: "), iso_utc(generated)).alias("line")),
        *[F.struct(F.lit(0).alias("section"), F.lit(3 + i).alias("line_no"), v.alias("line")) for i, v in enumerate([
            fmt("Project", F.lit(project)), fmt("Dataset", F.lit(dataset)), fmt("Lookback days", F.lit(days)),
            fmt("Total articles", F.col("total_articles")),
            fmt("Relevant articles (`mentions_cooling_or_water=true`)", F.col("relevant_articles")),
            fmt("People links", F.col("people_links"))])],
        *lit_lines(1, ["", "## Top Relevant Articles", ""]),
        F.struct(F.lit(3).alias("section"), F.lit(0).alias("line_no"),
                 F.when(F.col("relevant_articles") == 0, F.lit(NO_RELEVANT)).alias("line")),
    )).alias("l")).select("l.*").filter(F.col("line").isNotNull())

    p = presentation(top)
    entries = p.select(F.explode(F.array(
        F.struct(F.lit(2).alias("section"), (F.col("position") * 10).alias("line_no"),
                 F.concat(F.col("position").cast("string"), F.lit(". **"), F.col("title"), F.lit("** ("),
                          F.col("source_name"), F.lit(")")).alias("line")),
        F.struct(F.lit(2).alias("section"), (F.col("position") * 10 + 1).alias("line_no"),
                 F.concat(F.lit("   - Published: "), F.col("publish_datetime")).alias("line")),
        F.struct(F.lit(2).alias("section"), (F.col("position") * 10 + 2).alias("line_no"),
                 F.concat(F.lit("   - URL: "), F.col("url")).alias("line")),
        F.struct(F.lit(2).alias("section"), (F.col("position") * 10 + 3).alias("line_no"),
                 F.when(F.col("cooling_water_summary") != "",
                        F.concat(F.lit("   - Note: "), F.col("cooling_water_summary"))).alias("line")),
        F.struct(F.lit(2).alias("section"), (F.col("position") * 10 + 4).alias("line_no"),
                 F.lit("").alias("line")),
    )).alias("l")).select("l.*").filter(F.col("line").isNotNull())

    ranked = numbered(stages, F.col("failure_count").desc(), F.col("stage").asc(), name="rank")
    fails = ranked.select(F.lit(5).alias("section"), F.col("rank").cast("int").alias("line_no"),
                          F.concat(F.lit("- "), F.col("stage"), F.lit(": "),
                                   F.col("failure_count").cast("string")).alias("line"))
    no_fail = stages.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(5).alias("section"), F.lit(0).alias("line_no"),
        F.when(F.col("n") == 0, F.lit(NO_FAILURES)).alias("line")).filter(F.col("line").isNotNull())
    tail_lines = ["", "## Output Files", ""] + [f"- {k}: `{v}`" for k, v in files.items()]
    rest = totals_df.select(F.explode(F.array(
        *lit_lines(4, ["## Failure Summary", ""]), *lit_lines(6, tail_lines))).alias("l")).select("l.*")
    return head.unionByName(entries).unionByName(fails).unionByName(no_fail).unionByName(rest)
