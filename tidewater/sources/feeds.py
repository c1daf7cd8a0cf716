"""Landed feed sources: RSS items (S1), news-API responses (S2), pages (S3).

Network fetching is out of scope; these read what a fetcher landed
(files or string columns) and produce entry rows with positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import feed_date
from ..functions.text import html_to_text

# ---- fixed values (must equal the reference's behaviour) -------------------
DEFAULT_SOURCE = "Unknown"
OK_STATUS = "ok"
# -----------------------------------------------------------------------------

RSS_ITEM_SCHEMA = ("title string, link string, pubDate string, description string, "
                   "source struct<_url: string, _VALUE: string>")
NEWS_API_SCHEMA = ("status string, articles array<struct<title: string, url: string, description: string, "
                   "content: string, publishedAt: string, author: string>>")


def parse_rss_items(items: DataFrame, xml_col: str, now: Column) -> DataFrame:
    """S1 on an ``<item>`` XML string column: title, url, source_name
    (default 'Unknown'), publish_datetime (missing -> NULL, unparseable ->
    now), summary = text of the description HTML."""
    x = F.from_xml(F.col(xml_col), RSS_ITEM_SCHEMA)
    return items.select("*", x.alias("_i")).select(
        *[c for c in items.columns if c != xml_col],
        F.col("_i.title").alias("title"), F.col("_i.link").alias("url"),
        F.coalesce(F.col("_i.source._VALUE"), F.lit(DEFAULT_SOURCE)).alias("source_name"),
        feed_date(F.col("_i.pubDate"), now).alias("publish_datetime"),
        F.coalesce(html_to_text(F.col("_i.description")), F.lit("")).alias("summary"))


ITEM = r"(?s)<item\b.*?</item\s*>"


def landed_texts(spark: SparkSession, path: str, positions: str, stream: bool = False,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed text files, one row each (``value``), with the numbers that their
    folders are named by (``kw_pos=3/feed_pos=12/...``).  As a stream, the
    file source's checkpoint says which files have been read."""
    reader = (spark.readStream if stream else spark.read).schema(f"value string, {positions}").option("wholetext", True)
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format("text").load(path)


def read_feeds(spark: SparkSession, path: str, now: Column, positions: str = "kw_pos int, feed_pos int",
               stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 on landed feed files, as a batch or a stream: one row per <item> with
    its folder's positions and ``entry_pos``, its place in the file.  A file
    is one row until its items are numbered, so places don't depend on how
    files are split among tasks."""
    texts = landed_texts(spark, path, positions, stream, max_files_per_trigger)
    names = [c for c in texts.columns if c != "value"]
    items = texts.select(*names, F.posexplode(F.regexp_extract_all("value", F.lit(ITEM), F.lit(0)))
                         .alias("entry_pos", "item_xml"))
    return parse_rss_items(items, "item_xml", now)


def stream_to_table(rows: DataFrame, target: str, checkpoint: str) -> None:
    """Append what has landed since the checkpoint's last run; a batch that is
    run again finds its output committed."""
    (rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def news_api_articles(responses: DataFrame, body_col: str, *pos_cols: str) -> DataFrame:
    """Responses with status 'ok', exploded to one row per article with
    the response's positions (the last one as ``resp_pos``) and the article's
    place kept."""
    names = [*pos_cols[:-1], "resp_pos"]
    r = responses.select(*pos_cols[:-1], F.col(pos_cols[-1]).alias("resp_pos"),
                         F.from_json(F.col(body_col), NEWS_API_SCHEMA).alias("r"))
    r = r.filter(F.col("r.status") == OK_STATUS)
    e = r.select(*names, F.posexplode("r.articles").alias("art_pos", "a"))
    return e.select(*names, "art_pos", "a.title", "a.url", "a.description", "a.content", "a.publishedAt",
                    "a.author")


def read_news_api(spark: SparkSession, path: str, positions: str = "file_pos int", one_per_line: bool = True,
                  stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """S2 on landed response files, as a batch or a stream: a response per line
    (``resp_pos``, counted in its file), or one document per file."""
    texts = landed_texts(spark, path, positions, stream, max_files_per_trigger)
    names = [c for c in texts.columns if c != "value"]
    lines = F.split("value", "\r?\n") if one_per_line else F.array("value")
    bodies = texts.select(*names, F.posexplode(lines).alias("resp_pos", "body"))
    return news_api_articles(bodies, "body", *names, "resp_pos")


def read_pages(spark: SparkSession, path: str, *positions: str, stream: bool = False) -> DataFrame:
    """S3: landed raw pages (url, html, and fetch positions), columns pruned at
    the scan; as a stream, of the files that have landed since the last run."""
    if stream:
        return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path).select(*positions, "url", "html")
    return spark.read.parquet(path).select(*positions, "url", "html")
