"""Daily briefing (E3): top-3 message text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.strings import py_strip

# ---- fixed values (must equal the reference's behaviour) -------------------
BRIEFING_HEADER = "\U0001F30A Data Center & Water Briefing \U0001F30A\n\n"
EMPTY_MESSAGE = "No new articles found today."
NO_SUMMARY, NO_TITLE, NO_URL = "No summary available.", "No Title", "No URL"
TOP_N = 3
# -----------------------------------------------------------------------------


def top_entries(articles: DataFrame, n: int = TOP_N) -> DataFrame:
    """The first n articles in list order (``pos``)."""
    return articles.orderBy("pos").limit(n)


def briefing_message(articles: DataFrame, n: int = TOP_N) -> DataFrame:
    """K8: one row with the message; columns pos, title, url, summary.

    ``summary`` is the answer's summary, else its 'brief', else the default
    (callers pass NULL when the answer is missing or not an object).
    """
    top = top_entries(articles, n)
    entry = F.struct(F.col("pos"), F.concat(
        F.col("pos_rank").cast("string"), F.lit(". *"), F.coalesce("title", F.lit(NO_TITLE)), F.lit("*\nSummary: "),
        F.coalesce("summary", F.lit(NO_SUMMARY)), F.lit("\nLink: "), F.coalesce("url", F.lit(NO_URL)),
        F.lit("\n\n")).alias("text"))
    from pyspark.sql import Window
    ranked = top.withColumn("pos_rank", F.row_number().over(Window.orderBy("pos")))
    agg = ranked.agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(entry)).alias("entries"))
    body = F.concat(F.lit(BRIEFING_HEADER), F.array_join(F.transform("entries", lambda e: e["text"]), ""))
    return agg.select(F.when(F.col("n") == 0, F.lit(EMPTY_MESSAGE)).otherwise(py_strip(body)).alias("message"))
