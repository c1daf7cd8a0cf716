"""Request manifest (S6, J10): keyword x window -> feed search request.

The keyword list is fixed and small (7), so pairing it with windows is a
generator (``posexplode`` of a literal array) on the window rows - linear in
the windows, no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import quote_path

# ---- fixed values (must equal the reference's behaviour) -------------------
KEYWORDS = ["data center", "data centre", "hyperscale data center", "colocation data center",
            "data center cooling", "data center water usage", "data center sustainability"]
FEED_SEARCH_URL = "https://news.google.com/rss/search"
LOCALE_SUFFIX = "&hl=en-US&gl=US&ceid=US:en"
# -----------------------------------------------------------------------------


def keyword_windows(windows: DataFrame, keywords: list[str] = KEYWORDS) -> DataFrame:
    """Every (keyword, window) pair with the keyword's position."""
    return windows.select("*", F.posexplode(F.array(*[F.lit(k) for k in keywords])).alias("kw_pos", "keyword"))


def request_manifest(pairs: DataFrame, base_url: str = FEED_SEARCH_URL) -> DataFrame:
    """Query text 'kw after:START before:END+1' and its percent-encoded
    request URL (the remote 'before:' is exclusive, hence END + 1)."""
    q = F.concat(F.col("keyword"), F.lit(" after:"), F.col("window_start").cast("string"),
                 F.lit(" before:"), F.date_add("window_end", 1).cast("string"))
    return pairs.withColumn("query_text", q).withColumn(
        "request_url", F.concat(F.lit(base_url + "?q="), quote_path(q), F.lit(LOCALE_SUFFIX)))
