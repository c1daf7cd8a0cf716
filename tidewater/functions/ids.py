"""Deterministic 60-bit ids (no coordination, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import col_, py_strip

# fixed value: entity prefixes used as the first id part
ARTICLE, COMPANY, PERSON, FAILURE = "article", "company", "person", "failure"


def stable_id(prefix: str, *cols) -> Column:
    """First 15 hex digits of SHA-256 over the key, as a BIGINT."""
    parts = [F.lit(prefix)] + [col_(c) for c in cols]
    key = F.concat_ws("|", *[F.lower(py_strip(F.coalesce(p.cast("string"), F.lit("")))) for p in parts])
    return F.conv(F.substring(F.sha2(key, 256), 1, 15), 16, 10).cast("bigint")
