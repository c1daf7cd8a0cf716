"""Broadcast only behind a runtime size proof.

Beyond the session's static bound (``session.RUNTIME_CONF``), AQE broadcasts
a join side only after a shuffle has measured it.  That still shuffles the
large side once, and a join on a low-cardinality key (e.g. 25 nation keys)
sends the whole large side to at most that many reducers.  For a dimension
that a bounded probe shows to be small, mark the broadcast up front.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 100_000
MAX_BYTES = 8 * 1024 * 1024


def proven_small(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows whose JSON text totals
    at most ``max_bytes``.  The probe reads at most ``max_rows + 1`` rows."""
    probe = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))), F.lit(0)).alias("b")).first()
    return probe["n"] <= max_rows and probe["b"] <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` when the probe proves it small, else ``df`` (joins
    are then left to AQE's runtime sizes and skew handling)."""
    return F.broadcast(df) if proven_small(df, max_rows, max_bytes) else df
