"""Date/time column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .strings import col_, py_strip

# ---- fixed values (must equal the reference's behaviour) -------------------
# Feed date formats tried, besides ISO 8601, after a weekday is removed:
# RFC 822/1123 with two- and four-digit years, offsets or zone names and
# optional seconds, month names first, ctime, and slashed dates.
FEED_DATE_FORMATS = ["d MMM yyyy[ HH:mm[:ss]][ xx]", "d MMM yyyy HH:mm[:ss] z",
                     "d MMM yyyy HH:mm[:ss] xxx", "d MMM yy HH:mm[:ss][ xx]", "d MMM yy HH:mm[:ss] z",
                     "d MMMM yyyy[ HH:mm[:ss]][ xx]", "MMM d, yyyy[ HH:mm[:ss]]", "MMM d, yyyy h:mm[:ss] a",
                     "MMMM d, yyyy[ HH:mm[:ss]]", "MMMM d, yyyy h:mm[:ss] a", "MMM d HH:mm:ss yyyy",
                     "yyyy/M/d[ HH:mm[:ss]]", "M/d/yyyy[ HH:mm[:ss]]", "M/d/yyyy h:mm[:ss] a"]
WEEKDAY = r"(?i)^(mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(day)?\.?,?\s+"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}([T ].*)?$"
# -----------------------------------------------------------------------------


def in_publish_window(ts, start, end) -> Column:
    """P5: inclusive [start, end] days as ts >= start AND ts < end + 1 day."""
    return (col_(ts) >= col_(start).cast("timestamp")) & \
        (col_(ts) < F.date_add(col_(end).cast("date"), 1).cast("timestamp"))


def in_lookback(ts, as_of, days: int) -> Column:
    """Ts >= as_of - N days (N > 0)."""
    if days <= 0:
        raise ValueError("days must be > 0")
    return col_(ts) >= col_(as_of) - F.make_dt_interval(F.lit(days))


def as_date(c, dtype: T.DataType) -> Column:
    """P10: date -> itself; timestamp -> its date; ISO text with 'T' -> the
    date written before the 'T'; plain ISO date text; anything else NULL."""
    x = col_(c)
    if isinstance(dtype, T.DateType):
        return x
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(x)
    s = py_strip(x.cast("string"))
    return F.when(F.instr(s, "T") > 0, F.try_to_date(F.substring_index(s, "T", 1), "yyyy-MM-dd")) \
        .otherwise(F.try_to_date(s, "yyyy-MM-dd"))


def iso_utc(ts) -> Column:
    """Python ``isoformat()`` of a UTC timestamp (micros only when
    non-zero, '+00:00' offset)."""
    t = col_(ts).cast("timestamp")
    micros = F.unix_micros(t) % 1_000_000
    return F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
                    .otherwise(F.lit("")), F.lit("+00:00"))


def feed_date(c, now) -> Column:
    """Feed date text -> timestamp (without an offset: UTC, the session's
    zone); a weekday is removed first; unparseable text -> ``now`` (as the
    reference does); NULL stays NULL."""
    x = col_(c)
    s = F.regexp_replace(F.regexp_replace(py_strip(x), WEEKDAY, ""), r"\s+", " ")
    s = F.regexp_replace(s, r" (GMT|UT|UTC|Z)$", " +0000")
    iso = F.when(s.rlike(ISO_DATE), F.regexp_replace(s, r"(:\d{2}(?:\.\d+)?) ?([+-]\d{2}):?(\d{2})$", "$1$2:$3"))
    parsed = F.coalesce(iso.try_cast("timestamp"), *[F.try_to_timestamp(s, F.lit(f)) for f in FEED_DATE_FORMATS])
    return F.when(x.isNull(), F.lit(None).cast("timestamp")).otherwise(F.coalesce(parsed, col_(now)))
