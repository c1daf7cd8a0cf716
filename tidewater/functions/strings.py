"""String helpers that reproduce Python ``str`` semantics with JVM regexes.

Spark's ``trim`` strips spaces only; Python's ``strip`` strips every
character for which ``str.isspace()`` is true.  ``(?U)\\s`` (Unicode
White_Space) plus the four information separators U+001C..U+001F is that
set.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's whitespace class (str.isspace) as a Java regex character class.
PY_WS = r"[\s\x{1C}-\x{1F}]"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``"""
    return F.regexp_replace(col_(c), rf"(?U)^{PY_WS}+|{PY_WS}+$", "")


def py_rstrip(c) -> Column:
    """``str.rstrip()``"""
    return F.regexp_replace(col_(c), rf"(?U){PY_WS}+$", "")


def blank_to_null(c) -> Column:
    """NULL for NULL or the empty string (Python falsiness of a str)."""
    c = col_(c)
    return F.when(c != "", c)


def truthy_str(c) -> Column:
    """Python truthiness of an optional str column."""
    c = col_(c)
    return c.isNotNull() & (c != "")


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it in ``body`` (a Column -> Column lambda).

    A sub-expression referenced several times inside one expression is
    otherwise copied into the tree once per reference.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def bind_columns(df, **cols):
    """Add computed columns as the output of a one-row generator.

    A later filter on such a column stays above the generator, instead of
    being pushed down with the (expensive) expression substituted into it -
    which would evaluate the expression once in the filter and again in
    the projection.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))
