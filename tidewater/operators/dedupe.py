"""First-wins deduplication (A5-A8, A10) and per-window first-N.

"First" is always an explicit position (W2) - never input order - so the
result is deterministic under any partitioning.  It is found on narrow rows:
the position columns are packed into one decimal, whose minimum per key is a
hash aggregate with a map-side step (a decimal is a fixed-width buffer; whole
rows as buffers would make it a sort aggregate).  So a key that holds a third
of all rows is one row per task on the wire.  If a frame has other columns,
the winners are then joined back on key and position: rows of a hot key have
different positions, so they are dealt to many tasks, and none is sorted
before the exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.strings import py_strip


#: Decimal digits that hold a null (0) and any value of a type, and the number that makes its values 1 or more.
_DIGITS = {"tinyint": (3, (1 << 7) + 1), "smallint": (5, (1 << 15) + 1), "int": (10, (1 << 31) + 1),
           "bigint": (20, (1 << 63) + 1), "boolean": (1, 1), "date": (7, 719_163), "timestamp": (20, (1 << 63) + 1)}
_MOST_DIGITS = 38


def _leaves(df: DataFrame, order: Sequence[str]) -> list[tuple[Column, str]]:
    """The order columns, structs as their fields one after another."""
    out, todo = [], [(F.col(c), df.schema[c].dataType) for c in order]
    while todo:
        c, kind = todo.pop(0)
        if isinstance(kind, T.StructType):
            todo = [(c[f.name], f.dataType) for f in kind.fields] + todo
        else:
            out.append((c, kind.simpleString()))
    return out


def _whole(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(21,0)")


def _number(c: Column, kind: str) -> Column:
    """A whole number in the order of ``c``, null first."""
    if kind in ("date", "timestamp", "boolean"):
        c = F.unix_date(c) if kind == "date" else F.unix_micros(c) if kind == "timestamp" else c.cast("int")
    return F.coalesce((c.cast("decimal(20,0)") + _whole(_DIGITS[kind][1])).cast("decimal(21,0)"), _whole(0))


def packed_positions(df: DataFrame, order: Sequence[str]) -> list[Column] | None:
    """Decimals that sort as the ``order`` columns do, one after another (each
    has at most 38 digits); None if a column's type has no fixed width."""
    packs, room = [], 0
    for c, kind in _leaves(df, order):
        if kind not in _DIGITS:
            return None
        digits = _DIGITS[kind][0]
        if digits > room:
            packs.append(_number(c, kind).cast("decimal(38,0)"))
            room = _MOST_DIGITS - digits
        else:
            packs[-1] = (packs[-1] * _whole(10 ** digits) + _number(c, kind)).cast("decimal(38,0)")
            room -= digits
    return packs


def first_wins(df: DataFrame, key: Column | str, order: Sequence[str],
               key_name: str = "dedupe_key") -> DataFrame:
    """Keep, per non-NULL key, the row with the smallest ``order`` tuple (a
    null is smallest; of rows equal in all of it, one is kept).

    Rows whose key is NULL are dropped (the reference skips them).  The
    output has the input's columns plus ``key_name``.
    """
    k = F.col(key) if isinstance(key, str) else key
    cols = df.columns
    packs = packed_positions(df, order)
    keyed = df.withColumn(key_name, k).filter(F.col(key_name).isNotNull())
    extra = [] if key_name in cols else [key_name]
    if packs is None:  # e.g. ordered by text
        best = keyed.groupBy(key_name).agg(F.min_by(F.struct(*[F.col(c) for c in cols]),
                                                    F.struct(*[F.col(c) for c in order])).alias("_row"))
        return best.select(*[F.col("_row")[c].alias(c) for c in cols], *extra)
    names = [f"_first_{i}" for i in range(len(packs))]
    left = keyed.withColumns(dict(zip(names, packs)))
    for name in names:  # more than one only if the order doesn't fit one decimal
        best = left.groupBy(F.col(key_name).alias("_best_key")).agg(F.min(name).alias("_best_pos"))
        left = left.join(best, (F.col(key_name) == F.col("_best_key")) & (F.col(name) == F.col("_best_pos")), "left_semi")
    # One row is left of each key, or some that are equal in the order.
    one = Window.partitionBy(key_name, *names).orderBy(F.xxhash64(*[c for c in cols if not _has_map(df.schema[c].dataType)]))
    return left.withColumn("_one", F.row_number().over(one)).filter("_one = 1").select(*cols, *extra)


def _has_map(kind: T.DataType) -> bool:
    text = kind.simpleString()
    return "map<" in text or "variant" in text


def company_key(name) -> Column:
    """trim+lower of a company name; '' -> NULL (no key)."""
    k = F.lower(py_strip(F.col(name) if isinstance(name, str) else name))
    return F.when(k != "", k)


def person_key(full_name, company) -> Column:
    """name|company, both trim+lower, NULL company as ''; blank name -> NULL."""
    n = F.lower(py_strip(F.col(full_name) if isinstance(full_name, str) else full_name))
    c = F.lower(py_strip(F.coalesce(F.col(company) if isinstance(company, str) else company, F.lit(""))))
    return F.when(n != "", F.concat(n, F.lit("|"), c))


def dedupe_urls(entries: DataFrame, url_col: str = "url", order: Sequence[str] = ("kw_pos", "entry_pos"),
                key: Column | None = None) -> DataFrame:
    """A5: first entry per URL (raw URL by default; pass a canonical key to
    dedupe after canonicalisation).  Missing/blank URLs are dropped."""
    k = key if key is not None else F.when(F.coalesce(F.col(url_col), F.lit("")) != "", F.col(url_col))
    return first_wins(entries, k, list(order), key_name="dedupe_key").drop("dedupe_key")


def dedupe_companies(df: DataFrame, name_col: str = "name",
                     order: Sequence[str] = ("article_pos", "elem_pos")) -> DataFrame:
    """First company per trim+lower(name)."""
    return first_wins(df, company_key(name_col), list(order), key_name="company_key")


def dedupe_people(df: DataFrame, name_col: str = "full_name", company_col: str = "primary_company",
                  order: Sequence[str] = ("article_pos", "elem_pos")) -> DataFrame:
    """First person per name|company key."""
    return first_wins(df, person_key(name_col, company_col), list(order), key_name="person_key")


def first_per_pair(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``first_wins`` for keys of several columns, in one exchange at most:
    each map task passes on one row per key (a window limit below the
    exchange), and rows that lie together by some of ``keys`` already stay
    where they are, so wide rows don't travel again just to be dropped."""
    ties = F.xxhash64(*[c for c in df.columns if not _has_map(df.schema[c].dataType)])
    w = Window.partitionBy(*keys).orderBy(*(packed_positions(df, order) or order), ties)
    return df.withColumn("_one", F.row_number().over(w)).filter("_one <= 1").drop("_one")


def dedupe_relations(df: DataFrame, order: Sequence[str] = ("article_pos", "elem_pos")) -> DataFrame:
    """First link per (article_id, person_key)."""
    keyed = df.filter(F.col("person_key").isNotNull() & F.col("article_id").isNotNull())
    return first_per_pair(keyed, ["article_id", "person_key"], list(order))


def first_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """O4 (global): the first n rows by position (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def first_n_per_group(df: DataFrame, n: int, group: Sequence[str], order: Sequence[str],
                      rank_col: str = "rank_in_group") -> DataFrame:
    """O4 (per window): row_number() <= n.  Spark plans this with a
    WindowGroupLimit below the shuffle, so each map task forwards at most n
    rows per group - a hot group does not land whole on one reducer."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)
