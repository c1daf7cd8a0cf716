"""Table writes (K1-K3, K9-K11): append-only, idempotent by construction.

There is no row-level table format here, so updates are rewrites: a
merge is an anti join + append, a patch is a join + coalesce written as a
new version.  A path that is being read is never overwritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def required_ok(df: DataFrame, schema: T.StructType, limits: dict[str, int] | None = None) -> Column:
    """True when every REQUIRED column of ``schema`` is non-NULL, every
    present value survives a cast to its declared type, and no text is longer
    than its column's ``limits`` (characters) allow."""
    ok = F.lit(True)
    for name, most in (limits or {}).items():
        ok = ok & F.coalesce(F.length(F.col(name)) <= most, F.lit(True))
    for f in schema.fields:
        if f.name not in df.columns:
            if not f.nullable:
                ok = ok & F.lit(False)
            continue
        c = F.col(f.name)
        if not f.nullable:
            ok = ok & c.isNotNull()
        ok = ok & (c.isNull() | c.try_cast(f.dataType).isNotNull())
    return ok


def split_valid(df: DataFrame, schema: T.StructType, flag: str = "_valid",
                limits: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """K2: (rows that would insert, rows that would be rejected).

    One projection computes the flag; both outputs are filters of it, so the
    input is scanned once per consumer and never collected.
    """
    flagged = df.withColumn(flag, required_ok(df, schema, limits))
    return flagged.filter(F.col(flag)).drop(flag), flagged.filter(~F.col(flag)).drop(flag)


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: add missing nullable columns as NULL,
    cast present ones, drop extras; a missing REQUIRED column is an error."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.nullable:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"required column {f.name!r} is missing")
    return df.select(*cols)


def append(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """K1: append rows to a parquet table (aligned to its schema)."""
    out = align_to_schema(df, schema) if schema is not None else df
    out.write.mode("append").parquet(path)


def merge_insert_only(source: DataFrame, target: DataFrame, keys) -> DataFrame:
    """K3: source rows not matched on ``keys`` in target (to be appended)."""
    return source.join(target.select(*keys).dropDuplicates(list(keys)), list(keys), "left_anti")


def patch(state: DataFrame, updates: DataFrame, key: str, as_of: Column) -> DataFrame:
    """K9: set only the supplied (non-NULL) fields of matching rows, plus
    ``updated_at``; rows without an update are unchanged."""
    upd_cols = [c for c in updates.columns if c != key]
    u = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in upd_cols]).withColumn("_hit", F.lit(True))
    j = state.join(u, key, "left")
    out = []
    for c in state.columns:
        if c == "updated_at":
            out.append(F.when(F.col("_hit"), as_of).otherwise(F.col(c)).alias(c))
        elif c in upd_cols:
            out.append(F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def seed_if_empty(existing: DataFrame, defaults: DataFrame, key: str) -> DataFrame:
    """Default rows for keys that have no row yet (append them)."""
    return defaults.join(existing.select(key), key, "left_anti")
