"""Union of per-keyword batches; a failed batch contributes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_batches(batches: list[tuple[int, DataFrame, bool]]) -> DataFrame:
    """(kw_pos, rows, failed) per batch -> rows of the successful batches,
    tagged with their keyword position (by-name union).  When every batch
    failed the result is empty, with the batches' columns."""
    if not batches:
        raise ValueError("no batches, so no columns")
    out = None
    for pos, df, failed in batches:
        d = df.withColumn("kw_pos", F.lit(pos))
        d = d.where(F.lit(False)) if failed else d
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out
