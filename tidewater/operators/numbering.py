"""Global row numbers without a single task that holds all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def numbered(df: DataFrame, *order: Column, name: str = "row_no") -> DataFrame:
    """``df`` with its place, from 1, in the given order (which should be
    total; rows that are equal in it come in any order).

    Rows are dealt to ranges and sorted within them; the rows of the ranges
    before are added to the place within the range.  The sorted rows are
    written once, so counting and numbering see the same ranges; only one count
    per range goes to the driver.
    """
    place = F.monotonically_increasing_id()  # range number << 33 | place within it
    ranges = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place),
                         "numbered")
    part = F.shiftrightunsigned("_place", 33)
    sizes = sorted(ranges.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, total = [], 0
    for r in sizes:
        before.append((r["part"], total))
        total += r["n"]
    if not before:
        return ranges.withColumn(name, F.lit(None).cast("long")).drop("_place")
    offsets = F.map_from_arrays(F.array(*[F.lit(p).cast("long") for p, _ in before]),
                                F.array(*[F.lit(b).cast("long") for _, b in before]))
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return ranges.withColumn(name, F.element_at(offsets, part) + within + 1).drop("_place")
