"""The URL column of a sheet export (CSV), header-aware."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.exports import CSV_READ

URL_COLUMN_INDEX = 3  # fixed value: the third column holds the URL


def url_column(spark: SparkSession, path: str, index: int = URL_COLUMN_INDEX) -> DataFrame:
    """Distinct values of column ``index`` (1-based); the first record of a
    file is dropped only when its value is 'url' (any case).

    Cells may hold line breaks and quotes, so a file is read record by record
    (by one task; a sheet has many files).  The first record of each file is
    its least monotonically increasing id (one small aggregate + join).
    """
    raw = (spark.read.options(header=False, **CSV_READ).csv(path)
           .select(F.col(f"_c{index - 1}").alias("url"), F.input_file_name().alias("_file"),
                   F.monotonically_increasing_id().alias("_rid")))
    first = raw.groupBy("_file").agg(F.min("_rid").alias("_rid")).withColumn("_first", F.lit(True))
    marked = raw.join(first, ["_file", "_rid"], "left")
    header = F.coalesce(F.col("_first"), F.lit(False)) & (F.lower(F.col("url")) == "url")
    return marked.filter(~header).select(F.coalesce(F.col("url"), F.lit("")).alias("url")).distinct()
