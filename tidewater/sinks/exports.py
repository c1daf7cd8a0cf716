"""Exports: sheet rows (K5), CSV reports (K6), Markdown lines (K7),
briefing text (K8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's behaviour) -------------------
SHEET_COLUMNS = ["date", "title", "url", "summary", "author", "entities"]
# -----------------------------------------------------------------------------


# CSV as spreadsheets and standard readers take it: a quote inside a field is
# doubled, blanks stay, and fields may hold line breaks (so files are read
# record by record).
CSV_WRITE = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
CSV_READ = {"escape": '"', "multiLine": True}


def sheet_rows(df: DataFrame) -> DataFrame:
    """K5 projection: the six positional cells, missing -> ''."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in SHEET_COLUMNS])


def append_sheet_rows(df: DataFrame, path: str) -> None:
    """K5: append rows to a CSV 'sheet' (header line per file)."""
    sheet_rows(df).write.mode("append").options(header=True, **CSV_WRITE).csv(path)


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The six cells of every row of a sheet, missing -> ''."""
    back = spark.read.options(header=True, **CSV_READ).schema(", ".join(f"{c} string" for c in SHEET_COLUMNS)).csv(path)
    return sheet_rows(back)


def write_csv_report(df: DataFrame, path: str, columns: list[str]) -> None:
    """K6: CSV with header and a fixed column order."""
    df.select(*columns).write.mode("overwrite").options(header=True, **CSV_WRITE).csv(path)


def read_csv_report(spark: SparkSession, path: str) -> DataFrame:
    """K6 read back: text columns by the file's header."""
    return spark.read.options(header=True, **CSV_READ).csv(path)
