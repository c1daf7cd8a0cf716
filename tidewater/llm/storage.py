"""Intermediate tables in the shared folder, and small frame helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back: later
    stages start from files that survive the loss of any executor."""
    return write_partitioned(df, name)


def write_partitioned(df: DataFrame, name: str, *by: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.partitionBy(*by) if by else df.write
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._table_path = path
    return out


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table of ``write_table`` that nothing reads any more."""
    path = getattr(df, "_table_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that other
    columns of the input can't clash with working columns."""
    return df.select(*[F.col(f"`{src}`").alias(name) for name, src in cols.items()])
