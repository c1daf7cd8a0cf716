"""Several tables written as one commit.

A run appends to six tables and moves the ingestion state.  Written one after
the other, a run that dies in between leaves some of them changed.  Here a
run's rows are first staged as parquet folders that no reader knows of; then
one small manifest is published that names them all.  Readers see exactly what
the manifests up to a version name, so a run is visible whole or not at all.

Layout under a root folder (any file system that Spark writes to):

    data/<table>/<unique>/part-*.parquet      staged rows
    commits/<version, 20 digits>.json         what one run added or replaced

A manifest is written under a temporary name and renamed; a rename onto an
existing version fails, so of two runs that start from the same version one
gets a ``CommitConflict`` and can run again.  A run id commits once: running
it again returns its version and writes nothing.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .tables import align_to_schema


class CommitConflict(RuntimeError):
    """Another run has published the version that this one was to become."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def history(spark: SparkSession, root: str, version: int | None = None) -> list[dict]:
    """Manifests up to ``version`` (all by default), oldest first: one small
    entry per run."""
    folder = f"{root.rstrip('/')}/commits"
    fs = _fs(spark, folder)
    if not fs.exists(_path(spark, folder)):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(_path(spark, folder)))
    names = [n for n in names if n.endswith(".json") and not n.startswith((".", "_"))
             and (version is None or int(n[:-5]) <= version)]
    if not names:
        return []
    rows = spark.read.text([f"{folder}/{n}" for n in names], wholetext=True).collect()
    return sorted((json.loads(r[0]) for r in rows), key=lambda m: m["version"])


def latest(spark: SparkSession, root: str) -> int:
    """The newest version; -1 before the first commit."""
    found = history(spark, root)
    return found[-1]["version"] if found else -1


def read(spark: SparkSession, root: str, table: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """A table as of ``version`` (the newest by default); empty before its first rows."""
    folders: list[str] = []
    for m in history(spark, root, version):
        change = m["tables"].get(table)
        if change:
            folders = ([] if change["replace"] else folders) + [f"{root.rstrip('/')}/{change['folder']}"]
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    if not folders:
        return spark.createDataFrame([], nullable)
    return spark.read.schema(nullable).parquet(*folders)


def stage(df: DataFrame, root: str, table: str, schema: T.StructType | None = None) -> str:
    """Write a run's rows where no reader looks; the folder's name in the root."""
    folder = f"data/{table}/{uuid.uuid4().hex}"
    (align_to_schema(df, schema) if schema is not None else df).write.parquet(f"{root.rstrip('/')}/{folder}")
    return folder


def publish(spark: SparkSession, root: str, version: int, run_id: str, tables: dict[str, dict]) -> None:
    """Make staged folders visible, all together, as ``version``."""
    folder = f"{root.rstrip('/')}/commits"
    fs = _fs(spark, folder)
    fs.mkdirs(_path(spark, folder))
    draft, final = f"{folder}/_{uuid.uuid4().hex}", f"{folder}/{version:020d}.json"
    out = fs.create(_path(spark, draft), False)
    out.write(bytearray(json.dumps({"version": version, "run_id": run_id, "tables": tables}).encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, folder).toUri(),
                                                                  spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:  # unlike FileSystem.rename, never replaces an existing file
        context.rename(fs.makeQualified(_path(spark, draft)), fs.makeQualified(_path(spark, final)), no_options)
    except Exception as e:
        fs.delete(_path(spark, draft), False)
        if fs.exists(_path(spark, final)):
            raise CommitConflict(f"version {version} of {root} exists") from e
        raise


def commit(spark: SparkSession, root: str, run_id: str, appends: dict[str, DataFrame],
           replaces: dict[str, DataFrame] | None = None, schemas: dict[str, T.StructType] | None = None,
           base: int | None = None) -> int:
    """Stage all tables, then publish them as the version after ``base`` (the
    one whose tables the frames were computed from; the newest by default).
    Returns the version; the earlier one if ``run_id`` has committed already."""
    past = history(spark, root)
    for m in past:
        if m["run_id"] == run_id:
            return m["version"]
    base = (past[-1]["version"] if past else -1) if base is None else base
    schemas = schemas or {}
    tables = {}
    for replace, frames in ((False, appends), (True, replaces or {})):
        for name, df in frames.items():
            tables[name] = {"folder": stage(df, root, name, schemas.get(name)), "replace": replace}
    publish(spark, root, base + 1, run_id, tables)
    return base + 1


def vacuum(spark: SparkSession, root: str, older_than_seconds: float = 7 * 86400) -> list[str]:
    """Delete staged folders that no manifest names, left by runs that died or
    lost a conflict; returns their names.  Folders younger than
    ``older_than_seconds`` may belong to a run that is still at work."""
    data = f"{root.rstrip('/')}/data"
    fs = _fs(spark, data)
    if not fs.exists(_path(spark, data)):
        return []
    named = {c["folder"] for m in history(spark, root) for c in m["tables"].values()}
    before, gone = (time.time() - older_than_seconds) * 1000, []
    for table in fs.listStatus(_path(spark, data)):
        for folder in fs.listStatus(table.getPath()):
            name = f"data/{table.getPath().getName()}/{folder.getPath().getName()}"
            if name not in named and folder.getModificationTime() <= before:
                fs.delete(folder.getPath(), True)
                gone.append(name)
    return sorted(gone)
