"""Session construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that a session without its own values gets: a modest static
# broadcast bound, a larger one for sizes measured at runtime (AQE), and
# skewed sort-merge partitions split.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(8 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidewater", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes.

    On a cluster ``master`` is left to spark-submit; locally pass
    ``local[N]``.  Shuffle partitions default to 2x cores locally; on a
    cluster size them to the data (AQE coalesces the small ones).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Complete the settings of a session we did not build: whatever its owner
    has set stays, except the time zone, which results depend on."""
    own = spark.conf.getAll
    for k, v in RUNTIME_CONF.items():
        if k not in own:
            spark.conf.set(k, v)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Python workers on this machine import the library from where it lies;
    # on a cluster it is installed or shipped with --py-files.
    env, home = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if home not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [home, env.get("PYTHONPATH")]))
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    A cluster names it.  Only a local master without one gets a fresh
    scratch folder, removed when the process ends; any other master raises,
    since executors would each write to a disk of their own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = local_scratch(spark.sparkContext.master)
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def local_scratch(master: str) -> str:
    """A scratch folder of this machine, for a local master only."""
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder all executors of {master} share")
    d = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    atexit.register(shutil.rmtree, d, ignore_errors=True)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique table location under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def materialize(df, name: str):
    """Cut lineage: write ``df`` once as a parquet table under the shared
    ``spark.checkpoint.dir`` and read it back.

    One job computes the plan and writes it (a reliable ``checkpoint()`` of
    an unpersisted DataFrame computes it twice: once to count, once to
    write); the files survive executor loss, and later stages read only the
    columns they use.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
