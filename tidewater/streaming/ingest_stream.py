"""Incremental ingest of landed entries, each canonical URL once.

A file stream (``availableNow``) replaces the reference's window cutoff: the
checkpoint records which files were consumed.  What is known is keyed
streaming state (RocksDB): one small value per canonical URL, kept where the
URL's rows are dealt to.  The articles stored before the stream's first start
are loaded once, as initial state; from then on a batch costs what its own
entries cost, and neither history nor target is read again.

Entries of a URL that is in the state already are what the reference counts
as 'updated' and doesn't modify.  Of several new entries in one batch the one
of the smallest position wins; repeats inside a task are dropped before the
shuffle, so a URL with a third of all entries doesn't meet whole in one task.

The target is a parquet file sink: a batch that is run again after a failure
(same files, same state version) finds its output already committed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import ids, urls

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ARTICLE_KEYS = T.StructType([T.StructField("url", T.StringType()), T.StructField("article_id", T.LongType()),
                             T.StructField("entry_pos", T.LongType())])
#: Position kept for a URL that was stored before the stream began.
STORED = -1


class FirstEntry(StatefulProcessor):
    """State of one canonical URL: the position of the entry that made it known."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "entry_pos long")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.first.update((STORED,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        least = min(r["entry_pos"] for r in rows)
        if not self.first.exists():
            self.first.update((least,))
            yield Row(url=key[0], entry_pos=least)

    def close(self) -> None:
        pass


def _first_of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per URL of each Arrow batch."""
    for b in batches:
        least = pa.table({"url": b.column("url"), "entry_pos": b.column("entry_pos")}).group_by("url").aggregate(
            [("entry_pos", "min")])
        yield pa.RecordBatch.from_arrays([least["url"].combine_chunks(),
                                          pc.cast(least["entry_pos_min"], pa.int64()).combine_chunks()],
                                         ["url", "entry_pos"])


def first_entries(entries: DataFrame, history: DataFrame, url_col: str = "url", order: str = "entry_pos") -> DataFrame:
    """The streaming plan: (url, article_id, entry_pos) of each canonical URL's
    first entry.  ``history`` (batch, column ``url``, canonical) is read by the
    stream's first batch only.  Entries without a URL are skipped; a null
    position counts as the last one."""
    last = F.lit((1 << 63) - 1)
    e = urls.with_canonical_url(entries.select(url_col, F.coalesce(F.col(order).cast("long"), last)
                                               .alias("entry_pos")), url_col, "canonical_url")
    e = e.filter(F.coalesce(F.col("canonical_url"), F.lit("")) != "").select(
        F.col("canonical_url").alias("url"), "entry_pos")
    known = history.filter("url is not null").select("url").distinct()
    found = (e.mapInArrow(_first_of_batch, "url string, entry_pos long").groupBy("url")
             .transformWithState(FirstEntry(), "url string, entry_pos long", "Append", "None",
                                 initialState=known.groupBy("url")))
    return found.select("url", ids.stable_id(ids.ARTICLE, F.col("url")).alias("article_id"), "entry_pos")


def ingest_stream(spark: SparkSession, source_path: str, schema: T.StructType, target: str, checkpoint: str,
                  history: DataFrame | None = None, url_col: str = "url", order: str = "entry_pos",
                  max_files_per_trigger: int | None = None) -> None:
    """Run the stream to completion over what has landed since its last run
    (``availableNow``); start it again with the same checkpoint to go on.

    The number of shuffle partitions at the first start is the number of state
    partitions for good.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    known = history if history is not None else spark.createDataFrame([], "url string")
    own = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        (first_entries(reader.parquet(source_path), known, url_col, order).writeStream.format("parquet")
         .option("path", target).option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start().awaitTermination())
    finally:
        spark.conf.set(STATE_STORE, own) if own else spark.conf.unset(STATE_STORE)


def read_target(spark: SparkSession, target: str) -> DataFrame:
    """Committed rows only: the sink's log names its files."""
    return spark.read.schema(ARTICLE_KEYS).parquet(target)


def forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """As after a driver lost between a batch's output and its commit: the next
    start runs the last batch again, with the same files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().isdigit()]
    fs.delete(max(done, key=lambda p: int(p.getName())), False)
