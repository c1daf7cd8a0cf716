"""T1 over several runs: keyed state, history as initial state, replay."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.streaming import ingest_stream as s

SCHEMA = T.StructType([T.StructField("url", T.StringType()), T.StructField("pos", T.LongType())])


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, target, checkpoint, history=None):
    s.ingest_stream(spark, folder, SCHEMA, target, checkpoint, history=history, order="pos")
    return {r.url: r.entry_pos for r in s.read_target(spark, target).collect()}


def test_two_batches_a_replay_and_history(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    history = spark.createDataFrame([("https://a.com/known",), (None,), ("https://a.com/known",)], "url string")
    land(spark, folder, [("https://A.com/x?utm_source=q", 5), ("https://a.com/x/", 2), ("https://a.com/known#f", 1),
                         ("", 3), (None, 4), ("https://a.com/nopos", None)]
         + [("https://hot.com/", 100 - k) for k in range(90)])
    first = {"https://a.com/x": 2, "https://a.com/nopos": (1 << 63) - 1, "https://hot.com/": 11}
    assert run(spark, folder, target, checkpoint, history) == first
    # The second run's history is never read: a table that would hide everything changes nothing.
    everything = spark.createDataFrame([("https://a.com/new",)], "url string")
    land(spark, folder, [("https://a.com/x", 0), ("https://a.com/new", 9), ("https://a.com/new", 8),
                         ("https://a.com/known", 7)])
    both = {**first, "https://a.com/new": 8}
    assert run(spark, folder, target, checkpoint, everything) == both
    s.forget_last_commit(spark, checkpoint)
    assert run(spark, folder, target, checkpoint, everything) == both
    assert s.read_target(spark, target).count() == len(both)
    # Nothing new landed: nothing is written.
    assert run(spark, folder, target, checkpoint, everything) == both


def test_a_batch_reads_neither_target_nor_history_again(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    stored = str(tmp_path / "stored")
    spark.createDataFrame([("https://a.com/known",)], "url string").write.parquet(stored)
    land(spark, folder, [("https://a.com/1", 1)])
    plan = s.first_entries(spark.readStream.schema(SCHEMA).parquet(folder), spark.read.parquet(stored), "url", "pos")
    assert plan.isStreaming
    run(spark, folder, target, checkpoint, spark.read.parquet(stored))
    progress = []
    land(spark, folder, [("https://a.com/2", 2), ("https://a.com/1", 0)])
    spark.conf.set(s.STATE_STORE, s.ROCKSDB)
    try:
        q = (plan.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        progress = [p for p in q.recentProgress if p.numInputRows]
        text = q._jsq.explainInternal(False)
    finally:
        spark.conf.unset(s.STATE_STORE)
    assert sum(p.numInputRows for p in progress) == 2  # the two landed rows, nothing stored
    assert "TransformWithState" in text and target not in text
    assert sorted(r.url for r in s.read_target(spark, target).collect()) == ["https://a.com/1", "https://a.com/2"]


def test_empty_history_and_no_files(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    spark.createDataFrame([], SCHEMA).write.parquet(folder)
    s.ingest_stream(spark, folder, SCHEMA, target, checkpoint, order="pos")
    land(spark, folder, [("https://a.com/1", 1)])
    assert run(spark, folder, target, checkpoint) == {"https://a.com/1": 1}
    assert s.read_target(spark, target).select(F.max("article_id")).first()[0] > 0
