"""Size-proven broadcast: small dimensions are broadcast, large ones are not."""

from pyspark.sql import functions as F

from tidewater.operators.sizing import broadcast_if_small, proven_small


def test_small_table_is_proven_and_broadcast(spark):
    small = spark.range(25).withColumn("name", F.concat(F.lit("n"), F.col("id").cast("string")))
    assert proven_small(small)
    big = spark.range(1000)
    plan = big.join(broadcast_if_small(small), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_row_and_byte_bounds(spark):
    df = spark.range(50)
    assert not proven_small(df, max_rows=49)
    assert proven_small(df, max_rows=50)
    assert not proven_small(df, max_bytes=10)
    assert broadcast_if_small(df, max_rows=10) is df


def test_materialize_writes_under_checkpoint_dir(spark):
    from tidewater.session import materialize
    df = spark.range(100).select((F.col("id") * 2).alias("x"), F.struct(F.col("id").alias("a")).alias("s"))
    out = materialize(df, "unit")
    files = out.inputFiles()
    assert files and all(spark.conf.get("spark.checkpoint.dir").rstrip("/").split(":")[-1] in f for f in files)
    assert sorted(r.x for r in out.collect()) == sorted(r.x for r in df.collect())
    assert out.schema.simpleString() == df.schema.simpleString()
