"""Hard-negative mining: per anchor and positive, the best-scoring rows of other
labels within a window of the positive's score.

All rows are packed into shards of SHARD_ROWS, neighbours in (label, first
coordinate) order, each an STR-packed R-tree (str_tree.py).  Anchors meet the
shards in rounds of growing numbers of shards: each round deals anchors, in
slices, to the shards, searches best-first, and merges the best k found; the
next round starts from the k-th score so far.  So a round gives about as many
rows as the one before, however many shards there are.  Positives (same label)
meet only the shards that hold their label.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from math import gcd

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import drop_table, pick, write_table
from .str_tree import STRTree
from .vectors import matrix, shape, whole_vectors

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: Share of the positive's score, in percent, that a negative's score has.
LEAST, MOST = 30, 90
SHARD_ROWS = 8192
SLICE_ANCHORS = 256
#: Times as many shards in each round as in all before it.
GROWTH = 8
LOWEST, HIGHEST = -(1 << 62), 1 << 62


def _shards(dim: int, size: int, exact_float: bool):
    def shard(ids: list, labels: list, vectors: list) -> pa.RecordBatch:
        labels = np.array(labels, np.int64)
        tree = STRTree(np.array(ids, np.int64), labels, matrix(vectors, dim), exact_float)
        return pa.RecordBatch.from_arrays(
            [pa.array([np.unique(labels).tolist()], pa.list_(pa.int64())),
             pa.array([pickle.dumps(tree, protocol=5)], pa.binary())], ["labels", "tree"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = [], [], []
        for b in batches:
            ids += b.column("vec_id").to_pylist()
            labels += b.column("label").to_pylist()
            v = b.column("v")
            flat, at = v.values.to_numpy(zero_copy_only=False), v.offsets.to_numpy()
            vectors += [flat[x:y].copy() for x, y in zip(at[:-1], at[1:])]
            while len(ids) >= size:
                yield shard(ids[:size], labels[:size], vectors[:size])
                ids, labels, vectors = ids[size:], labels[size:], vectors[size:]
        if ids:
            yield shard(ids, labels, vectors)
    return make


def _search(dim: int, k: int, same_label: bool):
    """One slice of anchors against one shard."""
    def search(queries: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
        out = []
        for raw in shards["tree"]:
            tree = pickle.loads(raw)
            for q in queries.itertuples(index=False):
                windows = [(w["low"], w["high"], w["kth"]) for w in q.windows]
                for w, found in zip(q.windows, tree.search(matrix([q.v], dim)[0], q.label, q.anchor_id, windows, k,
                                                           same_label)):
                    out += [(q.anchor_id, w["win"], score, i) for score, i in found]
        return pd.DataFrame(out, columns=["anchor_id", "win", "score", "vec_id"]).astype("int64")
    return search


def search(queries: DataFrame, shards: DataFrame, dim: int, k: int, same_label: bool) -> DataFrame:
    """(anchor_id, win, score, vec_id, rank): the k best of each query
    (anchor_id, label, v) and window (``windows``: win, low, high)."""
    n_shards = shards.agg(F.max("shard")).first()[0] + 1
    slices = max(1, -(-queries.count() // SLICE_ANCHORS))
    queries = queries.withColumn("slice", F.pmod(F.xxhash64("anchor_id"), F.lit(slices)).cast("int"))
    order = Window.partitionBy("anchor_id", "win").orderBy(F.desc("score"), "vec_id")
    best, done = None, 0
    while done < n_shards:
        upto = min(n_shards, done + max(1, done * GROWTH))
        here = shards.where(F.col("shard").between(done, upto - 1))
        asked = queries.withColumn("kth", F.lit(None).cast("map<int,bigint>"))
        if best is not None:
            kth = (best.where(F.col("rank") == k).groupBy("anchor_id")
                   .agg(F.map_from_entries(F.collect_list(F.struct("win", "score"))).alias("kth")))
            asked = queries.join(kth, "anchor_id", "left")
        asked = asked.withColumn("windows", F.transform("windows", lambda w: F.struct(
            w["win"].alias("win"), w["low"].alias("low"), w["high"].alias("high"),
            F.try_element_at("kth", w["win"]).alias("kth"))))
        if same_label:
            held = here.select(F.col("shard").alias("for_shard"), F.explode("labels").alias("label"))
            asked = asked.join(held, "label")
        else:
            asked = asked.withColumn("for_shard", F.explode(F.sequence(F.lit(done), F.lit(upto - 1))))
        dealt = here.select(F.col("shard").alias("own_shard"), "tree", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("own_slice"))
        found = (asked.select("for_shard", "slice", "anchor_id", "label", "v", "windows").groupBy("for_shard", "slice")
                 .cogroup(dealt.groupBy("own_shard", "own_slice"))
                 .applyInPandas(_search(dim, k, same_label), "anchor_id long, win int, score long, vec_id long"))
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        old, best = best, write_table(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k),
                                      "negatives-best")
        if old is not None:
            drop_table(old)
        done = upto
    return best


def mine(rows: DataFrame, is_anchor, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST,
         scale: int = SCALE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score).

    Scores are inner products of floor(scale * x) vectors.  An anchor (a row for which ``is_anchor``, a condition on
    ``vec_id``, holds) has its ``positives`` best other rows of the same label as positives, and for each of them the
    ``negatives`` best rows of other labels whose score is ``least`` to ``most`` percent of the positive's; higher
    scores come first, ties by smaller id.

    Rows take no part if id, label or vector is null or a component is null or not finite.  Vectors are filled up
    with zeros to the longest one's length.  Repeated rows count as rows of their own, but a row of the anchor's id
    is not another row, and a repeated anchor id is one anchor (its least label and vector).  An empty table, or one
    without anchors, gives no rows.  Other columns are not looked at.  Components too large for exact 64-bit scores
    raise.
    """
    kept = whole_vectors(pick(rows, vec_id=vec_id, label=label, v=vector).where(
        "vec_id is not null and label is not null").select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "v"), scale)
    n, dim, largest = shape(kept)
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
              "negative_score long")
    if not n:
        return rows.sparkSession.createDataFrame([], schema)
    spread = (kept.withColumn("x", F.coalesce(F.get("v", F.lit(0)), F.lit(0)))
              .repartitionByRange(-(-n // shard_rows), "label", "x", "vec_id").select("vec_id", "label", "v"))
    packed = write_table(
        spread.mapInArrow(_shards(dim, shard_rows, dim * largest**2 < 1 << 53), "labels array<bigint>, tree binary")
        .withColumn("part", F.spark_partition_id()), "negatives-shards")
    # Shards of neighbouring partitions get distant numbers, so that each round meets all kinds of rows.
    parts = packed.agg(F.max("part")).first()[0] + 1
    step = next(k for k in range(max(1, int(parts * 0.618)), 2 * parts + 2) if gcd(k, parts) == 1)
    shards = packed.withColumn("shard", (F.col("part").cast("long") * step % parts).cast("int"))
    anchors = write_table(
        kept.where(is_anchor).groupBy(F.col("vec_id").alias("anchor_id"))
        .agg(F.min(F.struct("label", "v")).alias("r")).select("anchor_id", "r.label", "r.v"), "negatives-anchors")
    bound = lambda x: F.lit(x).cast("long")
    whole = F.array(F.struct(F.lit(0).alias("win"), bound(LOWEST).alias("low"), bound(HIGHEST).alias("high")))
    near = search(anchors.withColumn("windows", whole), shards, dim, positives, True)
    # least * p <= 100 * s <= most * p, for the whole number s.
    p = F.col("score")
    window = F.struct(F.col("rank").alias("win"), F.ceil(p * least / F.lit(100).cast("decimal(3,0)")).cast("long")
                      .alias("low"), F.floor(p * most / F.lit(100).cast("decimal(3,0)")).cast("long").alias("high"))
    asked = anchors.join(near.groupBy("anchor_id").agg(F.collect_list(window).alias("windows")), "anchor_id")
    far = search(asked, shards, dim, negatives, False)
    chosen = near.select("anchor_id", F.col("rank").alias("win"), F.col("vec_id").alias("positive_id"),
                         F.col("score").alias("positive_score"))
    return far.join(chosen, ["anchor_id", "win"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
