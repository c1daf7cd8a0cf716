"""Vector code compression: product-quantisation codes with integer codebooks.

Rows are packed into shards of SHARD_ROWS; for each part position, a shard
holds a metric tree (ball_tree.py) of its parts, built once.  A round of
refinement sends the codebooks (parts x entries x part length integers, a fixed
size) to the shards; a ball that one entry owns wholly adds its cached sum and
count, so most points aren't looked at.  Only sums per entry and position come
back, added up per task first.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ball_tree import BallTree
from .storage import drop_table, pick, write_table
from .vectors import matrix, shape, whole_vectors

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
SHARD_ROWS = 4096


def _shards(parts: int, width: int, size: int):
    """One row per shard: ids, labels, vectors and pickled trees."""
    def shard(ids: list, labels: list, vectors: list, label_type: pa.DataType) -> pa.RecordBatch:
        points = matrix(vectors, parts * width)
        trees = [BallTree(np.ascontiguousarray(points[:, p * width: (p + 1) * width])) for p in range(parts)]
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(label_type)),
             pa.array([pickle.dumps(trees, protocol=5)], pa.binary())], ["ids", "labels", "trees"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, kind = [], [], [], None
        for b in batches:
            kind = b.schema.field("label").type
            ids += b.column("vec_id").to_pylist()
            labels += b.column("label").to_pylist()
            v = b.column("v")
            flat, at = v.values.to_numpy(zero_copy_only=False), v.offsets.to_numpy()
            vectors += [flat[x:y].copy() for x, y in zip(at[:-1], at[1:])]
            while len(ids) >= size:
                yield shard(ids[:size], labels[:size], vectors[:size], kind)
                ids, labels, vectors = ids[size:], labels[size:], vectors[size:]
        if ids:
            yield shard(ids, labels, vectors, kind)
    return make


def _totals(codebooks: np.ndarray):
    """Count and sum of the parts of each entry, per position within the part."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, entries, width = codebooks.shape
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros(codebooks.shape, np.int64)
        for b in batches:
            for raw in b["trees"]:
                for p, tree in enumerate(pickle.loads(raw)):
                    def owned(k, n, total):
                        counts[p, k] += n
                        sums[p, k] += total
                    tree.assign(codebooks[p], owned)
        p, k = np.nonzero(counts)
        at = np.tile(np.arange(width), len(p))
        yield pd.DataFrame({"part": np.repeat(p, width), "entry": np.repeat(k, width), "position": at,
                            "n": np.repeat(counts[p, k], width), "total": sums[p, k].reshape(-1)})
    return add


def _codes(codebooks: np.ndarray):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, labels, raw in zip(b.column("ids"), b.column("labels"), b.column("trees")):
                trees = pickle.loads(raw.as_py())
                codes = np.stack([t.assign(codebooks[p]) for p, t in enumerate(trees)], axis=1)
                errors = sum(((t.points - codebooks[p][codes[:, p]]) ** 2).sum(axis=1) for p, t in enumerate(trees))
                text = codes.astype(np.uint8).tobytes().hex()
                step = 2 * codes.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [ids.values, labels.values, pa.array([text[i: i + step] for i in range(0, len(text), step)]),
                     pa.array(errors)], ["vec_id", "label", "code", "error"])
    return encode


def first_vectors(rows: DataFrame, entries: int) -> list:
    """Vectors of the ``entries`` smallest distinct non-null ids, in id order
    (of a repeated id the least vector), each id looked up by a top-k pass."""
    ids: list[int] = []
    while len(ids) < entries:
        beyond = rows.where("vec_id is not null") if not ids else rows.where(F.col("vec_id") > ids[-1])
        more = [r[0] for r in beyond.select("vec_id").orderBy("vec_id").limit(entries - len(ids)).collect()]
        if not more:
            break
        ids += sorted(set(more))
    least = rows.where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("v").alias("v")).collect()
    return [r["v"] for r in sorted(least, key=lambda r: r["vec_id"])]


def compress(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error, label_error), codebooks).

    Components become floor(scale * x); each part position's codebook starts
    as that part of the ``entries`` smallest ids' vectors and is refined
    ``rounds`` times by exact nearest-entry assignment (squared distance, ties
    to the lower index) and floored means; unused entries stay.  ``code`` has
    two hex digits a part, ``error`` is the squared distance to the coded
    vector, ``label_error`` its sum over equal labels (nulls are one label).

    Rows without a vector, or with null or non-finite components, are dropped.
    Vectors are filled up with zeros to the longest one's length, rounded up
    to a multiple of ``parts``.  A null id is coded but starts no entry;
    repeated rows stay repeated, and a repeated id starts one entry.  An empty
    table gives no rows and an empty codebook.  Other columns are not looked
    at.  Components too large for exact 64-bit distances raise.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: at most 256 entries")
    kept = whole_vectors(pick(rows, vec_id=vec_id, label=label, v=vector), scale)
    n, longest, _ = shape(kept)
    width = max(1, -(-longest // parts))
    first = matrix(first_vectors(kept, entries), parts * width)
    codebooks = np.ascontiguousarray(first.reshape(len(first), parts, width).transpose(1, 0, 2))
    kind = kept.schema["label"].dataType.simpleString()
    schema = f"vec_id long, label {kind}, code string, error long"
    if not n:
        return rows.sparkSession.createDataFrame([], f"{schema}, label_error long"), codebooks
    if not len(first):
        raise ValueError("no row has an id to start the codebooks from")
    spread = kept.select(F.col("vec_id").cast("long"), "label", "v").repartition(-(-n // shard_rows))
    shards = write_table(spread.mapInArrow(_shards(parts, width, shard_rows),
                                           f"ids array<bigint>, labels array<{kind}>, trees binary"), "codes-shards")
    for _ in range(rounds):
        sums = (shards.select("trees").mapInPandas(_totals(codebooks), "part int, entry int, position int, n long, "
                                                                       "total long")
                .groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
        codebooks = codebooks.copy()
        for r in sums.collect():  # at most one row per component of the codebooks
            codebooks[r["part"], r["entry"], r["position"]] = r["total"] // r["n"]
    coded = write_table(shards.mapInArrow(_codes(codebooks), schema), "codes")
    drop_table(shards)
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).drop("of"), codebooks


def digest(codebooks: np.ndarray) -> str:
    """sha256 of all components by part, entry and position, ``,``-joined."""
    return hashlib.sha256(",".join(map(str, codebooks.reshape(-1).tolist())).encode()).hexdigest()
