"""Mixing sources to target weights by the cube method.

Each source's target is its weight's share of all words, at most MAX_REPEATS
times what the source has; the excess goes to the others by weight.  A document
is taken floor(r) or floor(r) + 1 times, r = target / size of its source.  The
fractional parts are inclusion probabilities, which the cube method moves to 0
or 1 along directions in the null space of two balancing constraints, the words
and the documents of the source: both totals stay what the probabilities say,
until at most two undecided documents are left in a block.

Blocks of about BLOCK documents of one source are dealt by a hash of the
document, so a source with a third of all rows is many tasks.  The undecided
ones of all blocks of a source form new blocks, level after level, until one
block per source is left; its last two documents are the landing problem.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import pick, write_table

WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEATS = 3
BLOCK = 20_000
#: Documents of a block, the largest ones, that are decided against all others.
HEADS = 512
#: The driver holds one row per source while it sets targets.
MAX_SOURCES = 1_000_000
EPSILON = 1e-9


def n_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 for null."""
    # The null goes first: the size of a null array is null or -1, by the session's settings.
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, most: int = MAX_REPEATS) -> dict:
    """{source: target words}; sources by code point, null last, weigh ``weights`` in turn."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size = dict(order)
    rest, out = set(size), {}
    left = float(sum(size.values()))
    while rest:
        total = sum(weight[s] for s in size if s in rest)
        full = [s for s in size if s in rest and left * weight[s] / total > most * size[s]]
        if not full:
            out |= {s: left * weight[s] / total for s in size if s in rest}
            break
        for s in full:
            out[s] = float(most * size[s])
            rest.discard(s)
        left = max(0.0, left - sum(most * size[s] for s in full))
    return out


def direction(a: tuple[float, float, float]) -> tuple[float, float, float]:
    """A vector orthogonal to (1, 1, 1) and to a."""
    u = (a[1] - a[2], a[2] - a[0], a[0] - a[1])
    return u if any(u) else (1.0, -1.0, 0.0)


def decide_large(p: np.ndarray, size: np.ndarray, draws: np.ndarray, heads: int) -> np.ndarray:
    """Decide the ``heads`` largest documents, each balanced by small moves of
    all undecided ones: the step is the part of its unit vector that lies in
    the null space of both constraints."""
    p = p.copy()
    for step, i in enumerate(np.argsort(-size, kind="stable")[:heads]):
        while EPSILON < p[i] < 1 - EPSILON:
            at = np.flatnonzero((p > EPSILON) & (p < 1 - EPSILON))
            if len(at) < 3:
                return p
            x = size[at] - size[at].mean()
            spread = float(x @ x)
            mine = int(np.searchsorted(at, i))
            u = -1 / len(at) - (x * x[mine] / spread if spread > 0 else 0 * x)
            u[mine] += 1
            if u[mine] < 1e-6:  # nothing else can balance it
                break
            u[np.abs(u) < 1e-15] = 0
            with np.errstate(divide="ignore"):
                up = np.where(u > 0, (1 - p[at]) / u, np.where(u < 0, p[at] / -u, np.inf)).min()
                down = np.where(u > 0, p[at] / u, np.where(u < 0, (1 - p[at]) / -u, np.inf)).min()
            move = up if draws[step % len(draws)] * (up + down) < down else -down
            p[at] = np.clip(p[at] + move * u, 0.0, 1.0)
    near = (p <= EPSILON) | (p >= 1 - EPSILON)
    p[near] = np.round(p[near])
    return p


def flight(p: list[float], size: list[float], draws: np.ndarray, heads: int = HEADS) -> list[float]:
    """Move inclusion probabilities so that sum(p) and sum(p * size) stay,
    until up to two documents remain undecided: the largest first, then three
    at a time in order of size, so that what remains is small."""
    p = decide_large(np.array(p, dtype=float), np.array(size, dtype=float), draws, heads).tolist()
    waiting = sorted((i for i in range(len(p)) if EPSILON < p[i] < 1 - EPSILON), key=lambda i: (size[i], i))
    active: list[int] = []
    step = 0
    while True:
        while len(active) < 3 and waiting:
            active.append(waiting.pop())
        if len(active) < 3:
            return p
        u = direction(tuple(size[i] for i in active))
        up = min((1 - p[i]) / v if v > 0 else p[i] / -v for i, v in zip(active, u) if v)
        down = min(p[i] / v if v > 0 else (1 - p[i]) / -v for i, v in zip(active, u) if v)
        move = up if draws[step % len(draws)] * (up + down) < down else -down
        step += 1
        for i, v in zip(active, u):
            p[i] = min(1.0, max(0.0, p[i] + move * v))
        decided = [i for i in active if not EPSILON < p[i] < 1 - EPSILON]
        for i in decided:
            p[i] = float(p[i] > 0.5)
        active = [i for i in active if i not in decided]


def land(p: list[float], size: list[float]) -> list[float]:
    """Decide the last documents: the outcome with the words nearest to what
    the probabilities say, then the nearest count."""
    open_ = [i for i in range(len(p)) if EPSILON < p[i] < 1 - EPSILON]
    words, count = sum(p[i] * size[i] for i in open_), sum(p[i] for i in open_)
    best = min(range(1 << len(open_)), key=lambda m: (
        abs(sum(size[i] for k, i in enumerate(open_) if m >> k & 1) - words), abs(m.bit_count() - count), m))
    out = list(p)
    for k, i in enumerate(open_):
        out[i] = float(best >> k & 1)
    return out


def _cube(last: bool):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["order", "doc_id", "text_hash", "size"], kind="stable")
        size = [float(x) for x in group["size"]]
        seed = int(np.abs(group["order"].to_numpy(dtype=np.int64)[0] % (1 << 62)))
        draws = np.random.default_rng(seed).random(max(1, len(size)))
        p = flight([float(x) for x in group["p"]], size, draws)
        return group.assign(p=land(p, size) if last else p)
    return run


def mix_sources(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
                weights=WEIGHTS, max_repeats: int = MAX_REPEATS, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, text_hash (xxhash64 of the text), source,
    size (words), source_size, target (words of the source), copies (how
    often the mix takes it) and taken (size x copies).

    A null source is a source of its own, last in order.  Null and blank
    texts have size 0 and are never taken.  Equal rows stay apart and may be
    taken differently.  Reruns agree: blocks, order and draws follow hashes of
    the rows alone.  An empty table gives no rows.
    """
    rows = (pick(docs, doc_id=doc_id, source=source, text=text)
            .select("doc_id", "source", F.xxhash64("text").alias("text_hash"), n_words(F.col("text")).alias("size")))
    rows = write_table(rows.withColumn("order", F.xxhash64("doc_id", "text_hash", "source", F.lit(11))), "mix-sizes")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    found = sums.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    aims = targets([(r["source"], r["source_size"]) for r in found], weights, max_repeats)
    plan = docs.sparkSession.createDataFrame(
        [(r["source"], r["source_size"], float(aims[r["source"]]), max(1, math.ceil(r["n"] / block))) for r in found],
        "source string, source_size long, target double, blocks int")
    # Sources are known to be at most MAX_SOURCES rows here; Spark's own size rule decides on a broadcast.
    same = rows["source"].eqNullSafe(plan["source"])
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(F.col("ratio") + EPSILON)
    units = (rows.join(plan, same).drop(plan["source"]).withColumn("ratio", ratio)
             .withColumn("base", F.when(F.col("size") > 0, whole).otherwise(0).cast("int"))
             .withColumn("p", F.when(F.col("size") > 0, F.greatest(F.col("ratio") - whole, F.lit(0.0))).otherwise(0.0))
             .withColumn("block", F.pmod(F.col("order"), F.col("blocks")).cast("int"))
             .drop("ratio"))
    open_ = (F.col("p") > EPSILON) & (F.col("p") < 1 - EPSILON)
    done = [units.where(~open_)]
    level, waves = units.where(open_), max([math.ceil(r["n"] / block) for r in found], default=1)
    while True:
        last = waves <= 1
        moved = write_table(level.groupBy("source", "block").applyInPandas(_cube(last), level.schema), "mix-level")
        done.append(moved.where(~open_))
        if last:
            break
        # Two documents a block remain at most.
        waves = math.ceil(2 * waves / block)
        level = moved.where(open_).withColumn("blocks", F.ceil(2 * F.col("blocks") / block).cast("int")).withColumn(
            "block", F.pmod(F.xxhash64("order"), F.col("blocks")).cast("int"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    copies = (F.col("base") + F.round("p")).cast("long")
    return out.select("doc_id", "text_hash", "source", "size", "source_size", "target", copies.alias("copies"),
                      (F.col("size") * copies).alias("taken"))
