"""SimHash near-dedup: documents whose 64-bit fingerprints differ in few bits.

1. Fingerprints, in one pass over the texts; equal ones are one node, so a
   group of exact copies is one row from here on.
2. Pigeonhole blocks.  The 64 bits are cut into max_bits + 2 blocks; two close
   fingerprints agree in at least two of them, so each fingerprint goes into
   one bucket for every choice of two blocks (32 bits of 64 at 2 bits).
3. A bucket of more than the members that step 4 takes (a group of near copies
   may be a third of all fingerprints) is cut again, by the pigeonhole principle
   on its remaining bits: 4 * max_bits blocks, all but max_bits of them equal.
   So few bits are left that a bucket can't hold more than the bound.
4. Inside a bucket, all Hamming distances are checked; it yields at most one
   link per member, to the least fingerprint that its links reach.
5. Connected components of the links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .storage import drop_table, pick, write_table

N_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Bytes of text split into words at a time; bounds the memory of a very long one.
PIECE = 1 << 20
#: Rows that one task of step 4 takes, and fingerprint pairs it compares at a time.
TASK_ROWS = 500_000
PAIRS = 1 << 21

SPACE = re.compile(rb"[\x20\x09-\x0d]")


def word_pieces(raw: bytes, n: int, piece: int = PIECE) -> Iterator[list[bytes]]:
    """Lists of lower-cased (A-Z) words that together hold every n-word window
    once; one list of all words when there are fewer than n, none without."""
    low, carry, some = 0, [], False
    while low < len(raw):
        cut = SPACE.search(raw, low + piece)
        high = cut.start() if cut else len(raw)
        words = carry + raw[low:high].lower().split()
        low = high
        if len(words) >= n:
            some = True
            yield words
            carry = words[len(words) - n + 1:]
        else:
            carry = words
    if carry and not some:
        yield carry


def fingerprint(text: str | None, n: int = N_WORDS) -> int:
    """SimHash of the n-word shingles (repeats count): a bit is 1 if it is set
    in over half of their XXH64 hashes; 0 without words."""
    ones, total = np.zeros(64, np.int64), 0
    for words in word_pieces(text.encode("utf-8", "replace") if text else b"", n):
        k = min(n, len(words))
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(),
                                                                   ends[k - 1:].tolist())), np.uint64)
        for part in np.array_split(h, len(h) // 65_536 + 1):
            ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                                  bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(h)
    return sum(1 << int(b) for b in np.flatnonzero(2 * ones > total))


def _fingerprints(n: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([fingerprint(t.as_py(), n) for t in b.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])
    return make


def free_masks(bits: list[int], blocks: int, free: int) -> list[int]:
    """The given bits cut into ``blocks`` blocks: for every choice of ``free``
    blocks, the 64-bit mask of all bits but theirs."""
    cut = [bits[len(bits) * i // blocks: len(bits) * (i + 1) // blocks] for i in range(blocks)]
    every = (1 << 64) - 1
    return [every ^ sum(1 << b for block in choice for b in block) for choice in combinations(cut, free)]


def plan(max_bits: int) -> tuple[list[int], list[list[int]], int]:
    """(masks of step 2, the masks of step 3 for each of them, most members of
    a bucket of step 3)."""
    coarse = free_masks(list(range(64)), max_bits + 2, max_bits)
    fine = [free_masks([b for b in range(64) if not mask >> b & 1], 4 * max_bits, max_bits) for mask in coarse]
    return coarse, fine, max(1 << 64 - m.bit_count() for masks in fine for m in masks)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def stars(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For buckets of equal size (rows of ``fps``): (fingerprint, least one its
    links within the bucket reach) of all that have a smaller one."""
    near = np.bitwise_count(fps[:, :, None] ^ fps[:, None, :]) <= max_bits
    label = np.broadcast_to(np.arange(fps.shape[1]), fps.shape)
    while True:
        least = np.where(near, label[:, None, :], fps.shape[1]).min(axis=2)
        if np.array_equal(least, label):
            break
        label = least
    moved = label != np.arange(fps.shape[1])
    return fps[moved], np.take_along_axis(fps, label, axis=1)[moved]


def _verify(max_bits: int):
    """Step 4 for the buckets dealt to one task."""
    def verify(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["mask", "key", "fp"])
        fps = group["fp"].to_numpy().view(np.uint64)
        new = np.flatnonzero((np.diff(group["mask"].to_numpy(), prepend=0) != 0)
                             | (np.diff(group["key"].to_numpy(), prepend=0) != 0) | (np.arange(len(group)) == 0))
        sizes = np.diff(np.append(new, len(group)))
        found = []
        for n in np.unique(sizes[sizes > 1]):
            at = new[sizes == n]
            for some in np.array_split(at, len(at) * n * n // PAIRS + 1):
                found.append(stars(fps[some[:, None] + np.arange(n)], max_bits))
        a, b = (np.concatenate(x) if found else np.zeros(0, np.uint64) for x in (zip(*found) if found else ((), ())))
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)}).drop_duplicates()
    return verify


def close_pairs(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) of a table of distinct fingerprints (``fp`` long) that have
    the same connected components as all pairs of up to ``max_bits`` differing
    bits (one or more)."""
    coarse, fine, most = plan(max_bits)
    masks = F.array(*[F.lit(_signed(m)) for m in coarse])
    spread = (fps.select("fp", F.posexplode(masks).alias("choice", "mask"))
              .withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))))
    sizes = spread.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = write_table(spread.join(sizes, ["choice", "key"]).select("choice", "mask", "key", "fp", "n"),
                         "simhash-shared")
    finer = F.array(*[F.array(*[F.lit(_signed(m)) for m in masks]) for masks in fine])
    hot = (shared.where(F.col("n") > most).select("fp", F.explode(F.get(finer, F.col("choice"))).alias("mask"))
           .withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))))
    # Two choices can give the same mask and key; their buckets are then one.
    dealt = shared.where(F.col("n") <= most).select("mask", "key", "fp").unionByName(
        hot.select("mask", "key", "fp").distinct())
    tasks = max(16, (shared.count() * len(fine[0]) if not hot.isEmpty() else shared.count()) // TASK_ROWS + 1)
    links = write_table(dealt.groupBy(F.pmod(F.xxhash64("mask", "key"), F.lit(tasks)).alias("task"))
                        .applyInPandas(_verify(max_bits), "a long, b long"), "simhash-links")
    drop_table(shared)
    return links


def simhash_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n_words: int = N_WORDS,
                   max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fp (the fingerprint's 64 bits as long) and
    component_id (smallest non-null doc_id reachable by links, the own one
    included; null if none has an id).

    Fewer than ``n_words`` words are one shingle.  Null, blank and wordless
    texts have fingerprint 0 and link like any other.  Very long texts are read
    whole, a piece at a time.  Repeated rows stay repeated, ties don't arise.
    An empty table gives no rows; other columns are not looked at.
    """
    table = write_table(pick(docs, doc_id=doc_id, text=text).mapInArrow(
        _fingerprints(n_words), "doc_id long, fp long"), "simhash-docs")
    fps = table.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    groups = connected_components(close_pairs(fps.select("fp"), max_bits), "simhash").select(
        F.col("id").alias("fp"), "component")
    named = fps.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_fp = named.select("fp", "component").join(smallest, "component").select("fp", "component_id")
    return table.join(of_fp, "fp").select("doc_id", "fp", "component_id")
