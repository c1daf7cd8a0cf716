"""Suffix-array dedup: bytes of strings of SPAN or more that occur again.

Exact for 64-bit hash pairs, over whole texts as UTF-8 bytes:

1. Anchors.  The window of SPAN bytes at a start contains SPAN - GRAM + 1
   GRAM-byte strings; the one with the least hash (the leftmost of equals) is
   the start's anchor, so equal windows have equal anchors at equal offsets.
   Neighbouring starts with one anchor form a run: one row with the hash of
   the anchor and the hash of all bytes of its windows.
2. Runs that occur twice in full are repeated in full: counted by key, no
   bytes are moved.
3. Of anchors whose runs differ, one run of each kind is looked at further, and
   only if the bytes before or those behind its anchor, as far as half a window's
   rest, are equal in another kind: equal windows agree on one side at least as
   far as that.  These runs are fetched and dealt by anchor to tasks of about
   TASK_BYTES, which sort the suffixes of some anchors at a time (SORT_BYTES) and
   take the longest previous factors, in both directions of the order of places
   from one suffix order: a window repeats where the factor reaches SPAN.
4. Anchors with more than MAX_KINDS different runs would not fit a task; the
   windows of their runs are counted one by one instead, by hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ngrams import BASE, BASE_INV, MASK, MULT, _byte_codes, mix
from .storage import pick, write_table
from .suffix_order import SuffixOrder, reached_both_ways

SPAN = 400
GRAM = 100
#: Starts handled at a time in one text; bounds the memory of a very long one.
PIECE = 1 << 20
POSITION_BITS = np.uint64(21)
MAX_KINDS = 2_000
TASK_BYTES = 1_000_000
#: Bytes of anchors that are sorted together; a single anchor has at most MAX_KINDS * 2 * SPAN.
SORT_BYTES = 1 << 18

_POWERS: dict[tuple[int, int], np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base^0, base^1, ...; kept per worker for the longest piece so far (PIECE + SPAN at most)."""
    have = _POWERS.get((base, 0))
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 16), base & MASK, dtype=np.uint64)
        out[0] = 1
        with np.errstate(over="ignore"):
            have = _POWERS[(base, 0)] = np.multiply.accumulate(out)
    return have[:n]


class Rolling:
    """Hashes of any byte ranges of one piece."""

    def __init__(self, data: np.ndarray):
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_byte_codes()[data] * _powers(BASE, len(data)), dtype=np.uint64, out=self.sums[1:])
        self.inverse = _powers(BASE_INV, len(data) + 1)

    def of_all(self, width: int) -> np.ndarray:
        """Hashes of all ranges of one width."""
        n = len(self.sums) - width
        with np.errstate(over="ignore"):
            return mix((self.sums[width:] - self.sums[:n]) * self.inverse[:n])

    def of(self, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
            return mix(h + np.uint64(salt) * MULT)


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours, from running minima of blocks."""
    m = len(x) - width + 1
    pad = -len(x) % width
    blocks = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    forth = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:m], forth[width - 1: width - 1 + m])


def runs_of(data: np.ndarray, offsets: np.ndarray, span: int, gram: int) -> dict[str, np.ndarray]:
    """Runs of texts that lie one after another in ``data`` (text i from
    offsets[i] to offsets[i + 1]): owner (the text), key (the anchor's hash),
    run (the hash of the run's bytes and of the anchor's offset), left and
    right (the anchor with half a window's rest before and behind it; 0 where
    the run doesn't reach that far, by has_left and has_right), start (within
    the text) and n_starts.  Windows lie within one text."""
    half, n = (span - gram) // 2, len(data)
    if n < span:
        return {}
    roll = Rolling(data)
    position = np.uint64((1 << 21) - 1)
    least = sliding_least((roll.of_all(gram) & ~position) | np.arange(n - gram + 1, dtype=np.uint64), span - gram + 1)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: n - span + 1]
    starts = np.flatnonzero(np.arange(n - span + 1) + span <= offsets[owner + 1])
    if not len(starts):
        return {}
    anchor = (least[starts] & position).astype(np.int64)  # of different texts, different
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    first, last, a = starts[new], starts[np.append(new[1:], len(starts)) - 1], anchor[new]
    with np.errstate(over="ignore"):
        run = roll.of(first, last + span, 1) ^ mix((a - first).astype(np.uint64) * MULT + np.uint64(3))
    out = {"owner": owner[first], "key": roll.of(a, a + gram, 2).view(np.int64), "run": run.view(np.int64),
           "start": first - offsets[owner[first]], "n_starts": (last - first + 1).astype(np.int32)}
    for name, begin, end in (("left", a - half, a + gram), ("right", a, a + gram + half)):
        inside = (begin >= first) & (end <= last + span)
        h = roll.of(np.where(inside, begin, 0), np.where(inside, end, 0), 4)
        out |= {name: np.where(inside, h, np.uint64(0)).view(np.int64), f"has_{name}": inside}
    return out


def _filled(texts: Iterator[tuple], span: int) -> Iterator[tuple[list[tuple], list[bytes], int]]:
    """(rows, their bytes, offset in the text) in portions of about PIECE bytes: many short texts, or a piece of a
    long one, which goes on for span - 1 bytes into the next."""
    rows, parts, size = [], [], 0
    for row, text in texts:
        if len(text) > PIECE:
            for low in range(0, len(text) - span + 1, PIECE):
                yield [row], [text[low: low + PIECE + span - 1]], low
            continue
        rows.append(row)
        parts.append(text)
        size += len(text)
        if size >= PIECE:
            yield rows, parts, 0
            rows, parts, size = [], [], 0
    if rows:
        yield rows, parts, 0


RUN_COLUMNS = ["doc_id", "text_hash", "key", "run", "left", "right", "start", "n_starts"]


def _runs(span: int, gram: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (((i, h), t.as_py()) for b in batches for i, h, t in zip(
            b.column("doc_id").to_pylist(), b.column("text_hash").to_pylist(), b.column("data")))
        for rows, parts, low in _filled(texts, span):
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            r = runs_of(np.frombuffer(b"".join(parts), np.uint8), offsets, span, gram)
            if not r:
                continue
            ids = [pa.array([x[k] for x in rows], pa.int64()).take(pa.array(r["owner"])) for k in (0, 1)]
            sides = [pa.array(r[side], mask=~r[f"has_{side}"]) for side in ("left", "right")]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(r["key"]), pa.array(r["run"]), *sides,
                                              pa.array(r["start"] + low), pa.array(r["n_starts"])], RUN_COLUMNS)
    return make


def _cut(span: int):
    """Bytes of the wanted runs of each text."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["doc_id", "text_hash", "key", "start", "data"]
        for b in batches:
            out, size = [], 0
            for i, t, data, wanted in zip(b["doc_id"], b["text_hash"], b["data"], b["wanted"]):
                for w in wanted:
                    out.append((i, t, w["key"], w["start"], data[w["start"]: w["start"] + w["n_starts"] - 1 + span]))
                    size += len(out[-1][4])
                    if size >= PIECE:
                        yield pd.DataFrame(out, columns=columns)
                        out, size = [], 0
            if out:
                yield pd.DataFrame(out, columns=columns)
    return cut


def _factors(span: int):
    """Step 3 for the runs of one task: starts of each run whose window has an
    earlier or a later equal one among the runs of other kinds."""
    def sort(group: pd.DataFrame) -> list[pd.DataFrame]:
        lengths = group["data"].map(len).to_numpy()
        base = np.cumsum(lengths) - lengths
        order = SuffixOrder(np.frombuffer(b"".join(group["data"]), np.uint8), span, levels=False)
        counts = lengths - span + 1
        owner = np.repeat(np.arange(len(group)), counts)
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        # Places in the order of documents; the key sorts first, but equal windows have equal keys.
        earlier, later = reached_both_ways(order, base[owner] + inside)
        out = []
        for name, flag in (("earlier", earlier), ("later", later)):
            edge = np.flatnonzero(flag & np.concatenate([[True], ~flag[:-1] | (owner[1:] != owner[:-1])]))
            stop = np.flatnonzero(flag & np.concatenate([~flag[1:] | (owner[1:] != owner[:-1]), [True]]))
            k = owner[edge]
            out.append(pd.DataFrame({"doc_id": group["doc_id"].iloc[k].to_numpy(),
                                     "text_hash": group["text_hash"].iloc[k].to_numpy(),
                                     "begin": group["start"].iloc[k].to_numpy() + inside[edge],
                                     "end": group["start"].iloc[k].to_numpy() + inside[stop] + span,
                                     "later": name == "later"}))
        return out

    def find(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["key", "doc_id", "text_hash", "start"], kind="stable").reset_index(drop=True)
        before = np.concatenate([[0], np.cumsum(group["data"].map(len).to_numpy())])
        keys = group["key"].to_numpy()
        edges = np.append(np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])), len(keys))
        out, low = [], 0
        for k, high in zip(edges, edges[1:]):
            if k > low and before[high] - before[low] > SORT_BYTES:
                out += sort(group.iloc[low:k])
                low = k
        return pd.concat(out + sort(group.iloc[low:]))
    return find


def _windows(span: int):
    """Step 4: two independent hashes of each window of the fetched runs."""
    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, t, start, raw in zip(b["doc_id"], b["text_hash"], b["start"], b["data"]):
                data = np.frombuffer(raw, np.uint8)
                at = np.arange(len(data) - span + 1)
                digests = [hashlib.blake2b(raw[k: k + span], digest_size=16).digest() for k in at]
                pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pd.DataFrame({"doc_id": i, "text_hash": t, "start": at + start,
                                    "w1": pair[:, 0], "w2": pair[:, 1]})
    return windows


def repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", span: int = SPAN, gram: int = GRAM,
                   keep_first: bool = False, max_kinds: int = MAX_KINDS) -> DataFrame:
    """(doc_id, text_hash, begin, end): byte ranges, possibly overlapping, that
    are covered by a string of ``span`` bytes that also starts elsewhere.

    With ``keep_first`` a string's first start, by doc_id, text hash and
    offset, is left.  Matches don't cross documents.  Null and short texts
    have no spans; equal rows repeat each other and get the same ranges
    (with ``keep_first`` as well, since nothing tells them apart).
    """
    rows = pick(docs, doc_id=doc_id, text=text)
    full = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("data"))
    long_ = full.where(F.length("data") >= span)
    runs = write_table(long_.mapInArrow(_runs(span, gram), "doc_id long, text_hash long, key long, run long, "
                                                            "left long, right long, start long, n_starts int"),
                       "repeat-runs")
    many = runs.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    shared = write_table(runs.join(many, "key"), "repeat-shared")
    place = F.struct("doc_id", "text_hash", "start", "n_starts")
    kinds = write_table(shared.groupBy("key", "run").agg(
        F.count("*").alias("n"), F.min(place).alias("first"), F.min("left").alias("left"),
        F.min("right").alias("right")), "repeat-kinds")
    whole = (shared.join(kinds.where("n > 1").select("key", "run", "first"), ["key", "run"])
             .select("doc_id", "text_hash", F.col("start").alias("begin"),
                     (F.col("start") + F.col("n_starts") - 1 + span).alias("end"),
                     (place == F.col("first")).alias("is_first")))
    found = whole.where(~F.col("is_first") if keep_first else F.lit(True)).drop("is_first")

    sides = [kinds.where(F.col(side).isNotNull()).groupBy("key", side).agg(F.count("*").alias("m")).where("m > 1")
             for side in ("left", "right")]
    alike = [kinds.select("key", "run", "first", side).join(pairs, ["key", side], "left_semi").drop(side)
             for side, pairs in zip(("left", "right"), sides)]
    kinds = write_table(alike[0].unionByName(alike[1]).dropDuplicates(["key", "run"]), "repeat-alike")
    mixed = (kinds.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1")
             .withColumn("hot", F.col("kinds") > max_kinds).select("key", "hot"))
    wanted = write_table(kinds.join(mixed, "key").select(
        "first.doc_id", "first.text_hash", F.struct("key", "first.start", "first.n_starts").alias("run"), "hot"),
        "repeat-wanted")
    size = wanted.agg(F.sum(F.col("run.n_starts") + span)).first()[0] or 0
    if not size:
        return found
    by_doc = wanted.groupBy(F.col("doc_id").alias("i"), F.col("text_hash").alias("t")).agg(
        F.collect_list("run").alias("wanted"))
    here = long_["doc_id"].eqNullSafe(by_doc["i"]) & (long_["text_hash"] == by_doc["t"])
    # Equal rows are one place: the first is enough.
    pieces = (long_.join(by_doc, here).select("doc_id", "text_hash", "data", "wanted")
              .mapInPandas(_cut(span), "doc_id long, text_hash long, key long, start long, data binary"))
    pieces = write_table(pieces.join(mixed, "key"), "repeat-pieces")
    pieces = pieces.dropDuplicates(["doc_id", "text_hash", "start"])
    tasks = max(1, int(size // TASK_BYTES) + 1)
    near = (pieces.where("not hot").groupBy(F.pmod(F.xxhash64("key"), F.lit(tasks)).alias("task"))
            .applyInPandas(_factors(span), "doc_id long, text_hash long, begin long, end long, later boolean"))
    found = found.unionByName(near.where("not later" if keep_first else "true").drop("later"))
    if pieces.where("hot").isEmpty():
        return found
    each = write_table(pieces.where("hot").mapInPandas(
        _windows(span), "doc_id long, text_hash long, start long, w1 long, w2 long"), "repeat-windows")
    spot = F.struct("doc_id", "text_hash", "start")
    again = each.groupBy("w1", "w2").agg(F.count("*").alias("n"), F.min(spot).alias("first")).where("n > 1")
    hot = each.join(again, ["w1", "w2"]).where(spot != F.col("first") if keep_first else F.lit(True))
    return found.unionByName(hot.select("doc_id", "text_hash", F.col("start").alias("begin"),
                                        (F.col("start") + span).alias("end")))


def merge(ranges: list) -> list[tuple[int, int]]:
    """Maximal ranges of a union of ranges."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(ranges):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document: doc_id, kept (the remaining bytes of the text, in
    order), n_bytes, n_removed and n_spans (maximal removed ranges).  A null
    text counts as empty.  Options are those of ``repeated_spans``."""
    spans = repeated_spans(docs, text, doc_id, **options)
    by_doc = spans.groupBy(F.col("doc_id").alias("i"), F.col("text_hash").alias("t")).agg(
        F.collect_set(F.struct("begin", "end")).alias("ranges"))
    full = pick(docs, doc_id=doc_id, text=text).select(
        "doc_id", F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("data"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, data, ranges in zip(b["doc_id"], b["data"], b["ranges"]):
                gone = merge([(r["begin"], r["end"]) for r in ranges]) if ranges is not None else []
                edges = [0, *(x for r in gone for x in r), len(data)]
                out.append((i, b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2])), len(data),
                            sum(y - x for x, y in gone), len(gone)))
            yield pd.DataFrame(out, columns=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    here = full["doc_id"].eqNullSafe(by_doc["i"]) & (full["text_hash"] == by_doc["t"])
    return full.join(by_doc, here, "left").select("doc_id", "data", "ranges").mapInPandas(
        cut, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
