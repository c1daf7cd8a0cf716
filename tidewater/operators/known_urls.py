"""J1 at scale: which entries are stored already, without moving the history.

Beside the stored URLs lies a Bloom filter, one bit array per bucket of URL
hashes; filters of separate appends are merged by OR.  An entry that the filter
doesn't know is new, for certain.  Only the rest, the known ones and about one
per cent of the new, is looked up exactly, and the look-up sends those few URLs
to the history's files, not the history to them.

URLs and filter are one commit (``sinks.commits``): a filter that lacks stored
URLs would pass known entries off as new.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from ..sinks import commits

URLS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("url", T.StringType())])
FILTER = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("buckets", T.IntegerType()),
                       T.StructField("bits", T.BinaryType())])
#: Bits per stored URL for about one false positive in a hundred, and bits set for each.
BITS_PER_URL, HASHES = 10, 7
#: A bucket's bits: 8 million, one megabyte.
BUCKET_BITS = 1 << 23
#: Look-ups of up to this many URLs (of at most LOOKUP_BYTES) are sent to every task that reads the history.
LOOKUP_URLS, LOOKUP_BYTES = 200_000, 32 << 20


def _places(h1: np.ndarray, h2: np.ndarray, bits: int) -> np.ndarray:
    """HASHES bit numbers per URL from two hashes of it."""
    with np.errstate(over="ignore"):
        k = np.arange(HASHES, dtype=np.uint64)[:, None]
        return ((h1.view(np.uint64) + k * (h2.view(np.uint64) | np.uint64(1))) >> np.uint64(16)) % np.uint64(bits)


def _hashed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumns({"h1": F.xxhash64("url"), "h2": F.xxhash64("url", F.lit(1)),
                           "bucket": F.pmod(F.xxhash64(F.lit(2), "url"), F.lit(buckets)).cast("int")})


def _partial(bits: int):
    """Bits of each bucket that occur in one task."""
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, np.ndarray] = {}
        for b in batches:
            places = _places(b["h1"].to_numpy(), b["h2"].to_numpy(), bits)
            for bucket in b["bucket"].unique():
                field = found.setdefault(int(bucket), np.zeros(bits, bool))
                field[places[:, b["bucket"].to_numpy() == bucket].reshape(-1)] = True
        for bucket, field in found.items():
            yield pd.DataFrame({"bucket": [bucket], "bits": [np.packbits(field).tobytes()]})
    return build


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    out = np.frombuffer(group["bits"].iloc[0], np.uint8).copy()
    for more in group["bits"].iloc[1:]:
        out |= np.frombuffer(more, np.uint8)
    return pd.DataFrame({"bucket": [group["bucket"].iloc[0]], "bits": [out.tobytes()]})


def add_urls(spark: SparkSession, root: str, run_id: str, new: DataFrame, buckets: int | None = None,
             bits: int = BUCKET_BITS) -> int:
    """Store the canonical URLs of ``new`` (``url``) and merge them into the
    filter, as one commit.  ``buckets`` is fixed by the first one; by default
    there is room in the filter for four times the first URLs."""
    old = commits.read(spark, root, "url_filter", FILTER)
    first = old.first()
    urls = new.where("url is not null").select("url").distinct()
    if first is None:
        buckets = buckets or max(1, -(-urls.count() * 4 * BITS_PER_URL // bits))
    else:
        buckets, bits = first["buckets"], len(first["bits"]) * 8
    hashed = _hashed(urls, buckets)
    parts = hashed.repartition(buckets, "bucket").select("bucket", "h1", "h2").mapInPandas(
        _partial(bits), "bucket int, bits binary")
    merged = (parts.unionByName(old.select("bucket", "bits")).groupBy("bucket")
              .applyInPandas(_merged, "bucket int, bits binary").withColumn("buckets", F.lit(buckets)))
    rows = hashed.select("bucket", "url").sortWithinPartitions("bucket")
    return commits.commit(spark, root, run_id, {"urls": rows}, {"url_filter": merged},
                          {"urls": URLS, "url_filter": FILTER})


def _probe(entries: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if not len(filters):
        return entries[["url"]].assign(maybe=False)
    field = np.frombuffer(filters["bits"].iloc[0], np.uint8)
    places = _places(entries["h1"].to_numpy(), entries["h2"].to_numpy(), len(field) * 8)
    hit = (field[places >> np.uint64(3)] >> (7 - (places & np.uint64(7))).astype(np.uint8)) & 1
    return entries[["url"]].assign(maybe=hit.all(axis=0))


def known_among(spark: SparkSession, root: str, entries: DataFrame, url_col: str = "url") -> tuple[DataFrame, dict]:
    """(the stored URLs among those of ``entries``, column ``url``; counts:
    distinct URLs, passed on by the filter, stored)."""
    filters = commits.read(spark, root, "url_filter", FILTER)
    first = filters.first()
    asked = entries.select(F.col(url_col).alias("url")).where("url is not null").distinct()
    if first is None:
        return asked.limit(0), {"urls": asked.count(), "passed": 0, "stored": 0}
    probed = materialize(_hashed(asked, first["buckets"]).groupBy("bucket").cogroup(filters.groupBy("bucket"))
                         .applyInPandas(_probe, "url string, maybe boolean"), "known_probed")
    n, passed, size = probed.agg(F.count("*"), F.count_if("maybe"), F.sum(F.when(F.col("maybe"), F.length("url")))).first()
    lookups = probed.where("maybe").select("url")
    if passed <= LOOKUP_URLS and (size or 0) <= LOOKUP_BYTES:
        lookups = F.broadcast(lookups)
    stored = commits.read(spark, root, "urls", URLS).select("url")
    known = materialize(stored.join(lookups, "url", "left_semi").distinct(), "known_urls")
    return known, {"urls": n, "passed": passed, "stored": known.count()}


def new_entries(spark: SparkSession, root: str, entries: DataFrame, url_col: str = "url") -> DataFrame:
    """Entries whose URL is not stored (a null URL isn't)."""
    known, _ = known_among(spark, root, entries, url_col)
    return entries.join(known.select(F.col("url").alias("_known")), F.col(url_col) == F.col("_known"), "left_anti")
