"""N-gram Jaccard join: groups of documents linked by similar shingle sets.

Exact for 64-bit shingle hashes, at any group size:

1. Sets.  Documents with equal sets form one class (a 128-bit hash).
2. Filter.  A linked document shares at least ``percent`` of its own shingles
   with others.  Shingles with hashes below SHARE of the hash space (all of
   them for small sets) are dealt by hash, as packed columns, and each class's
   shared ones are counted; a class that misses more of them than a link
   allows has no link.  This is a bound, not an estimate: no link is lost.
   Shingles of very many sets are known to be shared from step 1's batches;
   their pairs are dealt by class, so no task holds all owners of one.
3. Global order.  For the classes that remain, each shingle's number of
   classes orders the shingles; two linked sets share one of the rarest
   size - needed + 1 of each, so classes with such a shingle in common are
   joined to candidate groups (stars around the smallest class, then
   connected components): no pairs are emitted.
4. Prefix-tree join (prefix_tree.py) inside each candidate group.  Groups over
   BLOCK_ITEMS shingles are split into blocks: first within blocks, then
   between one set of each class found, and, if sets are still apart, for
   every pair of blocks, looking only at pairs not yet connected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .ngrams import shingle_hashes, words_of
from .prefix_tree import link_block
from .storage import pick, write_table

N_WORDS = 5
PERCENT = 75
#: Share of the hash space that step 2 looks at, and the set size up to which it looks at all.
SHARE = 0.4
SMALL = 128
#: Shingles that one task sorts at a time in steps 2 and 3, and a block's in step 4.
BUCKET_ITEMS = 2_000_000
BLOCK_ITEMS = 1_000_000
#: A shingle of at least this share of a batch's texts (and this many) may be hot; most hot shingles that are kept in mind.
HOT_SHARE = 0.001
HOT_LEAST = 8
HOT_ITEMS = 100_000
LIMIT = np.uint64(int(SHARE * 2**64))


def shingle_set(text: str | None, n: int = N_WORDS) -> np.ndarray:
    return np.unique(shingle_hashes(words_of(text), n))


def class_of(items: np.ndarray) -> bytes:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def needed(size: int, percent: int) -> int:
    """Least overlap that any link of a set of this size has."""
    return -(-size * percent // 100)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return pick(docs, doc_id=doc_id, text=text).withColumn("text_hash", F.xxhash64("text"))


def _set_table(keyed: DataFrame, n: int) -> DataFrame:
    """One row per document; the first of each batch also has the shingles that
    many of the batch's classes hold (``often``, with their counts)."""
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [shingle_set(t, n) for t in b["text"]]
            names = [class_of(x) if len(x) else None for x in found]
            items, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *{
                c: x for c, x in zip(names, found) if c}.values()]), return_counts=True)
            often = counts >= max(HOT_LEAST, HOT_SHARE * len(found))
            many = [{"item": int(i), "n": int(k)} for i, k in zip(items[often].view(np.int64), counts[often])]
            yield pd.DataFrame({
                "doc_id": b["doc_id"], "text_hash": b["text_hash"], "size": [len(x) for x in found],
                "low": [int((x < LIMIT).sum()) for x in found], "class": names,
                "often": [many, *[None] * (len(found) - 1)][:len(found)]})

    return keyed.mapInPandas(make, "doc_id long, text_hash long, size long, low long, class binary, "
                                   "often array<struct<item: bigint, n: bigint>>")


def hot_items(table: DataFrame) -> np.ndarray:
    """Shingles of very many classes, sorted; at most HOT_ITEMS of them.  All
    are held by several classes, so they needn't be counted again, and the
    pairs that hold them are dealt by class; which ones are in the list only
    decides where work is done."""
    top = (table.where("often is not null").select(F.explode("often").alias("o")).groupBy("o.item")
           .agg(F.sum("o.n").alias("n")).orderBy(F.desc("n"), "item").limit(HOT_ITEMS).select("item").collect())
    return np.sort(np.array([r["item"] for r in top], np.int64).view(np.uint64))


def _among(items: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(items), bool)
    return hot[np.minimum(np.searchsorted(hot, items), len(hot) - 1)] == items


def _packed(keyed: DataFrame, n: int, buckets: int, all_items: bool, hot: np.ndarray) -> DataFrame:
    """Rows (bucket, items, classes, lengths): the shingles of many sets that
    fall into one bucket, set after set, a set once per task.  Hot shingles are
    dealt by class, to buckets from ``buckets`` on."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[bytes] = set()
        for b in batches:
            sets, classes = [], []
            for t in b["text"]:
                x = shingle_set(t, n)
                c = class_of(x)
                if len(x) and c not in seen:
                    seen.add(c)
                    sets.append(x if all_items or len(x) < SMALL else x[x < LIMIT])
                    classes.append(c)
            if not sets:
                continue
            items = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            names = np.frombuffer(b"".join(classes), "V16")
            own = np.frombuffer(b"".join(classes), "<u4").reshape(-1, 4)[:, 0] % buckets + buckets
            bucket = np.where(_among(items, hot), own[owner],
                              (items & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(2 * buckets + 1))
            for k in np.flatnonzero(np.diff(cuts)):
                part = order[cuts[k]: cuts[k + 1]]
                own, lengths = np.unique(owner[part], return_counts=True)
                yield pd.DataFrame({"bucket": [int(k)], "items": [items[part].tobytes()],
                                    "classes": [names[own].tobytes()],
                                    "lengths": [lengths.astype(np.uint32).tobytes()]})

    return keyed.mapInPandas(pack, "bucket int, items binary, classes binary, lengths binary")


def _shared(group: pd.DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(items, class numbers, number of classes per item, class names) of the
    distinct (item, class) pairs whose item several classes have; hot items
    come last in any order by number."""
    items = np.frombuffer(b"".join(group["items"]), np.uint64)
    lengths = np.frombuffer(b"".join(group["lengths"]), np.uint32)
    names, number = np.unique(np.frombuffer(b"".join(group["classes"]), ">u8").reshape(-1, 2), axis=0,
                              return_inverse=True)
    owner = np.repeat(number.reshape(-1).astype(np.uint32), lengths)
    order = np.lexsort((owner, items))
    items, owner = items[order], owner[order]
    new = np.ones(len(items), bool)
    new[1:] = (items[1:] != items[:-1]) | (owner[1:] != owner[:-1])
    items, owner = items[new], owner[new]
    if group["bucket"].iloc[0] >= buckets:
        return items, owner, np.full(len(items), 1 << 40), names
    start = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]]))
    counts = np.diff(np.append(start, len(items)))
    df = np.repeat(counts, counts)
    many = df > 1
    return items[many], owner[many], df[many].astype(np.int64), names


def _count_shared(buckets: int):
    def count(group: pd.DataFrame) -> pd.DataFrame:
        items, owner, _, names = _shared(group, buckets)
        every = np.bincount(owner, minlength=len(names))
        low = np.bincount(owner[items < LIMIT], minlength=len(names))
        used = np.flatnonzero(every)
        return pd.DataFrame({"class": [names[i].tobytes() for i in used], "every": every[used], "low": low[used]})
    return count


def _return_shared(buckets: int):
    def give(group: pd.DataFrame) -> pd.DataFrame:
        items, owner, df, names = _shared(group, buckets)
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(len(names) + 1)) * 8
        items, df = items[order].tobytes(), df[order].tobytes()
        used = np.flatnonzero(np.diff(cuts))
        return pd.DataFrame({"class": [names[i].tobytes() for i in used],
                             "items": [items[cuts[i]: cuts[i + 1]] for i in used],
                             "df": [df[cuts[i]: cuts[i + 1]] for i in used]})
    return give


def _ordered(percent: int):
    """One row per class: its shared shingles, rarest first, and how many of
    them are among its rarest size - needed + 1 ones."""
    def order(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for c, part in group.groupby("class", sort=True):
            items = np.frombuffer(b"".join(part["items"]), np.uint64)
            df = np.frombuffer(b"".join(part["df"]), np.int64)
            place = np.lexsort((items, df))
            size = int(part["size"].iloc[0])
            prefix = size - needed(size, percent) + 1 - (size - len(items))  # others have no partner
            if prefix > 0:
                out.append((c, size, len(items), prefix, items[place].tobytes()))
        return pd.DataFrame(out, columns=["class", "size", "n_items", "prefix", "items"])
    return order


def _prefix_items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for c, prefix, items in zip(b["class"], b["prefix"], b["items"]):
            yield pd.DataFrame({"item": np.frombuffer(items, np.int64)[:prefix], "class": c})


def _link(percent: int):
    """Step 4 for the groups dealt to one task: (label, smallest label reached)."""
    def link(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in group.groupby("part", sort=True):
            part = part.sort_values("class").drop_duplicates("class")
            labels = list(part["label"])
            to = link_block([np.frombuffer(x, np.uint64) for x in part["items"]], part["size"].to_numpy(), labels,
                            percent)
            out += {(a, b) for a, b in zip(labels, to)}
        return pd.DataFrame(sorted(out), columns=["label", "reached"])
    return link


def _linked(sets: DataFrame, percent: int) -> DataFrame:
    """``sets`` (class, size, items, label, part, task) -> distinct (label, reached)."""
    return sets.groupBy("task").applyInPandas(_link(percent), "label binary, reached binary").distinct()


def similar_classes(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(class, label): classes with equal labels are linked."""
    total = groups.join(sets, "class").groupBy("component").agg(F.sum("n_items").alias("total"))
    part = F.hex("component")
    base = write_table(
        groups.join(sets, "class").join(total, "component")
        .withColumn("blocks", F.ceil(F.col("total") / BLOCK_ITEMS).cast("int")), "jaccard-sets")
    spread = max(1, int((base.agg(F.sum("n_items")).first()[0] or 0) // BLOCK_ITEMS) + 1)
    in_block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")

    def dealt(df: DataFrame) -> DataFrame:
        """Small groups go many to a task; a block of a large group has its own."""
        return df.withColumn("task", F.when(F.col("blocks") == 1, F.concat(F.lit("s"), F.pmod(
            F.xxhash64("component"), F.lit(spread)))).otherwise(F.col("part")))

    within = write_table(_linked(dealt(base.withColumn("label", F.col("class")).withColumn(
        "part", F.concat(part, F.lit("/"), in_block))), percent), "jaccard-within")
    labels = within.select(F.col("label").alias("class"), F.col("reached").alias("label"))
    large = base.where("blocks > 1")
    if large.isEmpty():
        return labels
    # One set of each class found within a block.
    reps = large.join(within.where("label = reached").select(F.col("label").alias("class")).distinct(), "class",
                      "left_semi")
    fewer = (reps.groupBy("component").agg(F.sum("n_items").alias("rest"))
             .withColumn("blocks", F.ceil(F.col("rest") / BLOCK_ITEMS).cast("int")).drop("rest"))
    among = _linked(dealt(reps.drop("blocks").join(fewer, "component").withColumn("label", F.col("class")).withColumn(
        "part", F.concat(part, F.lit("/r"), in_block))), percent)
    second = write_table(labels.join(among.select("label", "reached"), "label", "left")
                         .select("class", F.coalesce("reached", "label").alias("label")), "jaccard-among")
    # Groups whose sets are still apart: every pair of blocks, bounded tasks each.
    apart = (large.select("class", "component").join(second, "class").groupBy("component")
             .agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a != b").select("component"))
    rest = large.join(apart, "component", "left_semi").join(second, "class")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = (rest.withColumn("own", in_block).withColumn("other", other)
             .withColumn("part", F.concat(part, F.lit("/"), F.least("own", "other"), F.lit("-"),
                                          F.greatest("own", "other"))))
    across = write_table(_linked(dealt(pairs), percent).where("label != reached"), "jaccard-across")
    if across.isEmpty():
        return second
    final = connected_components(across.select(F.col("label").alias("a"), F.col("reached").alias("b")),
                                 "jaccard-final")
    return second.join(final.withColumnRenamed("id", "label"), "label", "left").select(
        "class", F.coalesce("component", "label").alias("label"))


def jaccard_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n_words: int = N_WORDS,
                   percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, text_hash (xxhash64 of the text),
    n_shingles, group (equal for documents linked directly or by way of
    others; null without words) and component_id (smallest non-null doc_id of
    the group; the own doc_id without words).

    A null or blank text has no shingles and no links; fewer than ``n_words``
    words count as one shingle.  Repeated rows stay repeated.  An empty table
    gives no rows.  Other columns are not looked at.
    """
    keyed = _keyed(docs, doc_id, text)
    table = write_table(_set_table(keyed, n_words), "jaccard-docs")
    classes = table.where("size > 0").groupBy("class").agg(
        F.min("doc_id").alias("least_id"), F.first("size").alias("size"), F.first("low").alias("low"),
        F.min(F.struct("doc_id", "text_hash")).alias("rep"))

    hot = hot_items(table)
    totals = table.agg(F.sum("size")).first()[0] or 0
    buckets = max(16, int(totals * SHARE // BUCKET_ITEMS) + 1)
    counted = (_packed(keyed.select("text"), n_words, buckets, False, hot).groupBy("bucket")
               .applyInPandas(_count_shared(buckets), "class binary, every long, low long")
               .groupBy("class").agg(F.sum("every").alias("shared"), F.sum("low").alias("shared_low")))
    least = F.ceil(F.col("size") * percent / F.lit(100.0))
    # A partner of a set below 3/4 SMALL is below SMALL, so all shingles of both were dealt.
    small = F.col("size") * 100 < percent * SMALL
    may_link = F.when(small, F.coalesce("shared", F.lit(0)) >= least).otherwise(
        F.coalesce("shared_low", F.lit(0)) >= F.col("low") - (F.col("size") - least))
    left = write_table(classes.join(counted, "class", "left").where(may_link)
                       .select("class", "size", F.col("rep.doc_id").alias("doc_id"),
                               F.col("rep.text_hash").alias("text_hash")), "jaccard-left")

    same = [keyed["doc_id"].eqNullSafe(left["doc_id"]), keyed["text_hash"].eqNullSafe(left["text_hash"])]
    texts = keyed.join(left, same[0] & same[1], "left_semi").select("text")
    items = left.agg(F.sum("size")).first()[0] or 0
    if not items:
        labels = None
    else:
        buckets = max(16, int(items // BUCKET_ITEMS) + 1)
        returned = (_packed(texts, n_words, buckets, True, hot).groupBy("bucket")
                    .applyInPandas(_return_shared(buckets), "class binary, items binary, df binary"))
        spread = max(16, int(items // BUCKET_ITEMS) + 1)
        sets = write_table(
            returned.join(left.select("class", "size"), "class")
            .groupBy(F.pmod(F.xxhash64("class"), F.lit(spread)).alias("task"))
            .applyInPandas(_ordered(percent), "class binary, size long, n_items long, prefix long, items binary"),
            "jaccard-ordered")
        rare = sets.select("class", "prefix", "items").mapInPandas(_prefix_items, "item long, class binary")
        stars = rare.groupBy("item").agg(F.min("class").alias("a"))
        edges = rare.join(stars, "item").select("a", F.col("class").alias("b")).where("a != b").distinct()
        groups = connected_components(edges, "jaccard-candidates").withColumnRenamed("id", "class")
        labels = similar_classes(sets, groups, percent)

    named = classes.select("class", "least_id")
    named = (named.withColumn("group", F.col("class")) if labels is None else
             named.join(labels, "class", "left").select("class", "least_id",
                                                        F.coalesce("label", "class").alias("group")))
    smallest = named.groupBy("group").agg(F.min("least_id").alias("component_id"))
    found = named.join(smallest, "group").select("class", "group", "component_id")
    return table.join(found, "class", "left").select(
        "doc_id", "text_hash", F.col("size").alias("n_shingles"), F.hex("group").alias("group"),
        F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
