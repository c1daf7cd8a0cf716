"""Bloom filter beside the history, global numbers, windows of any length, landed files."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import known_urls, state
from tidewater.operators.numbering import numbered
from tidewater.sources import feeds


def urls(spark, numbers):
    return spark.createDataFrame([(None if k is None else f"https://x.com/{k}",) for k in numbers], "url string")


@pytest.mark.parametrize("buckets,bits", [(1, 1 << 16), (5, 1 << 13)])
def test_filtered_look_up_equals_the_plain_anti_join(spark, tmp_path, buckets, bits):
    root = str(tmp_path)
    known_urls.add_urls(spark, root, "a", urls(spark, [*range(0, 2000), None, 5, 5]), buckets, bits)
    known_urls.add_urls(spark, root, "b", urls(spark, range(1500, 3000)))
    known_urls.add_urls(spark, root, "b", urls(spark, range(9000, 9999)))  # the same run: once
    entries = urls(spark, [*range(2500, 8000), None, *[1] * 500, 99999]).withColumn("pos", F.monotonically_increasing_id())
    stored = urls(spark, range(3000)).withColumnRenamed("url", "k")
    plain = entries.join(stored, F.col("url") == F.col("k"), "left_anti")
    got = known_urls.new_entries(spark, root, entries)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    known, n = known_urls.known_among(spark, root, entries)
    assert known.count() == n["stored"] == 501 and n["urls"] == 5502
    false = (n["passed"] - n["stored"]) / (n["urls"] - n["stored"])
    assert false < (0.002 if buckets == 1 else 0.08)  # 3,000 URLs in 65,536 and in 40,960 bits


def test_the_look_up_does_not_exchange_the_history(spark, tmp_path):
    root = str(tmp_path)
    known_urls.add_urls(spark, root, "a", urls(spark, range(1000)), 2, 1 << 14)
    seen = []
    real = known_urls.materialize

    def watch(df, name):
        if name == "known_urls":
            seen.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)
    known_urls.materialize, before = watch, known_urls.materialize
    try:
        known_urls.known_among(spark, root, urls(spark, range(990, 1010)))
    finally:
        known_urls.materialize = before
    plan = seen[0]
    join = plan.index("BroadcastHashJoin")
    history_side = plan[join:].split("BroadcastExchange")[0]
    assert "Exchange" not in history_side


def test_nothing_stored_yet(spark, tmp_path):
    assert known_urls.new_entries(spark, str(tmp_path), urls(spark, [1, None])).count() == 2


def test_numbers_follow_the_order_over_many_ranges(spark):
    r = random.Random(4)
    rows = [(r.randrange(50), f"s{k}") for k in range(3000)]
    df = spark.createDataFrame(rows, "n int, s string").repartition(7)
    out = numbered(df, F.col("n").desc(), F.col("s").asc())
    got = [(x.n, x.s) for x in sorted(out.collect(), key=lambda x: x.row_no)]
    assert got == sorted(rows, key=lambda x: (-x[0], x[1]))
    assert sorted(x.row_no for x in out.collect()) == list(range(1, 3001))
    assert numbered(df.limit(0), F.col("n")).collect() == []


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


@pytest.mark.parametrize("salts,bin_days", [(1, 7), (5, 2), (3, 400)])
def test_windows_of_any_length(spark, salts, bin_days):
    r = random.Random(7)
    windows = [(k, day(a), day(a + n)) for k in range(4) for a, n in [(r.randrange(60), r.randrange(-2, 30)) for _ in range(9)]]
    rows = [(i, 0 if i % 2 else r.randrange(4), dt.datetime(2024, 1, 1) + dt.timedelta(hours=r.randrange(2400)))
            for i in range(500)]
    got = state.assign_to_windows(spark.createDataFrame(rows, "i int, k int, ts timestamp"),
                                  spark.createDataFrame(windows, "k int, window_start date, window_end date"), "k", "ts",
                                  bin_days, salts)
    want = sorted((i, k, a, b) for i, k, t in rows for w, a, b in windows if w == k and a <= t.date() <= b)
    assert sorted((x.i, x.k, x.window_start, x.window_end) for x in got.collect()) == want


def test_window_counts_meet_the_state_as_one_row_per_day(spark):
    rows = spark.range(5000).select((F.col("id") % 2 * F.col("id") % 50).alias("feed"), F.timestamp_seconds(
        F.lit(1704067200) + F.col("id") * 600).alias("ts"))
    st = spark.createDataFrame([(k, day(0), day(25)) for k in range(50)],
                               "state_id long, backfill_start_date date, backfill_end_date date")
    counts = state.window_counts(rows, st, "feed", "ts")
    plain = state.assign_windows(rows, st, "feed", "ts").groupBy("feed", "window_start", "window_end").count()
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, plain.collect()))
    assert "partial_count" in counts._jdf.queryExecution().executedPlan().toString()


def test_places_in_landed_files_do_not_depend_on_splits(spark, tmp_path):
    for kw in range(3):
        folder = tmp_path / f"kw_pos={kw}" / "feed_pos=0"
        folder.mkdir(parents=True)
        items = "\n".join(f"<item><title>t{kw}-{k}</title><link>https://x.com/{k}</link></item>" for k in range(30))
        (folder / "feed.xml").write_text(f"<rss><channel>{items}</channel></rss>")
    now = F.lit("2024-01-31").cast("timestamp")
    want = [(kw, 0, k, f"t{kw}-{k}") for kw in range(3) for k in range(30)]
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for most in ("100", "1000", "134217728"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", most)
            got = feeds.read_feeds(spark, str(tmp_path), now).collect()
            assert sorted((r.kw_pos, r.feed_pos, r.entry_pos, r.title) for r in got) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_a_feed_stream_goes_on_where_it_stopped(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    now = F.lit("2024-01-31").cast("timestamp")

    def land(kw, n):
        folder = tmp_path / "in" / f"kw_pos={kw}" / "feed_pos=1"
        folder.mkdir(parents=True)
        (folder / "f.xml").write_text("".join(f"<item><link>u{kw}-{k}</link></item>" for k in range(n)))

    def run():
        feeds.stream_to_table(feeds.read_feeds(spark, landing, now, stream=True, max_files_per_trigger=1), target, checkpoint)
        return sorted((r.kw_pos, r.entry_pos, r.url) for r in spark.read.parquet(target).collect())
    land(0, 2)
    assert run() == [(0, 0, "u0-0"), (0, 1, "u0-1")]
    land(1, 1)
    land(2, 0)
    assert run() == [(0, 0, "u0-0"), (0, 1, "u0-1"), (1, 0, "u1-0")]
    assert run() == [(0, 0, "u0-0"), (0, 1, "u0-1"), (1, 0, "u1-0")]


def test_landed_responses(spark, tmp_path):
    folder = tmp_path / "file_pos=4"
    folder.mkdir()
    (folder / "r.jsonl").write_text('{"status": "ok", "articles": [{"title": "a"}, {"title": "b"}]}\n{"status": "error"}\n'
                                    'no json\n{"status": "ok", "articles": [{"title": "c"}]}\n')
    got = [(r.file_pos, r.resp_pos, r.art_pos, r.title) for r in feeds.read_news_api(spark, str(tmp_path)).collect()]
    assert sorted(got) == [(4, 0, 0, "a"), (4, 0, 1, "b"), (4, 3, 0, "c")]
    (folder / "r.jsonl").write_text('{"status": "ok",\n "articles": [{"title": "a"}]}')
    got = feeds.read_news_api(spark, str(tmp_path), one_per_line=False).collect()
    assert [(r.file_pos, r.resp_pos, r.art_pos, r.title) for r in got] == [(4, 0, 0, "a")]
