"""I1 (reference tests), O2 ordering, D15/D16, K8, S2/J2, S5, K5, S1/P9."""

import datetime as dt

from pyspark.sql import functions as F

from tidewater.functions import dates, errors
from tidewater.operators import briefing, report, resolve, state
from tidewater.sources import feeds


STATE_SCHEMA = ("state_id long, backfill_start_date date, backfill_end_date date, backfill_progress_cutoff date, "
                "backfill_complete boolean, last_daily_run_end timestamp")


def test_run_planning_reference_cases(spark):
    d = dt.date
    today = dt.date(2025, 3, 1)
    yesterday = today - dt.timedelta(days=1)
    rows = [(1, d(2025, 1, 1), d(2025, 1, 31), d(2025, 1, 1), False, None),
            (2, d(2025, 1, 1), d(2025, 1, 31), d(2025, 2, 1), False, None),
            (3, d(2025, 1, 1), d(2025, 1, 31), None, True, dt.datetime.combine(yesterday, dt.time(23, 59, 59))),
            (4, None, None, None, False, None)]
    df = spark.createDataFrame(rows, STATE_SCHEMA)
    out = {r.state_id: r for r in state.plan_runs(df, F.lit(today)).collect()}
    assert (out[1].mode, out[1].window_start, out[1].window_end, out[1].mark_backfill_complete) == \
        ("backfill", d(2025, 1, 1), d(2025, 1, 7), False)
    assert (out[2].window_start, out[2].mark_backfill_complete) == (None, True)
    assert (out[3].mode, out[3].window_start) == ("daily", None)
    assert out[4].error is not None


def test_people_order_is_lexical(spark):
    df = spark.createDataFrame([("a", "High"), ("b", "Medium"), ("c", "Low")], "full_name string, lead_relevance string")
    assert [r.lead_relevance for r in report.people_order(df).collect()] == ["Medium", "Low", "High"]
    assert [r.lead_relevance for r in report.people_order(df, rank_order=True).collect()] == ["High", "Medium", "Low"]


def test_error_classification(spark):
    rows = [("ReadTimeout", "x"), ("ConnectError", "x"), ("HTTPStatusError", "Client error '429 Too Many'"),
            ("HTTPStatusError", "Server error 503 Service Unavailable"), ("HTTPStatusError", "Client error '404'"),
            ("ServiceUnavailable", "x"), ("ValueError", "bad")]
    df = spark.createDataFrame(rows, "t string, m string")
    got = [r[0] for r in df.select(errors.classify_error("t", "m")).collect()]
    assert got == ["transient_timeout", "transient_network", "transient_http", "transient_http", "permanent_http",
                   "transient_service", "unknown"]
    retry, delay = errors.retry_decision(F.lit("transient_http"), F.col("a"))
    att = spark.createDataFrame([(1,), (2,), (3,)], "a int").select(retry, delay).collect()
    assert [(r[0], r[1]) for r in att] == [(True, 1), (True, 2), (False, None)]


def test_briefing_top3_and_empty(spark):
    arts = spark.createDataFrame([(i, f"Article {i}", f"http://x/{i}", f"S{i}") for i in range(1, 5)],
                                 "pos int, title string, url string, summary string")
    msg = briefing.briefing_message(arts).first()[0]
    assert msg.startswith(briefing.BRIEFING_HEADER.strip()) and "3. *Article 3*" in msg and "Article 4" not in msg
    assert briefing.briefing_message(arts.limit(0)).first()[0] == "No new articles found today."


def test_news_api_and_known_subtraction(spark):
    body = ('{"status": "ok", "articles": [{"title": "1", "url": "/1", "publishedAt": "2023-01-01T10:00:00Z"},'
            '{"title": "2", "url": "/2", "publishedAt": "2023-01-01T11:00:00Z"},'
            '{"title": "3", "url": "/3", "publishedAt": "2023-01-01T12:00:00Z"}]}')
    resp = spark.createDataFrame([(0, body), (1, '{"status": "error", "articles": []}')], "pos int, body string")
    arts = feeds.news_api_articles(resp, "body", "pos")
    known = spark.createDataFrame([("/2",), ("/old",)], "url string")
    out = [r.url for r in resolve.subtract_known(arts, known).orderBy("resp_pos", "art_pos").collect()]
    assert out == ["/1", "/3"]


def test_rss_item_parse(spark):
    item = ('<item><title>T</title><link>http://x/1</link><pubDate>Mon, 01 Jan 2024 00:00:07 GMT</pubDate>'
            '<description>&lt;p&gt;Hello &amp;amp; bye&lt;/p&gt;</description><source url="http://s">Src</source></item>')
    bare = "<item><title>U</title><link>http://x/2</link><pubDate>not a date</pubDate></item>"
    df = spark.createDataFrame([(0, item), (1, bare)], "pos int, xml string")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    out = feeds.parse_rss_items(df, "xml", now).orderBy("pos").collect()
    assert (out[0].source_name, out[0].summary, out[0].publish_datetime) == \
        ("Src", "Hello & bye", dt.datetime(2024, 1, 1, 0, 0, 7))
    assert (out[1].source_name, out[1].summary, out[1].publish_datetime) == ("Unknown", "", dt.datetime(2024, 2, 1))


def test_iso_and_as_date(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 5),), (dt.datetime(2024, 1, 1),)], "t timestamp")
    assert [r[0] for r in df.select(dates.iso_utc("t")).collect()] == [
        "2024-01-01T00:00:07.000005+00:00", "2024-01-01T00:00:00+00:00"]
    from pyspark.sql import types as T
    s = spark.createDataFrame([("2024-01-05T23:00:00+05:00",), ("2024-01-06",), ("junk",)], "s string")
    assert [r[0] for r in s.select(dates.as_date("s", T.StringType())).collect()] == [
        dt.date(2024, 1, 5), dt.date(2024, 1, 6), None]


def test_sheet_url_column_drops_header(spark, tmp_path):
    from tidewater.sinks.exports import append_sheet_rows
    from tidewater.sources.sheets import url_column
    rows = spark.createDataFrame([("2023-01-01", "T", "http://example.com/1", "S", "A", "E"),
                                  ("2023-01-01", "T", "http://example.com/2", None, None, None)],
                                 "date string, title string, url string, summary string, author string, entities string")
    path = str(tmp_path / "sheet")
    append_sheet_rows(rows, path)
    assert sorted(r.url for r in url_column(spark, path).collect()) == ["http://example.com/1", "http://example.com/2"]
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["date", "title", "url", "summary", "author", "entities"]
