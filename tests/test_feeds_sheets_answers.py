"""Feed dates, CSV cells, batches, roles and text answers on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.catalog import message_summary
from tidewater.functions import dates
from tidewater.functions import llm_json as lj
from tidewater.operators import entities
from tidewater.operators.batches import union_batches
from tidewater.sinks import exports
from tidewater.sources.sheets import url_column

NOW = dt.datetime(2030, 1, 1)
TEN = dt.datetime(2024, 1, 1, 10)
FEED_DATES = [
    ("2024-01-01T10:00:00", TEN), ("2024-01-01 10:00:00+00:00", TEN), ("2024-01-01T12:00:00+0200", TEN),
    ("2024-01-01T10:00:00.500Z", dt.datetime(2024, 1, 1, 10, 0, 0, 500000)), ("2024-01-01", dt.datetime(2024, 1, 1)),
    ("Mon, 1 Jan 2024 12:00 +0200", TEN), ("Mon, 01 Jan 2024 10:00:00 GMT", TEN), ("01 Jan 24 10:00:00 GMT", TEN),
    ("Mon, 01 Jan 2024 05:00:00 EST", TEN), ("January 1, 2024 10:00 AM", TEN), ("Jan 1, 2024", dt.datetime(2024, 1, 1)),
    ("Mon Jan 01 10:00:00 2024", TEN), ("Mon Jan  1 10:00:00 2024", TEN), ("1 Jan 2024", dt.datetime(2024, 1, 1)),
    ("1/1/2024 10:00", TEN), ("2024/01/01 10:00:00", TEN), ("sometime last week", NOW), ("", NOW), (None, None),
]


def test_feed_dates(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(FEED_DATES)], "i int, s string")
    got = df.orderBy("i").select(dates.feed_date("s", F.lit(NOW).cast("timestamp")).cast("string")).collect()
    want = [None if w is None else w.isoformat(" ").rstrip("0") if w.microsecond else w.isoformat(" ")
            for _, w in FEED_DATES]
    assert [r[0] for r in got] == want


CELLS = [("2024-01-01", 'line one\nline two, "q"', "http://a/1", " padded ", "\r\nx", 'c:\\path "\\"'),
         ("", "", "http://a/2", "", "", "")]


def test_sheet_cells_survive_quotes_and_line_breaks(spark, tmp_path):
    path = str(tmp_path / "sheet")
    exports.append_sheet_rows(spark.createDataFrame(CELLS, exports.SHEET_COLUMNS), path)
    assert sorted(map(tuple, exports.read_sheet(spark, path).collect())) == sorted(CELLS)
    assert sorted(r.url for r in url_column(spark, path).collect()) == ["http://a/1", "http://a/2"]
    text = "".join(p.read_text() for p in (tmp_path / "sheet").glob("part-*"))
    assert '"line one\nline two, ""q"""' in text


def test_all_batches_failed_gives_an_empty_frame(spark):
    df = spark.createDataFrame([(1, "x")], "event_id int, url string")
    out = union_batches([(0, df, True), (1, df, True)])
    assert out.columns == ["event_id", "url", "kw_pos"] and out.collect() == []
    assert [r.kw_pos for r in union_batches([(0, df, True), (1, df, False)]).collect()] == [1]
    with pytest.raises(ValueError):
        union_batches([])


def test_role_of_the_element_is_kept(spark):
    person = ("struct<full_name:string,primary_title:string,primary_company:string,lead_relevance:string,notes:string,"
              "role_in_article:string>")
    df = spark.createDataFrame(
        [(1, 0, "u", "t", [("Ann", None, None, "High", None, "Quoted"), ("Bob", None, None, "Low", None, None)])],
        f"article_id long, article_pos int, article_url string, article_title string, people array<{person}>")
    assert [(r.full_name, r.role_in_article) for r in entities.explode_people(df).orderBy("elem_pos").collect()] == [
        ("Ann", "Quoted"), ("Bob", "Mentioned")]


def test_message_summary_of_text_answers(spark):
    rows = ['{"summary": "s", "brief": "b"}', '{"brief": "b"}', '"just text"', "[1]", "nope", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, a string")
    got = df.orderBy("i").select(message_summary(lj.parse_fenced_json("a")).alias("s")).collect()
    assert [r.s for r in got] == ["s", "b", "just text", None, None, None]
