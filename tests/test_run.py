"""E1 on stored tables: all failure stages, counters, runs cut off and replayed."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewater.operators import state
from tidewater.plans import run
from tidewater.schemas import TABLES
from tidewater.sinks import commits

D = dt.date
NOW = "2024-02-01 00:00:00"
ENTRY = ("window_start date, window_end date, kw_pos int, entry_pos long, title string, url string, source_name string, "
         "publish_datetime string, summary string")


def now():
    return F.lit(NOW).cast("timestamp")


def entries(spark):
    w1, w2 = (D(2024, 1, 1), D(2024, 1, 7)), (D(2024, 1, 8), D(2024, 1, 14))
    rows = [(*w1, 0, 0, "One", "https://a.com/1?utm_source=x", "A", "2024-01-02 03:04:05", "s1"),
            (*w1, 0, 1, "Two", "https://a.com/2", "A", "not a date", None),          # article_insert
            (*w1, 1, 0, "One again", "https://a.com/1", "B", "2024-01-02 03:04:05", None),
            (*w1, 1, 1, "No link", None, "A", None, None),                            # skipped
            (*w1, 1, 2, "Old", "https://a.com/old#x", "A", None, None),               # known
            (*w2, 0, 0, "Three", "https://a.com/3", None, None, "s3"),
            (*w2, 0, 1, "Four", "https://a.com/4", "unknown", None, "s4"),            # extract
            (*w2, 0, 2, None, "https://a.com/5", "A", None, None),
            (*w2, 0, 3, "Beyond", "https://a.com/6", "A", None, None)]                # dropped by the limit
    return spark.createDataFrame(rows, ENTRY)


def answers(spark):
    one = {"summary": "A summary that is certainly longer than forty characters.", "mentions_cooling_or_water": True,
           "people": [{"full_name": "Ann Lee", "primary_company": "Acme", "lead_relevance": "High", "notes": "n"},
                      {"full_name": " ann lee ", "primary_company": "ACME"}, {"full_name": "Too Long Of A Name"}],
           "companies": [{"name": "Acme", "sector": "Power"}, {"name": "A company with far too long a name"}], "country": "DE"}
    three = {**one, "people": [{"full_name": "Bob", "notes": "b"}, {"full_name": "Ann Lee", "primary_company": "Acme"}],
             "companies": [{"name": "acme "}, {"name": "Known Corp"}]}
    return spark.createDataFrame([("https://a.com/1", json.dumps(one)), ("https://a.com/3", "Sure: " + json.dumps(three))],
                                 "url string, answer string")


def start(spark, root):
    stamps = {"created_at": now(), "updated_at": now()}
    commits.commit(spark, root, "first", {
        "articles": spark.createDataFrame([(5, "Old", "s", "https://a.com/old", "A", "en", False)],
                                          "article_id long, title string, summary string, url string, source_name string, "
                                          "language string, mentions_cooling_or_water boolean").withColumns(stamps),
        "companies": spark.createDataFrame([(77, "known corp")], "company_id long, name string").withColumns(stamps),
        "people": spark.createDataFrame([(88, "bob", None, "Low")], "person_id long, full_name string, primary_company "
                                        "string, lead_relevance string").withColumns(stamps),
        "ingestion_state": spark.createDataFrame(
            [(1, D(2024, 1, 1), D(2024, 1, 14), False)], "state_id long, backfill_start_date date, backfill_end_date date, "
            "backfill_complete boolean").withColumn("updated_at", now())}, schemas=TABLES)


def go(spark, root, run_id="r1", **options):
    pages = spark.createDataFrame([("https://a.com/3", "<p>x</p>")], "url string, html string")
    errors = spark.createDataFrame([("https://a.com/4", "ReadTimeout", "too slow")],
                                   "url string, error_type string, error_message string")
    plan = state.plan_runs(run.read(spark, root, "ingestion_state"), F.lit("2024-03-01").cast("date"), 14)
    return run.run_ingest(spark, root, entries(spark), pages, run_id, now(), plan, answers=answers(spark), errors=errors,
                          limits={"companies": {"name": 20}, "people": {"full_name": 12}}, limit=3, mode="backfill", **options)


def tables(spark, root):
    return {n: sorted(map(tuple, run.read(spark, root, n).collect()), key=str) for n in run.STORED}


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store"))
    start(spark, root)
    assert go(spark, root) == 1
    return root, tables(spark, root)


def test_rows_of_a_run(spark, whole):
    root, _ = whole
    got = {n: run.read(spark, root, n).collect() for n in run.STORED}
    assert {r.url for r in got["articles"]} == {"https://a.com/old", "https://a.com/1", "https://a.com/3", "https://a.com/5"}
    by_url = {r.url: r for r in got["articles"]}
    assert by_url["https://a.com/1"].country == "DE" and by_url["https://a.com/1"].mentions_cooling_or_water
    assert by_url["https://a.com/5"].title == "Untitled" and by_url["https://a.com/3"].source_name == "Unknown"
    assert {r.name for r in got["companies"]} == {"known corp", "Acme", "A"}
    assert {(r.full_name, r.lead_relevance) for r in got["people"]} == {("bob", "Low"), ("Ann Lee", "High")}
    ann = next(r.person_id for r in got["people"] if r.full_name == "Ann Lee")
    ids = {r.url: r.article_id for r in got["articles"]}
    assert {(r.article_id, r.person_id, r.relation_description) for r in got["article_people"]} == {
        (ids["https://a.com/1"], ann, "n"), (ids["https://a.com/3"], 88, "b"), (ids["https://a.com/3"], ann, None)}
    assert {(r.stage, r.error_kind) for r in got["extraction_failures"]} == {
        ("extract", "transient_timeout"), ("article_insert", "permanent_write"), ("company_insert", "permanent_write"),
        ("person_insert", "permanent_write"), ("relation_link", "dependent_write")}
    counts = {r.window_start: (r.mode, r.processed, r.inserted, r.updated, r.people_added, r.companies_added, r.skipped,
                               r.dropped) for r in got["run_stats"]}
    assert counts == {D(2024, 1, 1): ("backfill", 4, 1, 1, 1, 1, 2, 1), D(2024, 1, 8): ("backfill", 3, 2, 0, 0, 1, 1, 1)}
    state_row, = got["ingestion_state"]
    assert state_row.backfill_progress_cutoff == D(2024, 1, 15) and state_row.backfill_complete
    assert len(got["run_events"]) == 3


@pytest.mark.parametrize("staged", [3, 8])
def test_a_run_cut_off_after_any_table_leaves_none_and_can_run_again(spark, tmp_path, whole, monkeypatch, staged):
    root = str(tmp_path)
    start(spark, root)
    before = tables(spark, root)
    real, done = commits.stage, []

    def dies(*args):
        if len(done) == staged:
            raise OSError("lost")
        done.append(args)
        return real(*args)
    monkeypatch.setattr(commits, "stage", dies)
    if staged == 8:
        monkeypatch.setattr(commits, "publish", dies)
    with pytest.raises(OSError):
        go(spark, root)
    monkeypatch.undo()
    assert tables(spark, root) == before and commits.latest(spark, root) == 0
    assert go(spark, root) == 1
    assert tables(spark, root) == whole[1]
    assert go(spark, root) == 1 and commits.latest(spark, root) == 1


def test_another_run_finds_everything_known(spark, tmp_path):
    root = str(tmp_path)
    start(spark, root)
    go(spark, root)
    old = tables(spark, root)
    assert go(spark, root, "r2") == 2
    new = tables(spark, root)
    for n in ("companies", "people", "article_people"):
        assert new[n] == old[n]
    assert new["articles"] == old["articles"]
    again = [r for r in run.read(spark, root, "extraction_failures").collect() if r.run_id == "r2"]
    assert {r.stage for r in again} == {"extract", "article_insert"}
