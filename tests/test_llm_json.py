"""D8-D13, P15, P16, S9 (reference tests + code-defined branches)."""

import json

from pyspark.sql import functions as F

from tidewater.functions import llm_json as lj


def col1(spark, expr, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr).collect()]


def test_fenced_json_valid_and_invalid(spark):
    good = json.dumps({"summary": "This is a summary.", "author": "John Doe",
                       "entities": ["Google (Tech Giant)"], "relevance_score": 8})
    rows = spark.createDataFrame([("```json\n" + good + "\n```",), ("Invalid JSON",)], "x string") \
        .select(lj.briefing_fields(lj.parse_fenced_json("x")).alias("b")).collect()
    b = rows[0].b
    assert (b.summary, b.author, b.entities, b.relevance_score) == ("This is a summary.", "John Doe",
                                                                   ["Google (Tech Giant)"], 8)
    assert rows[1].b.summary is None


def test_primary_error_uses_fallback(spark):
    fb = json.dumps({"summary": "Fallback success", "author": "Jane Doe", "entities": [], "relevance_score": 5})
    df = spark.createDataFrame([(None, "API Error", fb), ("not json", None, fb)], "p string, e string, f string")
    out = [r[0] for r in df.select(lj.briefing_fields(lj.primary_or_fallback("p", "e", "f"))["summary"]).collect()]
    assert out == ["Fallback success", None]    # unparseable primary does not fall back


def test_json_object_from_text(spark):
    vals = ['{"a": 1}', 'Sure: {"a": 2} thanks', '[{"a": 3}]', None, "", '{"a": 1} trailing', '"str"']
    out = col1(spark, F.to_json(lj.json_object_from_text("x")), vals)
    assert out == ['{"a":1}', '{"a":2}', None, None, None, '{"a":1}', None]


def test_score_threshold(spark):
    vals = [json.dumps({"mentions_cooling_or_water": True, "people": []}),       # 0.15 + 0.2 = 0.35 passes
            json.dumps({"mentions_cooling_or_water": True, "country": "US"}),    # 0.25 fails
            json.dumps({"summary": "x" * 40})]
    out = col1(spark, lj.extraction_score(lj.json_object_from_text("x")), vals)
    assert out[0] >= lj.MIN_CONFIDENCE and out[1] < lj.MIN_CONFIDENCE and out[2] == 0.35


def test_normalise_truthiness_and_people(spark):
    fb = F.struct(F.lit("fb summary").alias("summary"), F.lit(True).alias("mentions_cooling_or_water"),
                  F.lit(None).cast("string").alias("cooling_water_summary"),
                  F.array().cast(f"array<{lj.PERSON_T}>").alias("people"),
                  F.array().cast(f"array<{lj.COMPANY_T}>").alias("companies"),
                  F.lit(None).cast("string").alias("full_text"), F.lit("US").alias("country"))
    vals = [json.dumps({"mentions_cooling_or_water": "false", "people": [
                {"full_name": " Ann ", "lead_relevance": "Urgent", "primary_title": 5}, {"full_name": "  "}, 7]}),
            json.dumps({"mentions_cooling_or_water": None, "summary": ""}),
            json.dumps({"summary": "kept"})]
    rows = spark.createDataFrame([(v,) for v in vals], "x string") \
        .select(lj.normalize_extraction(lj.json_object_from_text("x"), fb).alias("n")).collect()
    a, b, c = (r.n for r in rows)
    assert a.mentions_cooling_or_water is True                     # "false" is truthy
    assert [(p.full_name, p.lead_relevance, p.primary_title) for p in a.people] == [("Ann", "Low", None)]
    assert b.mentions_cooling_or_water is False and b.summary == "fb summary"
    assert c.mentions_cooling_or_water is True and c.summary == "kept"     # missing key -> fallback flag


def test_response_content(spark):
    vals = ['{"choices": [{"message": {"content": "hi"}}]}', '{"choices": []}', '{"x": 1}',
            '{"choices": [{"message": {"content": 5}}]}', "garbage"]
    assert col1(spark, lj.llm_response_content("x"), vals) == ["hi", None, None, None, None]


def test_staged_forms_match_column_forms(spark):
    """The DataFrame (staged) forms give the Column forms' answers."""
    fb = F.struct(F.lit("fb summary").alias("summary"), F.lit(True).alias("mentions_cooling_or_water"),
                  F.lit(None).cast("string").alias("cooling_water_summary"),
                  F.array().cast(f"array<{lj.PERSON_T}>").alias("people"),
                  F.array().cast(f"array<{lj.COMPANY_T}>").alias("companies"),
                  F.lit(None).cast("string").alias("full_text"), F.lit("US").alias("country"))
    long = "A summary that is comfortably longer than forty characters."
    vals = ['{"a": 1}', 'Sure: {"a": 2} thanks', '[{"a": 3}]', None, "", '"str"', "  {\"a\": 4}\n",
            json.dumps({"summary": long, "mentions_cooling_or_water": 1, "country": "DE", "people": [
                {"Full_Name": "Case"}, {"full_name": 7}, {"full_name": "Bo", "lead_relevance": "High",
                                                          "notes": ["x"]}, [1], "str"],
                        "companies": [{"name": " Acme ", "sector": None}, {"name": ""}, 3]}),
            "Here: " + json.dumps({"summary": long, "people": [], "companies": {"name": "x"}}) + " end"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x string").withColumn("fb", fb)
    staged = lj.with_extraction_choice(lj.with_answer_object(df, "x", "v"), "x", "fb", "c")
    staged = lj.with_extraction_score(staged, "v", "score")
    cols = staged.select("i", F.to_json("v").alias("v"), "score", F.to_json("c").alias("c"),
                         F.to_json(lj.json_object_from_text("x")).alias("v0"),
                         lj.extraction_score(lj.json_object_from_text("x")).alias("score0"),
                         F.to_json(lj.extraction_choice("x", F.col("fb"))).alias("c0")).orderBy("i").collect()
    for r in cols:
        assert (r.v, r.c) == (r.v0, r.c0), r.i
        assert (r.score is None and r.score0 is None) or abs(r.score - r.score0) < 1e-9, r.i
    assert [r.v is not None for r in cols] == [True, True, False, False, False, False, True, True, True]
    p = json.loads(cols[7].c)["payload"]
    assert [x["full_name"] for x in p["people"]] == ["Bo"]          # case-sensitive keys, non-objects dropped
    assert p["people"][0].get("notes") is None                        # non-string member -> NULL (to_json omits it)
    assert [x["name"] for x in p["companies"]] == ["Acme"]


def test_reads_what_python_reads(spark):
    """Against json.loads itself: trailing values, repeated keys, NaN, cut texts, brackets inside strings."""
    import json
    texts = ['{"a": 1} {"b": 2}', '{"a": 1}{"a": 2}', '[1] [2]', '{"a": 1, "a": 2}', '{"a": {"b": 1, "b": [3]}}',
             '{"a": NaN}', '{"a": [Infinity, -Infinity]}', '{"a": "} {", "b": "] x"}', '{"a": "\\\\" }', '{"a": 1}}',
             '{"a": "{"}}', '{"a": 1}, {"b": 2}', '{"a": [{"b": 1}, {"c": "}, {"}]}', '{"a": "\\\\"}, {"b": "\\""}', '{"a": [1}]',
             '{"a": 1,}', '{"a": tru}', ' {"a" : [ ] } ', '{}', '[]', '{"a": "x', 'NaN', 'text', '"a" "b"', '3 4', None, "",
             "x {\"a\": 1} y {\"b\": 2} z", "x {\"a\": 1, \"a\": 5} y", '{"a": 1} tail }', "[" * 2000 + "]" * 2000]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    got = {r.i: r for r in rows.select("i", F.to_json(lj.strict_parse_json("x")).alias("v"),
                                       F.to_json(lj.json_object_from_text("x")).alias("o")).collect()}
    staged = {r.i: r.v for r in lj.with_answer_object(rows, "x", "v").select("i", F.to_json("v").alias("v")).collect()}

    def loads(t):
        try:
            return lj._finite(json.loads(t.strip())) if t is not None else None
        except (ValueError, RecursionError):
            return None

    def same(text, value):
        return value is None if text is None else json.loads(text) == value
    for i, x in enumerate(texts):
        whole = loads(x)
        span = x[x.find("{"): x.rfind("}") + 1] if x and "{" in x and "}" in x else None
        found = whole if whole is not None else loads(span)
        assert x in ("NaN", texts[-1]) or same(got[i].v, whole), x
        assert same(got[i].o, found if isinstance(found, dict) else None), x
        assert same(staged[i], found if isinstance(found, dict) else None), x


def test_only_doubtful_texts_are_read_again(spark):
    texts = ['{"a": 1}', '{"a": [1, 2], "b": {}}', "no json", '{"a"', None, '{"a": 1} {"b": 2}', '{"a": 1, "a": 2}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    again = [r.i for r in df.filter(lj.doubtful(F.col("x"), F.try_parse_json("x"))).collect()]
    assert again == [5, 6]
