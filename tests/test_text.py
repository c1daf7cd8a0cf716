"""D1-D7 branches not reached by the fixtures (FIXTURES.md part 2)."""

from pyspark.sql import functions as F

from tidewater.functions import text


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col).first()[0]


def test_paragraph_length_threshold(spark):
    p40, p41 = "a" * 40, "b" * 41
    html = f"<html><body><p>{p40}</p><p>{p41}</p></body></html>"
    assert one(spark, text.page_main_text("x"), html) == p41


def test_first_30_paragraphs(spark):
    ps = "".join(f"<p>paragraph number {i:02d} with enough characters to pass</p>" for i in range(31))
    out = one(spark, text.page_main_text("x"), f"<body>{ps}</body>")
    assert "number 29" in out and "number 30" not in out


def test_meta_description_fallback(spark):
    html = '<html><head><meta content="  A page &amp; more  " name="description"></head><body><p>short</p></body>'
    assert one(spark, text.page_main_text("x"), html) == "A page & more"
    assert one(spark, text.page_main_text("x"), "<body><p>short</p></body>") is None


def test_noise_removed_and_entities_decoded(spark):
    html = ('<body><nav><p>navigation paragraph that is long enough to count here</p></nav>'
            '<script>var t="</p>";</script><!-- <p>comment</p> -->'
            '<p>Caf&eacute; &lt;tag&gt; &#8364; and &copy; appear in a long paragraph</p><footer>f</footer></body>')
    assert one(spark, text.page_main_text("x"), html) == "Café <tag> € and © appear in a long paragraph"


def test_html_to_text(spark):
    assert one(spark, text.html_to_text("x"), "<p><b>Hello</b> &amp; <i>world</i></p><!-- c -->") == "Hello & world"


def test_summary_cap(spark):
    df = spark.createDataFrame([("t", "x" * 1200), ("t", "y" * 1199 + " z"), ("Title", "")],
                               "title string, summary string")
    out = [r[0] for r in df.select(text.build_summary("title", "summary", F.lit(None).cast("string"))).collect()]
    assert out[0] == "x" * 1200
    assert out[1] == "y" * 1199 + "..."          # 1201 chars -> cut at 1200, rstrip, '...'
    assert out[2] == "Title"


def test_sentences_and_keywords(spark):
    t = "First one. Second is about water!  Third? Fourth has cooling. Fifth."
    assert one(spark, text.first_sentences("x", 3), t) == "First one. Second is about water! Third?"
    pat = text.keyword_pattern(text.TOPIC_KEYWORDS)
    assert one(spark, text.keyword_sentences("x", pat), t) == "Second is about water! Fourth has cooling."
    assert one(spark, text.keyword_sentences("x", pat), "nothing here") is None


def test_company_names_in_text_order(spark):
    t = "Deal with PROMO BURNISHED COPPER Corp and Goldenrod Lavender Spring Chocolate Lace Ltd. Acme Inc."
    assert one(spark, text.company_like_names("x"), t) == [
        "PROMO BURNISHED COPPER Corp", "Lavender Spring Chocolate Lace Ltd", "Acme Inc"]


def test_source_company_and_dedupe(spark):
    df = spark.createDataFrame([("Acme Inc", "News about Acme Inc today."), ("unknown", "x"), ("", "x")],
                               "src string, body string")
    out = [r[0] for r in df.select(F.transform(text.heuristic_companies("src", "body"), lambda c: c["notes"])).collect()]
    assert out == [["Article source outlet."], [], []]


def test_comments_and_raw_text_elements_nest_like_a_parser(spark):
    # a tag inside a comment is comment text; a comment opener inside a script is script text
    assert one(spark, text.html_to_text("x"), "<!-- <script> -->visible text</script>") == "visible text"
    assert one(spark, text.html_to_text("x"), '<script>var s = "<!--";</script>kept<!-- gone -->') == "kept"
    long = "A paragraph that is clearly longer than forty characters in total."
    page = f"<nav><!-- </nav> -->menu</nav><p>{long}</p><footer>bye</footer>"
    assert one(spark, text.page_main_text("x"), page) == long


LONG = [f"Paragraph number {k} is clearly longer than forty characters in total." for k in range(4)]


def test_nested_and_unclosed_noise_elements(spark):
    a, b, c, d = LONG
    pages = {
        f"<nav><nav><p>{a}</p></nav><p>{b}</p></nav><p>{c}</p>": c,
        f"<div><nav><p>{a}</p></div><p>{b}</p>": b,                      # closed by its parent's end tag
        f"<footer><nav><p>{a}</footer><p>{b}</p></nav><p>{c}</p>": f"{b} {c}",  # a stray end tag closes nothing
        f"<p>{a}</p><aside><p>{b}</p>": a,                               # never closed
        f"<p>{a}</p></nav><p>{b}</p>": f"{a} {b}",
        f"<header><script>if (a < b) '</header>'</script><header></header><p>{a}</p></header><p>{b}</p>": b,
        f"<nav title='a > b'><nav></nav><!-- </nav> --><p>{a}</p></nav><p>{b}</p>": b,
        f"<nav><img><br/><nav/></nav></nav><p>{a}</p>": a,
        f"<body><p>{a}<p>{b}<nav><nav></nav></nav><p>{c}</body>": f"{a} {b} {c}",
        f"<NAV><Nav></nav><p>{a}</p></NAV><p>{b}</p>": b,
        f"<p>{d}</p>": d,
    }
    df = spark.createDataFrame(list(enumerate(pages)), "i int, x string")
    got = {r.i: r.t for r in df.select("i", text.page_main_text("x").alias("t")).collect()}
    assert got == dict(enumerate(pages.values()))


def test_only_pages_with_leftover_noise_are_scanned_again(spark):
    pages = [f"<nav>m</nav><p>{LONG[0]}</p><footer>f</footer>", "<nav><nav></nav></nav>", None, "plain"]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, x string")
    left = text._drop_elements(F.col("x"), text.NOISE_TAGS).rlike(text._NOISE_LEFT)
    assert [r.i for r in df.filter(left).collect()] == [1]


def test_a_very_long_page_with_nested_noise(spark):
    page = "<nav>" * 20_000 + "x" + "</nav>" * 20_000 + f"<p>{LONG[0]}</p>"
    assert one(spark, text.page_main_text("x"), page) == LONG[0]


def test_all_paragraphs(spark):
    ps = "".join(f"<p>paragraph number {i:02d} with enough characters to pass</p>" for i in range(40))
    assert "number 39" in one(spark, text.page_main_text("x", None), f"<body>{ps}</body>")


def test_pages_reach_python_in_small_batches(spark):
    """Row functions: a hundred rows at a time, where an Arrow batch holds ten thousand pages."""
    pages = spark.createDataFrame([("<p>x</p>",)], "html string").repartition(2)
    plan = pages.select(text.page_main_text("html"), text.html_unescape("html"))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan


def test_unescape_of_nulls_and_all_planes(spark):
    import html
    rows = [None, "", "a & b", "&#128512; \U0001f600 &amp;amp; &nosuch; &#xD800; &eacute", "\u0001&lt;\u0003é€"]
    got = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string").select("i", text.html_unescape("s").alias("t"))
    assert [r.t for r in sorted(got.collect())] == [r if r is None else html.unescape(r) for r in rows]
