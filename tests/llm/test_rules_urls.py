"""Quality rules and URL filter against plain Python."""

import pytest

from tidewater.llm import quality_rules, url_filter

from .helpers import awkward, frame, prose, rng, words


def statistics(text):
    w = words(text)
    repeated, seen = set(), {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i: i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            repeated |= {j for i in at for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(repeated))


def corpus():
    r = rng(4)
    rows = [(i, prose(r, r.choice([20, 60, 200]), r.choice([4, 20, 500]))) for i in range(30)]
    rows += [(40, "one line\none line\n\none line \n" * 3), (41, "#$% a|b <c> &*" * 9), (42, "a b a b a b a b"),
             (43, "x y z x y z"), (44, "tab\tnewline\x0bvertical\x0cfeed\x1cfs\x85nel\xa0nbsp"), (45, "a a a a")]
    return rows + [(a, b) for a, b, *_ in awkward()]


def test_statistics_and_base(spark):
    rows = corpus()
    got = quality_rules.judge(frame(spark, [(i, t, None, None, None) for i, t in rows]))
    made = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in got.collect()), key=str)
    want = []
    for i, t in rows:
        s = statistics(t)
        want.append((i, *s, s[0] < 50 or 100 * s[4] > 50 * s[0]))
    assert made == sorted(want, key=str)
    assert got.where("base_failed and kept").isEmpty()


def test_posterior_keeps_prose_and_drops_junk(spark):
    r = rng(6)
    good = [(i, " ".join(f"{'abcdefghijklmnop'[r.randrange(16)] * 2}word{r.randrange(300)}" for _ in range(120)))
            for i in range(200)]
    bad = [(1000 + i, " ".join("### $$$ %%% ABCD" if k % 2 else "&&& |||" for k in range(60)) + f" {i}")
           for i in range(20)]
    kept = {x.doc_id for x in quality_rules.judge(
        frame(spark, [(i, t, None, None, None) for i, t in good + bad])).where("kept").collect()}
    assert kept == {i for i, _ in good}


def test_no_documents(spark):
    assert quality_rules.judge(frame(spark, [])).collect() == []


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    tail = rest[end:]
    stop = min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), tail[:stop]


def rule_of(host, path):
    fits = [(len(h) + len(p), h + p, v) for h, p, v in url_filter.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = ["https://a.com/x", "http://WWW.Example.COM/en/p?q#f", "https://example.com/en/", "https://example.com/en",
        "https://sub.example.com/en/a", "x.net/es/", "https://x.net/es/1", "https://x.net/de/", "https://net/fr/x",
        "https://b.org", "https://b.org?x=/y", "https://b.org#://c.com/", "ftp://com/", "https://notcom/",
        "https://ünï.com/Ä", "://com/", "a\n://www.example.com/en/\nx", None, "", "https:///p", "http://x.net/fr/"]


def test_host_path_and_rule(spark):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate([*URLS, URLS[0]])],
                                  "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS rule")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect()}
    assert len(got) == len(URLS) + 1
    for i, u in enumerate([*URLS, URLS[0]]):
        host, path = split(u)
        rule, verdict = rule_of(host, path)
        assert got[i][:3] == (host, path, rule), u
        if verdict:
            assert got[i][3] == verdict


def test_distrust_flows_to_those_that_link_to_blocked_hosts(spark):
    link = lambda *hosts: "".join(f'<a href="https://{h}/">x</a>' for h in hosts)
    rows = [(1, "https://bad.net/es/a", ""), (2, "https://spam.org/", link("bad.net")), (3, "https://good.com/", link("fine.org")),
            (4, "https://fine.org/", ""), (5, "https://alone.org/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(pages).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}


def test_one_blocked_host_does_not_outweigh_many_trusted_ones(spark):
    """The weight of a seed doesn't depend on how many others there are."""
    link = lambda *hosts: "".join(f'<a href="https://{h}/">x</a>' for h in hosts)
    rows = [(i, f"https://t{i}.com/", link("hub.org" if i else "leaf.org")) for i in range(1000)]
    rows += [(2000, "https://hub.org/", link("bad.net")), (2001, "https://leaf.org/", link("bad.net")),
             (2002, "https://spam.org/", link("bad.net")), (2003, "https://bad.net/es/x", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(pages).where("page_id >= 2000").collect()}
    assert got == {2000: "allow", 2001: "allow", 2002: "block", 2003: "block"}


def test_no_pages(spark):
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_distrust_reaches_the_end_of_a_long_chain(spark):
    n = 20
    link = lambda h: f'<a href="https://{h}/">x</a>'
    rows = [(i, f"https://h{i}.org/", link(f"h{i + 1}.org")) for i in range(n - 1)]
    rows += [(n - 1, f"https://h{n - 1}.org/", link("bad.net")), (n, "https://bad.net/es/x", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filter.judge_urls(pages).collect()}
    assert {r.verdict for r in got.values()} == {"block"}
    for i in range(n):
        assert got[i].trust == 0 and got[i].distrust == pytest.approx(0.15 * 0.85 ** (n - i), rel=1e-6)


def test_scores_on_a_circle_have_settled(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "c", 3), ("b", "a", 1), ("c", "a", 2)],
                                  "src string, dst string, n long")
    seeds = spark.createDataFrame([("a", 1.0)], "host string, seed double")
    got = {r.host: r.score for r in url_filter.propagate(edges, seeds, "circle").collect()}
    b = 0.85 * got["a"]
    assert got["b"] == pytest.approx(b, rel=1e-5) and got["c"] == pytest.approx(0.85 * 0.75 * b, rel=1e-5)
    assert sum(got.values()) == pytest.approx(1, rel=1e-5)
