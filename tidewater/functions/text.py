"""Text heuristics as column expressions.

HTML is handled without a DOM: noise elements are removed by regex, tags
are turned into control-character markers, and the text nodes are
recovered with ``split``/``transform``/``filter``.  Two steps leave the JVM:
entity decoding (the standard library's ``html.unescape``), which only sees
paragraph text, and a scan with a tag stack of pages whose noise elements are
nested or not closed.  Both are plain row functions: their rows travel a hundred
at a time, where an Arrow batch holds ten thousand pages, and each task's worker
holds a batch, its strings and their decoded copies at once.
"""

from __future__ import annotations

import html as _html
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .strings import PY_WS, col_, let, py_rstrip, py_strip, truthy_str

# ---- fixed values (must equal the reference's behaviour) -------------------
# Elements removed before paragraph extraction.
NOISE_TAGS = ["script", "style", "noscript", "header", "footer", "nav", "aside"]
# Elements whose content is not text for get_text().
NON_TEXT_TAGS = ["script", "style", "template"]
# Topic keywords (whole words, matched on lower-cased text).
TOPIC_KEYWORDS = ["cooling", "cooled", "chiller", "chillers", "water", "wastewater",
                  "aquifer", "evaporation", "evaporative", "consumption", "reuse",
                  "reclaimed water"]
# Company-like name: 1-4 capitalised tokens followed by one of these suffixes.
COMPANY_SUFFIXES = ["Inc", "Corp", "Corporation", "LLC", "Ltd", "Group", "Technologies",
                    "Technology", "Energy", "Utilities"]
MIN_PARAGRAPH_CHARS = 40      # a paragraph is kept when longer than this
MAX_PARAGRAPHS = 30
SUMMARY_SENTENCES = 3
SUMMARY_MAX_CHARS = 1200
TITLE_FALLBACK_CHARS = 500
KEYWORD_SENTENCES = 2
SOURCE_SECTOR, SOURCE_NOTES = "Media", "Article source outlet."
INFERRED_SECTOR, INFERRED_NOTES = "Unknown", "Inferred from article text."
# -----------------------------------------------------------------------------

P_OPEN, P_CLOSE, NODE = "\u0001", "\u0002", "\u0003"
_SENTENCE_SPLIT = rf"(?U)(?<=[.!?]){PY_WS}+"


def keyword_pattern(keywords: list[str]) -> str:
    return r"(?U)\b(" + "|".join(keywords) + r")\b"


def company_pattern(suffixes: list[str] = COMPANY_SUFFIXES) -> str:
    tok = r"[A-Z][A-Za-z0-9&.\-]+"
    return rf"(?U)\b({tok}(?:{PY_WS}+{tok}){{0,3}}{PY_WS}+(?:{'|'.join(suffixes)}))\b"


@F.udf(T.StringType(), useArrow=False)
def html_unescape(s: str | None) -> str | None:
    """HTML character references -> text (html.parser's decoding)."""
    return s if s is None or "&" not in s else _html.unescape(s)


def drop_pattern(tags: list[str]) -> str:
    """One regex for comments and the elements ``tags``, scanned left to
    right: whichever starts first is removed whole, as a parser nests them
    (a '<script>' inside a comment stays comment text, a '<!--' inside a
    script is script text).  No back-references, so RE2 runs it unchanged."""
    return "(?is)" + "|".join(["<!--.*?-->"] + [rf"<{t}\b[^>]*>.*?</{t}\s*>" for t in tags])


def _drop_elements(h: Column, tags: list[str]) -> Column:
    """Comments and ``tags`` elements -> NODE, in one pass over the page."""
    return F.regexp_replace(h, drop_pattern(tags), NODE)


def _nodes_to_text(region: Column) -> Column:
    """Text nodes separated by NODE -> stripped, non-empty, joined by ' '."""
    return F.array_join(F.filter(F.transform(F.split(region, NODE), lambda x: py_strip(x)),
                                 lambda x: x != ""), " ")


def html_to_text(c) -> Column:
    """``get_text(" ", strip=True)`` of an HTML fragment."""
    h = _drop_elements(col_(c), NON_TEXT_TAGS)
    h = F.regexp_replace(h, r"(?s)<[^>]*>", NODE)
    return _nodes_to_text(html_unescape(h))


def meta_description(h: Column) -> Column:
    """Content of the first <meta name="description">, or NULL."""
    name_ok = r"""(?=[^>]*\bname\s*=\s*["']?description["'\s/>])"""
    base = r"(?is)<meta\b" + name_ok + r"""[^>]*?\bcontent\s*=\s*"""
    dq = F.regexp_extract(h, base + r'"([^"]*)"', 1)
    sq = F.regexp_extract(h, base + r"'([^']*)'", 1)
    bare = F.regexp_extract(h, base + r"""([^\s"'>]+)""", 1)
    content = F.when(dq != "", dq).when(sq != "", sq).when(bare != "", bare)
    return content


_META_SEP, _NO_REGIONS = "\u0004", "\u0005"

#: A start or end tag of a noise element, left over where such elements lie in each other or aren't closed.
_NOISE_LEFT = rf"(?i)</?(?:{'|'.join(NOISE_TAGS)})\b"
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
# Elements without content or end tag, and those whose content is no markup.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW_TEXT = {"script", "style"}


def strip_nested_noise(page: str) -> str:
    """``page`` without comments and noise elements, with a stack of the open
    elements: an end tag closes everything opened since its start tag, also a
    noise element without an end tag of its own; an end tag of no open element
    closes nothing; a noise element that nothing closes goes on to the end."""
    out, stack, hidden, at = [], [], 0, 0
    i = 0
    while m := _MARKUP.search(page, i):
        if not hidden:
            out.append(page[at:m.start()])
        at = i = m.end()
        name = (m[2] or "").lower()
        if not name:
            out.append("" if hidden else NODE)  # a comment
        elif m[1]:
            if name in stack:
                was = hidden
                while (closed := stack.pop()) != name:
                    hidden -= closed in NOISE_TAGS
                hidden -= name in NOISE_TAGS
                out.append("" if hidden else NODE if was else m[0])
            elif name not in NOISE_TAGS:
                out.append("" if hidden else m[0])
        else:
            out.append("" if hidden else m[0] if name not in NOISE_TAGS else NODE)
            if name in _VOID or m[3].endswith("/") and name not in NOISE_TAGS:
                continue
            if name in _RAW_TEXT:  # its content holds no tags; skipped as a whole
                end = re.compile(rf"</{name}\s*>", re.I).search(page, i)
                at = i = end.end() if end else len(page)
                continue
            stack.append(name)
            hidden += name in NOISE_TAGS
    if not hidden:
        out.append(page[at:])
    return "".join(out)


@F.udf(T.StringType(), useArrow=False)
def _strip_nested(page: str | None) -> str | None:
    """``strip_nested_noise`` of the few pages that need it (null for all others)."""
    return None if page is None else strip_nested_noise(page)


def _strip_noise(html: Column) -> Column:
    """The page without comments and noise elements: one regex pass, which
    takes each element up to its first end tag; pages where that leaves a tag
    of such an element behind are scanned again with a stack."""
    fast = _drop_elements(html, NOISE_TAGS)
    nested = fast.rlike(_NOISE_LEFT)
    return F.when(nested, _strip_nested(F.when(nested, html))).otherwise(fast)


def _regions(h: Column) -> Column:
    """Raw text of each <p> (up to its end marker), tags turned to NODE."""
    h = F.regexp_replace(h, r"(?i)<p\b[^>]*>", P_OPEN)
    h = F.regexp_replace(h, r"(?i)</(p|article|body)\s*>", P_CLOSE)
    h = F.regexp_replace(h, r"(?s)<[^>]*>", NODE)
    return F.transform(F.slice(F.split(h, P_OPEN), 2, 1 << 30), lambda x: F.substring_index(x, P_CLOSE, 1))


def page_parts(c) -> Column:
    """struct<meta: string, paragraphs: array<string>> of a page.

    The noise-stripped HTML is computed once; meta content and paragraph
    regions travel through a single entity-decoding UDF call, so no regex
    pass over the page is repeated.
    """
    # (inside a UDF argument a nested lambda must not capture an outer lambda
    # variable, or Spark cannot extract the UDF: pass values via a struct)
    def pack(h):
        return let(F.struct(_regions(h).alias("r"), meta_description(h).alias("m")), lambda s: F.concat(
            F.coalesce(s["m"], F.lit("")), F.lit(_META_SEP),
            F.when(F.size(s["r"]) > 0, F.array_join(s["r"], P_OPEN)).otherwise(F.lit(_NO_REGIONS))))
    decoded = html_unescape(let(_strip_noise(col_(c)), pack))

    def unpack(d):
        meta = F.substring_index(d, _META_SEP, 1)
        rest = F.substring(d, F.length(meta) + 2, 1 << 30)
        paras = F.when(rest == _NO_REGIONS, F.array().cast("array<string>")) \
            .otherwise(F.transform(F.split(rest, P_OPEN), _nodes_to_text))
        return F.struct(F.when(meta != "", meta).alias("meta"), paras.alias("paragraphs"))
    return let(decoded, unpack)


def paragraphs(c) -> Column:
    """All <p> texts of a page (noise removed), in document order.

    A paragraph ends at the next <p>, </p>, </article> or </body>.
    """
    return page_parts(c)["paragraphs"]


def page_main_text(c, max_paragraphs: int | None = MAX_PARAGRAPHS,
                   min_chars: int = MIN_PARAGRAPH_CHARS) -> Column:
    """Long paragraphs (first N, or all for None, joined by ' '), else meta description."""
    def body(parts):
        long_ps = F.filter(parts["paragraphs"], lambda p: F.length(p) > min_chars)
        joined = let(long_ps, lambda ps: F.when(F.size(ps) > 0, F.array_join(
            ps if max_paragraphs is None else F.slice(ps, 1, max_paragraphs), " ")))
        return F.coalesce(joined, py_strip(parts["meta"]))
    return let(page_parts(c), body)


def sentences(c) -> Column:
    return F.split(py_strip(col_(c)), _SENTENCE_SPLIT)


def first_sentences(c, n: int = SUMMARY_SENTENCES) -> Column:
    """D3: first n sentences joined by ' '; NULL or '' -> ''."""
    return let(col_(c), lambda t: F.when(
        truthy_str(t), py_strip(F.array_join(F.slice(sentences(t), 1, n), " "))).otherwise(F.lit("")))


def keyword_sentences(c, pattern: str, n: int = KEYWORD_SENTENCES) -> Column:
    """First n sentences whose lower() matches pattern, trimmed; else NULL."""
    def body(t):
        hits = F.slice(F.filter(sentences(t), lambda s: F.lower(s).rlike(pattern)), 1, n)
        return let(hits, lambda h: F.when(truthy_str(t) & (F.size(h) > 0),
                                          F.array_join(F.transform(h, lambda s: py_strip(s)), " ")))
    return let(col_(c), body)


def article_text(title, summary, full_text) -> Column:
    return F.concat_ws(" ", F.coalesce(col_(title), F.lit("")), F.coalesce(col_(summary), F.lit("")),
                       F.coalesce(col_(full_text), F.lit("")))


def topic_flag(title, summary, full_text, keywords: list[str] = TOPIC_KEYWORDS) -> Column:
    """Any whole-word keyword in lower(title + summary + full_text)."""
    return F.lower(article_text(title, summary, full_text)).rlike(keyword_pattern(keywords))


def build_summary(title, summary, full_text) -> Column:
    """Trimmed summary, else 3 sentences; capped at 1200 chars + '...';
    empty result falls back to title[:500]."""
    t = F.coalesce(col_(title), F.lit(""))
    ft = col_(full_text)

    def capped(s):
        return let(F.when(F.length(s) > SUMMARY_MAX_CHARS,
                          F.concat(py_rstrip(F.substring(s, 1, SUMMARY_MAX_CHARS)), F.lit("..."))).otherwise(s),
                   lambda s2: F.when(s2 != "", s2).otherwise(F.substring(t, 1, TITLE_FALLBACK_CHARS)))

    def body(s):
        return let(F.when(s == "", first_sentences(F.when(truthy_str(ft), ft).otherwise(t))).otherwise(s), capped)
    return let(py_strip(F.coalesce(col_(summary), F.lit(""))), body)


def company_like_names(c) -> Column:
    """Distinct company-like names in text order."""
    return let(col_(c), lambda t: F.when(truthy_str(t), F.array_distinct(F.transform(
        F.regexp_extract_all(t, F.lit(company_pattern()), 1), lambda x: py_strip(x))))
        .otherwise(F.array().cast("array<string>")))


COMPANY_T = "struct<name:string,sector:string,country:string,notes:string>"


def company_key(c) -> Column:
    """trim + lower of a name; '' means no key."""
    return F.lower(py_strip(col_(c)))


def source_company(source) -> Column:
    """The outlet as a one-element company list, unless blank/'unknown'."""
    s = col_(source)
    entry = F.struct(s.alias("name"), F.lit(SOURCE_SECTOR).alias("sector"),
                     F.lit(None).cast("string").alias("country"), F.lit(SOURCE_NOTES).alias("notes"))
    return F.when(truthy_str(s) & (F.lower(s) != "unknown"), F.array(entry)) \
        .otherwise(F.array().cast(f"array<{COMPANY_T}>"))


def dedupe_by_key(arr: Column, key_fn) -> Column:
    """Keep the first element per non-empty key, preserving order."""
    def body(a):
        keys = F.transform(a, key_fn)
        return F.filter(a, lambda x, i: (key_fn(x) != "") & (F.array_position(keys, key_fn(x)) == i + 1))
    return let(arr, body)


def heuristic_companies(source, text) -> Column:
    """Outlet + inferred names, deduped on trimmed lower name."""
    inferred = F.transform(company_like_names(text), lambda n: F.struct(
        n.alias("name"), F.lit(INFERRED_SECTOR).alias("sector"),
        F.lit(None).cast("string").alias("country"), F.lit(INFERRED_NOTES).alias("notes")))
    return dedupe_by_key(F.concat(source_company(source), inferred), lambda x: company_key(x["name"]))
