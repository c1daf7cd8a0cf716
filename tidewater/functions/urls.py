"""URL canonicalisation (P1) and percent-encoding helpers.

Everything is a native column expression: the URL is split with one
RFC-3986-shaped regex, the query string is handled as an array with
higher-order functions, and re-encoding uses ``url_encode`` with the two
characters on which Java's encoder and Python's ``quote_plus`` disagree
patched back.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import col_, py_strip

# ---- fixed values (must equal the reference's behaviour) -------------------
# Query keys dropped exactly (compared case-insensitively) and by prefix.
DROP_QUERY_KEYS = ["gclid", "fbclid", "mc_cid", "mc_eid", "ref", "ref_src"]
DROP_QUERY_PREFIXES = ["utm_"]
# Python urllib scheme tables: schemes whose URLs carry ";params" in the
# last path segment, and schemes that get "//" re-added before an empty
# authority when the URL is rebuilt.
USES_PARAMS = ["", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp",
               "rtsp", "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel"]
USES_NETLOC = ["", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais",
               "file", "mms", "https", "shttp", "snews", "prospero", "rtsp",
               "rtsps", "rtspu", "rsync", "svn", "svn+ssh", "sftp", "nfs", "git",
               "git+ssh", "ws", "wss", "itms-services"]
# -----------------------------------------------------------------------------

_SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_PARTS_RE = r"(?s)^(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#.*)?$"
#: URLs of which only the path's end can change: lower-case, plain characters, no parameters, query or fragment.
_PLAIN_RE = r"^https?://[a-z0-9.:_-]+(/[!-~&&[^?#;]]*)?$"


def percent_decode(c) -> Column:
    """Python ``unquote`` of an already '+'-free or form-encoded string.

    ``url_decode`` rejects a '%' not followed by two hex digits; Python keeps
    it literally, so such a '%' is first escaped to '%25'.  '+' becomes a
    space (``parse_qsl`` semantics).
    """
    return F.try_url_decode(F.regexp_replace(col_(c), r"%(?![0-9A-Fa-f]{2})", "%25"))


def quote_plus(c) -> Column:
    """Python ``urllib.parse.quote_plus`` (safe='')."""
    return F.replace(F.replace(F.url_encode(col_(c)), F.lit("*"), F.lit("%2A")),
                     F.lit("%7E"), F.lit("~"))


def quote_path(c) -> Column:
    """Python ``urllib.parse.quote`` (safe='/'): space as %20, '/' kept."""
    enc = quote_plus(c)
    return F.replace(F.replace(enc, F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))


def _in(c: Column, values: list[str]) -> Column:
    return c.isin(*values)


def _query_string(query: Column) -> Column:
    pairs = F.filter(F.split(query, "&"),
                     lambda x: (F.instr(x, "=") > 0) & (F.length(x) > F.instr(x, "=")))
    decoded = F.transform(pairs, lambda x: F.struct(
        percent_decode(F.substring_index(x, "=", 1)).alias("k"),
        percent_decode(F.regexp_replace(x, "^[^=]*=", "")).alias("v")))
    kept = F.filter(decoded, lambda p: ~(F.lower(p["k"]).isin(*DROP_QUERY_KEYS))
                    & ~F.lower(p["k"]).startswith(DROP_QUERY_PREFIXES[0]))
    return F.array_join(F.transform(F.array_sort(kept),
                                    lambda p: F.concat(quote_plus(p["k"]), F.lit("="), quote_plus(p["v"]))),
                        "&")


def with_canonical_url(df, src: str = "url", out: str = "canonical_url"):
    """P1 as a DataFrame transform: adds ``out`` = canonical form of ``src``.

    Uses the single-expression form: staging the parts as separate
    projections lets predicate pushdown substitute them into filters on
    ``out`` and the expression tree grows multiplicatively.
    """
    return df.withColumn(out, canonical_url(F.col(src)))


def canonical_url(c) -> Column:
    """P1 as a column expression (for use inside other expressions).

    Stages are bound once each with single-element ``transform`` lambdas,
    so no sub-expression is repeated in the tree.  Plain URLs, where only the
    path's end can change, take a short way without lambdas.
    """
    raw = col_(c)

    def let(value: Column, body):
        return F.element_at(F.transform(F.array(value), body), 1)

    s0 = F.regexp_replace(F.regexp_replace(py_strip(raw), r"^[\x{00}-\x{20}]+", ""), r"[\t\r\n]", "")

    def with_s(s):
        has = s.rlike(_SCHEME_RE)
        scheme = F.when(has, F.lower(F.regexp_extract(s, _SCHEME_RE, 1))).otherwise(F.lit(""))
        rest = F.when(has, F.regexp_replace(s, _SCHEME_RE, "")).otherwise(s)
        return let(F.struct(scheme.alias("scheme"), rest.alias("rest")), with_parts)

    def with_parts(p):
        rest = p["rest"]
        path0 = F.regexp_extract(rest, _PARTS_RE, 3)
        path1 = F.when(_in(p["scheme"], USES_PARAMS), F.regexp_replace(path0, r";[^/]*$", "")).otherwise(path0)
        return let(F.struct(p["scheme"].alias("scheme"),
                            F.lower(F.regexp_extract(rest, _PARTS_RE, 2)).alias("netloc"),
                            path1.alias("path"),
                            F.regexp_extract(rest, _PARTS_RE, 5).alias("query")), with_path)

    def with_path(p):
        path = F.when(p["path"] == "", F.lit("/")).otherwise(p["path"])
        return let(path, lambda path: _rebuild(p, path))

    def _rebuild(p, path):
        path = F.when((path != "/") & path.endswith("/"), F.left(path, F.length(path) - 1)).otherwise(path)
        scheme = F.when(p["scheme"] == "", F.lit("https")).otherwise(p["scheme"])
        return let(F.struct(scheme.alias("scheme"), p["netloc"].alias("netloc"), path.alias("path"),
                            F.when(p["query"] == "", F.lit("")).otherwise(_query_string(p["query"])).alias("qs")),
                   _final)

    def _final(p):
        scheme, netloc, path, qs = p["scheme"], p["netloc"], p["path"], p["qs"]
        body = (F.when(netloc != "", F.concat(F.lit("//"), netloc, path))
                .when(path.startswith("//"), F.concat(F.lit("//"), path))
                .when(_in(scheme, USES_NETLOC) & path.startswith("/"), F.concat(F.lit("//"), path))
                .otherwise(path))
        return F.concat(scheme, F.lit(":"), body, F.when(qs != "", F.concat(F.lit("?"), qs)).otherwise(F.lit("")))

    plain = (F.when(raw.rlike(r"^[a-z]+://[^/]+$"), F.concat(raw, F.lit("/")))
             .when(raw.endswith("/") & ~raw.rlike(r"^[a-z]+://[^/]+/$"), F.left(raw, F.length(raw) - 1)).otherwise(raw))
    return (F.when(raw.isNull() | (raw == ""), raw).when(raw.rlike(_PLAIN_RE), plain)
            .otherwise(let(s0, with_s)))
