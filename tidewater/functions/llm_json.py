"""Validation and normalisation of model answers.

Answers are parsed into Spark's VARIANT type and every type guard of the
reference (``isinstance(x, str)``, ``isinstance(x, list)``, truthiness, ...)
becomes a test on ``schema_of_variant``.  All of it stays in the JVM.

``try_parse_json`` accepts trailing text after a complete value and rejects
repeated object keys and NaN, where Python's ``json.loads`` does the opposite.
Rows where that can matter, and only those, are read by ``json.loads`` itself
in one Arrow-batched UDF.
"""

from __future__ import annotations

import json
import math
import sys

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .strings import bind_columns, col_, let, py_strip, truthy_str

# ---- fixed values (must equal the reference's behaviour) -------------------
MIN_CONFIDENCE = 0.35
SCORE_SUMMARY, SCORE_FLAG, SCORE_PEOPLE, SCORE_COMPANIES, SCORE_COUNTRY = 0.35, 0.15, 0.2, 0.2, 0.1
SCORE_SUMMARY_MIN_CHARS = 40
RELEVANCE_LEVELS = ["High", "Medium", "Low"]
DEFAULT_RELEVANCE = "Low"
DEFAULT_ROLE = "Mentioned"
# -----------------------------------------------------------------------------

#: From the first opening to the last closing brace.
SPAN = r"(?s)\{.*\}"

_NUMERIC = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE", "DECIMAL")

PERSON_T = ("struct<full_name:string,primary_title:string,primary_company:string,"
            "lead_relevance:string,notes:string>")
COMPANY_T = "struct<name:string,sector:string,country:string,notes:string>"


def vfield(v: Column, key: str) -> Column:
    """Member ``key`` of a VARIANT object as VARIANT (NULL when absent)."""
    return F.variant_get(v, f"$.{key}", "variant")


def vtype(v: Column) -> Column:
    """'STRING', 'BOOLEAN', 'BIGINT', 'ARRAY<..>', 'OBJECT<..>', 'VOID' or NULL."""
    return F.schema_of_variant(v)


def is_str(v: Column) -> Column:
    return F.coalesce(vtype(v) == "STRING", F.lit(False))


def is_bool(v: Column) -> Column:
    return F.coalesce(vtype(v) == "BOOLEAN", F.lit(False))


def is_list(v: Column) -> Column:
    """JSON array?  A shallow cast (schema_of_variant would walk the whole value)."""
    return F.try_variant_get(v, "$", "array<variant>").isNotNull()


def is_obj(v: Column) -> Column:
    """JSON object?  A shallow cast, as for is_list."""
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def as_str(v: Column) -> Column:
    """The string value when the member is a JSON string, else NULL."""
    return F.when(is_str(v), F.variant_get(v, "$", "string"))


def truthy(v: Column) -> Column:
    """Python ``bool()`` of a decoded JSON value."""
    return _truthy_typed(v, vtype(v))


def llm_response_content(body) -> Column:
    """``choices[0].message.content`` of a chat-completions body, when a string."""
    v = strict_parse_json(col_(body))
    content = F.try_variant_get(v, "$.choices[0].message.content", "variant")
    return as_str(content)


_JSON_SCALAR = r"^(-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?|true|false|null|\"(?s:.*)\")$"
#: After a closing bracket, JSON goes on with a comma, another one, or ends.
_GOES_ON, _COMMA = r"[}\]]\s*[^\s,}\]]", r"[}\]]\s*,"


def _closes(t: Column) -> Column:
    """The text ends as the value that it begins with would, or is a scalar."""
    return (F.when(t.startswith("{"), t.endswith("}")).when(t.startswith("["), t.endswith("]"))
            .otherwise(t.rlike(_JSON_SCALAR)))


def _finite(x):
    """NaN and infinities, which JSON lacks, as the largest number (a true one)."""
    if isinstance(x, float) and not math.isfinite(x):
        return sys.float_info.max
    if isinstance(x, dict):
        return {k: _finite(v) for k, v in x.items()}
    return [_finite(v) for v in x] if isinstance(x, list) else x


def _reread_one(text: str | None) -> str | None:
    if text is None:
        return None
    try:
        return json.dumps(_finite(json.loads(text)))
    except (ValueError, RecursionError):
        return None


@F.pandas_udf(T.StringType())
def _reread(texts: pd.Series) -> pd.Series:
    """Texts that the fast parser can't be trusted with (null for all others),
    in a form it can be: read strictly, of a repeated key the last value."""
    return texts.map(_reread_one).astype(object)


def _brackets(t: Column) -> Column:
    """The text without its strings, so that all brackets are JSON's own."""
    return F.regexp_replace(F.regexp_replace(t, r"(?s)\\.", ""), '"[^"]*"', "0")


def _count(t: Column, pattern: str) -> Column:
    return F.regexp_count(t, F.lit(pattern))


def doubtful(t: Column, parsed: Column) -> Column:
    """The fast parser refuses the text, though it ends as JSON would, or may
    have stopped before the text's end (a value followed by more than a comma
    or a bracket, brackets that don't pair up, or, where a comma follows a
    bracket, fewer values than the text has): those few rows are read again."""
    bare = _brackets(t)
    opens = r"[{\[]"
    short = bare.rlike(_COMMA) & (_count(bare, opens) != _count(_brackets(F.to_json(parsed)), opens))
    return F.coalesce(_closes(t), F.lit(False)) & F.coalesce(
        parsed.isNull() | (t.startswith('"') & (bare != "0")) | bare.rlike(_GOES_ON) | (_count(bare, opens) != _count(bare, r"[}\]]")) | short, F.lit(True))


def strict_parse_json(text) -> Column:
    """Parse ``text`` as exactly one JSON value (Python ``json.loads``): no
    text after it, of repeated keys the last one, NaN and infinities.

    The fast parser ``try_parse_json`` stops after the first complete value
    and refuses repeated keys and NaN; only texts where that could matter go
    through the slow reader.
    """
    t = py_strip(col_(text))
    fast = F.try_parse_json(t)
    again = doubtful(t, fast)
    slow = F.try_parse_json(_reread(F.when(again, t)))
    return F.when(again, slow).when(_closes(t), fast)


def json_object_from_text(text) -> Column:
    """Strict parse; if that fails, the greedy first-'{'..last-'}' span;
    NULL unless the result is a JSON object."""
    t = col_(text)
    strict = strict_parse_json(t)
    parsed = F.coalesce(strict, strict_parse_json(F.when(strict.isNull(), F.regexp_extract(t, SPAN, 0))))
    return F.when(truthy_str(t) & is_obj(parsed), parsed)


def strip_code_fence(text) -> Column:
    """D9 prefix/suffix handling, in the reference's order, before trimming."""
    return F.regexp_replace(F.regexp_replace(col_(text), r"\A(?:```json)?(?:```)?", ""), r"```\z", "")


def parse_fenced_json(text) -> Column:
    """Strip a markdown fence, then strict-parse; NULL when invalid."""
    return strict_parse_json(strip_code_fence(text))


def briefing_fields(v: Column) -> Column:
    """Typed view of a briefing answer {summary, author, entities, relevance_score}."""
    return F.struct(
        as_str(vfield(v, "summary")).alias("summary"),
        as_str(vfield(v, "author")).alias("author"),
        F.try_variant_get(v, "$.entities", "array<string>").alias("entities"),
        F.try_variant_get(v, "$.relevance_score", "int").alias("relevance_score"))


MEMBERS = ["summary", "mentions_cooling_or_water", "cooling_water_summary", "people", "companies", "country"]
_SCALARS = ["summary", "mentions_cooling_or_water", "cooling_water_summary", "country"]
_STRINGS = ["summary", "cooling_water_summary", "country"]
_LISTS = ["people", "companies"]


def members(v: Column) -> Column:
    """The extraction answer's members as VARIANTs (one struct cast: keys
    matched case-sensitively, absent -> NULL)."""
    return F.try_variant_get(v, "$", _members_t(MEMBERS))


def _inline_view(m: Column):
    """Accessor over a ``members`` struct: ('v'|'t'|'s'|'a', key) -> Column
    (member, type name, string value, array cast), computed in place."""
    def get(kind: str, k: str) -> Column:
        x = m[k]
        if kind == "v":
            return x
        if kind == "t":
            return vtype(x)
        if kind == "s":
            return as_str(x)
        return F.try_variant_get(x, "$", "array<variant>")
    return get


def _score_of(get) -> Column:
    s1 = F.when((get("t", "summary") == "STRING")
                & (F.length(py_strip(get("s", "summary"))) >= SCORE_SUMMARY_MIN_CHARS),
                F.lit(SCORE_SUMMARY)).otherwise(F.lit(0.0))
    s2 = F.when(get("t", "mentions_cooling_or_water") == "BOOLEAN", F.lit(SCORE_FLAG)).otherwise(F.lit(0.0))
    s3 = F.when(get("a", "people").isNotNull(), F.lit(SCORE_PEOPLE)).otherwise(F.lit(0.0))
    s4 = F.when(get("a", "companies").isNotNull(), F.lit(SCORE_COMPANIES)).otherwise(F.lit(0.0))
    s5 = F.when((get("t", "country") == "STRING") & (py_strip(get("s", "country")) != ""),
                F.lit(SCORE_COUNTRY)).otherwise(F.lit(0.0))
    return F.lit(0.0) + s1 + s2 + s3 + s4 + s5


def _truthy_typed(x: Column, t: Column) -> Column:
    numeric = F.lit(False)
    for n in _NUMERIC:
        numeric = numeric | t.startswith(n)
    return (F.when(t == "VOID", F.lit(False))
            .when(t == "BOOLEAN", F.variant_get(x, "$", "boolean"))
            .when(numeric, F.variant_get(x, "$", "double") != 0)
            .when(t == "STRING", F.variant_get(x, "$", "string") != "")
            .otherwise(~F.to_json(x).isin("[]", "{}")))


def _members_t(fields) -> str:
    return "struct<" + ",".join(f"{f}:variant" for f in fields) + ">"


def _string_or_null(x: Column) -> Column:
    return F.when(vtype(x) == "STRING", F.variant_get(x, "$", "string"))


def _object_list(arr: Column, fields: list[str], name: str) -> Column:
    """Elements of a list of VARIANTs as struct<fields: string>, keeping the
    objects whose ``name`` member is a non-blank string.  Each element's
    members are fetched by one struct cast (case-sensitive keys; NULL for a
    non-object, which the name test then drops); a member that is not a
    JSON string becomes NULL."""
    objs = F.transform(arr, lambda x: F.try_variant_get(x, "$", _members_t(fields)))
    strs = F.transform(objs, lambda o: F.struct(*[_string_or_null(o[f]).alias(f) for f in fields]))
    return F.filter(strs, lambda r: F.coalesce(py_strip(r[name]), F.lit("")) != "")


_PERSON_FIELDS = ["full_name", "primary_title", "primary_company", "lead_relevance", "notes"]
_COMPANY_FIELDS = ["name", "sector", "country", "notes"]


def _people_of(arr: Column, fallback: Column) -> Column:
    clean = F.transform(_object_list(arr, _PERSON_FIELDS, "full_name"), lambda r: F.struct(
        py_strip(r["full_name"]).alias("full_name"), r["primary_title"].alias("primary_title"),
        r["primary_company"].alias("primary_company"),
        F.when(r["lead_relevance"].isin(*RELEVANCE_LEVELS), r["lead_relevance"])
         .otherwise(F.lit(DEFAULT_RELEVANCE)).alias("lead_relevance"),
        r["notes"].alias("notes")))
    return F.when(arr.isNotNull(), clean.cast(f"array<{PERSON_T}>")).otherwise(fallback)


def _companies_of(arr: Column, fallback: Column) -> Column:
    clean = F.transform(_object_list(arr, _COMPANY_FIELDS, "name"), lambda r: F.struct(
        py_strip(r["name"]).alias("name"), r["sector"].alias("sector"), r["country"].alias("country"),
        r["notes"].alias("notes")))
    return F.when(arr.isNotNull(), clean.cast(f"array<{COMPANY_T}>")).otherwise(fallback)


def _normalized_of(get, fb: Column) -> Column:
    # a member's string value is non-NULL exactly when the member is a JSON string
    summary = get("s", "summary")
    flag = get("v", "mentions_cooling_or_water")
    return F.struct(
        F.when(F.coalesce(summary, F.lit("")) != "", summary).otherwise(fb["summary"]).alias("summary"),
        F.when(flag.isNotNull(), _truthy_typed(flag, get("t", "mentions_cooling_or_water")))
         .otherwise(fb["mentions_cooling_or_water"]).alias("mentions_cooling_or_water"),
        F.coalesce(get("s", "cooling_water_summary"), fb["cooling_water_summary"]).alias("cooling_water_summary"),
        _people_of(get("a", "people"), fb["people"]).alias("people"),
        _companies_of(get("a", "companies"), fb["companies"]).alias("companies"),
        fb["full_text"].alias("full_text"),
        F.coalesce(get("s", "country"), fb["country"]).alias("country"))


def extraction_score(v: Column) -> Column:
    """Confidence of an extraction answer (summed in the reference's order)."""
    return let(members(v), lambda m: _score_of(_inline_view(m)))


def normalize_people(v: Column, fallback: Column, people: Column | None = None) -> Column:
    """List of person objects with a non-blank name; else the fallback."""
    people = vfield(v, "people") if people is None else people
    return _people_of(F.try_variant_get(people, "$", "array<variant>"), fallback)


def normalize_companies(v: Column, fallback: Column, comps: Column | None = None) -> Column:
    """List of company objects with a non-blank name; else the fallback."""
    comps = vfield(v, "companies") if comps is None else comps
    return _companies_of(F.try_variant_get(comps, "$", "array<variant>"), fallback)


def normalize_extraction(v: Column, fb: Column) -> Column:
    """Typed extraction, each field type-guarded against the fallback."""
    return let(members(v), lambda m: _normalized_of(_inline_view(m), fb))


def extraction_choice(answer_text, fallback: Column) -> Column:
    """P15 with its decision: struct<payload, used_answer>.  The answer is
    used when it is a JSON object scoring at least 0.35; otherwise the
    heuristic payload is kept.  Members are looked up once."""
    def body(m):
        get = _inline_view(m)
        ok = F.coalesce(m["present"] & (_score_of(get) >= MIN_CONFIDENCE), F.lit(False))
        return F.struct(F.when(ok, _normalized_of(get, fallback)).otherwise(fallback).alias("payload"),
                        ok.alias("used_answer"))
    return let(json_object_from_text(answer_text), lambda v: let(
        F.struct(v.isNotNull().alias("present"), *[members(v)[k].alias(k) for k in MEMBERS]), body))


def choose_extraction(answer_text, fallback: Column) -> Column:
    """Heuristic payload unless the answer is a confident JSON object."""
    return extraction_choice(answer_text, fallback)["payload"]


# ---- staged DataFrame forms -------------------------------------------------
# The same operators as successive projections over a DataFrame.  Every
# intermediate value (stripped text, parsed VARIANT, members, their types)
# is its own column, so it is computed once: Catalyst does not merge a
# projection into the next one when that would copy a non-trivial
# expression, and all of it stays inside whole-stage codegen (the
# Column forms above bind values through a higher-order function, which
# is evaluated by the interpreter).

def _tmp(prefix: str, name: str) -> str:
    return f"__{prefix}_{name}"


def with_answer_object(df: DataFrame, text: str, out: str = "v") -> DataFrame:
    """D8 as a DataFrame step: adds ``out``, the answer's JSON object
    (strict parse, else the greedy first-'{'..last-'}' span) or NULL.

    ``out`` is produced by a one-row generator, so a later filter on it is
    not pushed below and evaluated a second time.
    """
    raw = F.col(text)
    names = {k: _tmp(out, k) for k in ("t", "fast", "again", "slow", "strict", "span", "sfast", "sagain", "sslow")}
    c = {k: F.col(v) for k, v in names.items()}

    def parsed(d: DataFrame, t: str, fast: str, again: str, slow: str) -> DataFrame:
        """``t`` parsed fast, and the doubtful texts once more: one UDF call."""
        d = d.withColumn(names[fast], F.try_parse_json(c[t]))
        d = d.withColumn(names[again], doubtful(c[t], c[fast]))
        return d.withColumn(names[slow], _reread(F.when(c[again], c[t])))

    d = parsed(df.withColumn(names["t"], py_strip(raw)), "t", "fast", "again", "slow")
    d = d.withColumn(names["strict"], F.when(c["again"], F.try_parse_json(c["slow"])).when(_closes(c["t"]), c["fast"]))
    # The span starts with '{' and ends with '}'; it is looked for only when the text fails.
    d = d.withColumn(names["span"], F.when(c["strict"].isNull(), F.regexp_extract(raw, SPAN, 0)))
    d = parsed(d, "span", "sfast", "sagain", "sslow")
    v = F.coalesce(c["strict"], F.when(c["sagain"], F.try_parse_json(c["sslow"])).when(_closes(c["span"]), c["sfast"]))
    # an object without a cast: a strict parse is one when the text starts
    # with '{' (a parsed array or scalar is not, and does not fall back); a
    # parsed span always starts with '{'
    is_object = F.coalesce(F.when(c["strict"].isNotNull(), c["t"].startswith("{")), v.isNotNull())
    d = bind_columns(d, **{out: F.when(truthy_str(raw) & is_object, v)})
    return d.drop(*names.values())


def with_answer_members(df: DataFrame, v: str, prefix: str):
    """Adds the extraction members of VARIANT column ``v`` and their typed
    views as columns; returns (DataFrame, accessor, temporary names)."""
    names = {}

    def name(kind, k):
        return names.setdefault((kind, k), _tmp(prefix, f"{kind}_{k}"))

    ms = _tmp(prefix, "members")
    d = df.withColumn(ms, members(F.col(v)))
    d = d.select("*", *[F.col(ms)[k].alias(name("v", k)) for k in MEMBERS]).drop(ms)
    d = d.select("*", *[vtype(F.col(name("v", k))).alias(name("t", k)) for k in _SCALARS],
                 *[F.try_variant_get(F.col(name("v", k)), "$", "array<variant>").alias(name("a", k))
                   for k in _LISTS])
    d = d.select("*", *[F.when(F.col(name("t", k)) == "STRING", F.variant_get(F.col(name("v", k)), "$", "string"))
                        .alias(name("s", k)) for k in _STRINGS])

    def get(kind, k):
        return F.col(names[(kind, k)])
    return d, get, list(names.values())


def with_extraction_score(df: DataFrame, v: str, out: str = "score") -> DataFrame:
    """D10 as a DataFrame step over VARIANT column ``v``."""
    d, get, tmp = with_answer_members(df, v, out)
    return d.withColumn(out, _score_of(get)).drop(*tmp)


def with_normalized_extraction(df: DataFrame, v: str, fallback: str, out: str = "x") -> DataFrame:
    """D11 as a DataFrame step: typed extraction from VARIANT column ``v``."""
    d, get, tmp = with_answer_members(df, v, out)
    return d.withColumn(out, _normalized_of(get, F.col(fallback))).drop(*tmp)


def with_extraction_choice(df: DataFrame, text: str, fallback: str, out: str = "c") -> DataFrame:
    """P15 as a DataFrame step: ``out`` = struct<payload, used_answer>, the
    normalised answer when it is a JSON object scoring at least 0.35, else
    the heuristic payload in column ``fallback``."""
    v, ok = _tmp(out, "obj"), _tmp(out, "ok")
    d = with_answer_object(df, text, v)
    d, get, tmp = with_answer_members(d, v, out)
    d = d.withColumn(ok, F.coalesce(F.col(v).isNotNull() & (_score_of(get) >= MIN_CONFIDENCE), F.lit(False)))
    fb = F.col(fallback)
    d = d.withColumn(out, F.struct(F.when(F.col(ok), _normalized_of(get, fb)).otherwise(fb).alias("payload"),
                                   F.col(ok).alias("used_answer")))
    return d.drop(v, ok, *tmp)


def primary_or_fallback(primary_text, primary_error, fallback_text, fallback_error=None) -> Column:
    """The primary answer unless the primary call errored; an
    unparseable primary answer gives NULL and does not fall back."""
    fe = col_(fallback_error) if fallback_error is not None else F.lit(None).cast("string")
    return parse_fenced_json(F.when(col_(primary_error).isNull(), col_(primary_text)).when(fe.isNull(), col_(fallback_text)))
