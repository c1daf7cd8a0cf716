"""Secret scan: candidate strings, judged by a random forest.

Candidates are all runs of twelve or more key characters that have a digit, and
all values assigned to a credential name, however many a word holds (minified
JSON, CSV, query strings).  The forest sees a candidate's
length, character classes and transitions between them, how much of it
dictionary words cover (words that occur on their own anywhere in the corpus),
path and address marks, and the words before it; it is trained on labelled
findings and removes false positives.

Everything runs as DataFrame operations and Spark ML.  Fitting takes at most
MAX_TRAIN distinct findings (by their features) per label, first by a hash of them.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import bind_columns
from .storage import drop_table, pick, write_table

# The characters of keys, names that credentials are assigned to,
# and the openings of well-known key formats.
KEY_CHARS = r"[A-Za-z0-9+/=_.@-]"
CREDENTIALS = (r"(?:token|secret|passw(?:or)?d|passwd|pwd|passphrase|api[_-]?key|access[_-]?key|private[_-]?key"
               r"|auth[_-]?key|credentials?|bearer|authorization)")
KNOWN_FORMATS = (r"^(?:AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[abprs]-[A-Za-z0-9-]{10,}$"
                 r"|^sk-[A-Za-z0-9_-]{20,}$|^AIza[A-Za-z0-9_-]{35}$|^eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+$")
ASSIGN = r"(?:=>|:=|[:=])"
LONG_RUN = rf"(?<!{KEY_CHARS})(?=[A-Za-z+/=_.@-]*[0-9]){KEY_CHARS}{{12,}}"
#: A credential name and its assignment, wherever they stand in a word; also in escaped JSON.
#: The loops take characters of one class and never give them back, so that no word, however long and
#: repetitive, needs deep recursion or rescans; a name goes on for at most NAME_TAIL characters.
NAME_TAIL = 64
NAMED = rf"(?i:{CREDENTIALS})[\w\"'\\-]{{0,{NAME_TAIL}}}+"
#: In a text: a run of key characters with a digit, seen once from its start; or an assignment.
IN_TEXT = rf"{LONG_RUN}|{NAMED}\s*{ASSIGN}\s*\S{{6,}}"
NAME_ENDS = rf"{NAMED}{ASSIGN}$"
NAME = rf"{NAMED}$"
#: Where the next assignment of a list, query string or object starts.
SEPARATOR = r"[&,;|)}\]]"
NEXT_NAME = rf"(?<!{SEPARATOR}){SEPARATOR}++\\*+[\"']?+[\w.%$-]++\\*+[\"']?+{ASSIGN}"
OPEN = r"(?:[(\[{<]*\\*[\"'])?"
#: Up to the closing quote; without quotes, up to a quote, the next assignment or the word's end.
VALUE = rf"(?<=\")[^\s\"]++|(?<=')[^\s']++|(?<![\"'])[^\s\"']+?(?=\\*[\"']|$|{NEXT_NAME})"
#: The value is only looked at, so that names inside it are found as well.
NAME_VALUE = rf"{NAMED}{ASSIGN}{OPEN}(?=({VALUE}))"
NAME_OF_VALUE = rf"{NAMED}{ASSIGN}(?={OPEN}[^\s\"']{{6,}})"
#: The value of a word that stands after a name and its assignment.
FIRST_VALUE = (rf"^[\\\"'(\[{{<]*((?<=\")[^\s\"]+|(?<=')[^\s']+"
               rf"|(?<![\"'])\S+?(?=[\"']?{NEXT_NAME}|$))")
#: A plain name before the value inside a run, as in a query string.
PLAIN_NAME = rf"^[A-Za-z_.-][A-Za-z_.=-]*=(?={KEY_CHARS}{{12}})"
SPACE = r"[\x20\x09-\x0D]"
LONE_ASSIGN = rf"^{ASSIGN}$"
ADDRESS = r"^[^@]+@[A-Za-z0-9.-]+\.[A-Za-z]+$|^\d{1,3}(?:\.\d{1,3}){3}$|://"
NUMBER = r"^[0-9][0-9.,:+/-]*$"

MIN_WORD, MAX_WORD = 4, 20
#: Letter runs of candidates, of at most MAX_WORD characters each, that are broadcast to the corpus's words.
MAX_BROADCAST_RUNS = 500_000
MAX_TRAIN = 10_000
MIN_PROBABILITY = 0.5
TREES, DEPTH, SEED = 40, 6, 7
REDACTED = "[SECRET]"

FEATURES = ["length", "digits", "upper", "lower", "symbols", "transitions", "distinct", "hex", "dictionary",
            "slashes", "dots", "at_sign", "after_name", "after_assign", "quoted", "plain_before"]


def _share(value: Column, kept: str) -> Column:
    """Share of characters outside ``kept`` (a character class with ^)."""
    return F.length(F.regexp_replace(value, kept, "")) / F.greatest(F.length(value), F.lit(1))


def candidates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text_hash, word_no, word, before, before2, part, value,
    assigned): one row per candidate occurrence, word_no counted from 0, and
    part from 0 among the candidates of a word (assigned values first)."""
    rows = pick(docs, doc_id=doc_id, text=text).where(F.col("text").rlike(IN_TEXT))
    # Words once per row, as the output of a generator, so that the lambdas below don't split again.
    rows = bind_columns(rows.withColumn("text_hash", F.xxhash64("text")),
                        words=F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")).drop("text")
    near = lambda i, k: F.when(i >= k, F.get("words", i - k)).otherwise(F.lit(""))
    seen = F.transform("words", lambda w, i: F.struct(
        i.cast("int").alias("word_no"), w.alias("word"), near(i, 1).alias("before"), near(i, 2).alias("before2")))
    named = lambda x: (x["before"].rlike(NAME_ENDS) | (x["before"].rlike(LONE_ASSIGN) & x["before2"].rlike(NAME)))
    wanted = F.filter(seen, lambda x: x["word"].rlike(LONG_RUN) | x["word"].rlike(NAME_VALUE)
                      | named(x))
    found = rows.select("doc_id", "text_hash", F.inline(wanted))
    x = {c: F.col(c) for c in ("word", "before", "before2")}
    first = F.regexp_replace(F.regexp_extract("word", FIRST_VALUE, 1), r"[\"')\]}>,;!?.\\]+$", "")
    inside = F.transform(F.regexp_extract_all("word", F.lit(NAME_VALUE), F.lit(1)),
                         lambda v: F.regexp_replace(v, r"\\+$", ""))
    no_end = lambda v: F.regexp_replace(v, r"[.=-]+$", "")
    # Every run of the word, without the names that its values are assigned to.
    runs = F.transform(F.regexp_extract_all(F.regexp_replace("word", NAME_OF_VALUE, " "), F.lit(LONG_RUN), F.lit(0)),
                       lambda r: no_end(F.regexp_replace(r, PLAIN_NAME, "")))
    parts = bind_columns(found, __assigned__=F.concat(
        F.when(named(x), F.array(first)).otherwise(F.array().cast("array<string>")), inside), __runs__=runs)
    part = lambda v, assigned: F.struct(v.alias("value"), assigned.alias("assigned"))
    others = F.filter("__runs__", lambda r: ~F.exists("__assigned__", lambda v: no_end(v) == r))
    return (parts.select(*found.columns, F.posexplode(F.concat(
        F.transform("__assigned__", lambda v: part(v, F.lit(True))),
        F.transform(others, lambda r: part(r, F.exists("__assigned__", lambda v: F.contains(v, r))))))
        .alias("part", "__part__")).select(*found.columns, "part", "__part__.*")
        .where((F.length("value") >= 12) | (F.col("assigned") & (F.length("value") >= 6))))


def _letter_runs(value: Column) -> Column:
    return F.filter(F.split(F.lower(value), r"[^a-z]+"),
                    lambda r: (F.length(r) >= MIN_WORD) & (F.length(r) <= MAX_WORD))


def with_features(found: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """``found`` with the columns of FEATURES."""
    values = found.select("value").distinct().withColumn("run", F.explode(_letter_runs(F.col("value"))))
    # Written, so that their number is known: few runs go to the words, not all words to the runs.
    runs = write_table(values.select("run").distinct(), "secret-runs")
    if runs.count() <= MAX_BROADCAST_RUNS:
        runs = F.broadcast(runs)
    alone = rf"(?<!\S)([a-z]{{{MIN_WORD},{MAX_WORD}}})(?=[.,;:!?]*(?:\s|$))"
    words = pick(docs, text=text).select(
        F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(alone), F.lit(1)))).alias("run"))
    known = words.join(runs, "run", "left_semi").distinct()
    covered = (values.join(known, "run").groupBy("value").agg(F.sum(F.length("run")).alias("covered")))
    v = F.col("value")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[0-9]+", "0"), "[a-z]+", "a"), "[A-Z]+", "A")
    number = {
        "length": F.length(v), "digits": _share(v, "[^0-9]"), "upper": _share(v, "[^A-Z]"),
        "lower": _share(v, "[^a-z]"), "symbols": _share(v, "[A-Za-z0-9]"),
        "transitions": (F.length(classes) - 1) / F.greatest(F.length(v), F.lit(1)),
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / F.least(F.length(v), F.lit(64)),
        "hex": v.rlike(r"^[0-9a-fA-F]+$"), "dictionary": F.coalesce("covered", F.lit(0)) / F.length(v),
        "slashes": F.length(v) - F.length(F.replace(v, F.lit("/"))),
        "dots": F.length(v) - F.length(F.replace(v, F.lit("."))), "at_sign": v.contains("@"),
        "after_name": (F.col("assigned") | F.col("before").rlike(NAME) | F.col("before2").rlike(NAME)
                       | F.col("before").rlike(NAME_ENDS)),
        "after_assign": F.col("assigned") | F.col("before").rlike(rf"{ASSIGN}$"), "quoted": F.col("word").rlike(r"[\"']"),
        "plain_before": F.col("before").rlike(r"^[\p{L}]+[.,]?$"),
    }
    return found.join(covered, "value", "left").select(
        *found.columns, *[number[n].cast("double").alias(n) for n in FEATURES])


def weak_labels(found: DataFrame) -> DataFrame:
    """``found`` with ``label``: 1 for known key formats and long values without
    dictionary words that are assigned to a credential name; 0 for numbers,
    addresses and values half of dictionary words that are not assigned; null
    for the rest, which the forest decides."""
    v, free = F.col("value"), ~F.col("assigned")
    sure = v.rlike(KNOWN_FORMATS) | (F.col("assigned") & (F.col("length") >= 16) & (F.col("dictionary") < 0.3))
    not_it = free & (v.rlike(NUMBER) | v.rlike(ADDRESS) | (F.col("dictionary") >= 0.5))
    return found.withColumn("label", F.when(sure, 1.0).when(not_it, 0.0))


def scan(docs: DataFrame, labelled: DataFrame | None = None, text: str = "text", doc_id: str = "doc_id",
         min_probability: float = MIN_PROBABILITY, max_train: int = MAX_TRAIN) -> DataFrame:
    """All candidates with ``probability`` and ``is_secret``.

    ``labelled``: findings of ``with_features`` with a ``label`` of 0 or 1;
    by default those of ``docs`` under ``weak_labels``.  Without both labels to
    learn from, a candidate's weak label decides, and where that is null, whether
    it is assigned to a credential name.  A value of a known key format is a
    secret whatever the forest says.  Null and blank texts hold no
    candidates; repeated documents and words give repeated rows.
    """
    every = write_table(candidates(docs, text, doc_id), "secret-words")
    found = write_table(weak_labels(with_features(every, docs, text)), "secret-candidates")
    drop_table(every)
    train = found if labelled is None else labelled
    # Equal findings teach once, so that copies of one don't fill a label's sample.
    train = train.select("label", *FEATURES).where("label is not null").distinct()
    parts = [train.where(F.col("label") == y).orderBy(F.xxhash64(*FEATURES), *FEATURES).limit(max_train)
             for y in (0.0, 1.0)]
    # At most 2 x max_train rows, in one partition and a fixed order, so that reruns grow the same trees.
    sample = write_table(parts[0].unionByName(parts[1]).coalesce(1).sortWithinPartitions("label", *FEATURES),
                         "secret-train").coalesce(1)
    if sample.select("label").distinct().count() < 2:
        p = F.coalesce("label", F.col("assigned").cast("double"))
        return found.withColumn("probability", p).withColumn("is_secret", p >= min_probability)
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH,
                                    seed=SEED).fit(assemble.transform(sample))
    judged = forest.transform(assemble.transform(found))
    known = F.col("value").rlike(KNOWN_FORMATS)
    return (judged.withColumn("probability", F.when(known, 1.0).otherwise(
        F.round(vector_to_array("probability")[1], 6)))
            .withColumn("is_secret", F.col("probability") >= min_probability)
            .drop("features", "rawPrediction", "prediction"))


def redact(docs: DataFrame, findings: DataFrame, text: str = "text", doc_id: str = "doc_id",
           mark: str = REDACTED) -> DataFrame:
    """``docs`` with every confirmed secret replaced by ``mark`` in the words
    where it was found, and nowhere else; of two secrets in one word the longer
    one goes first.  Columns, also clashing ones, and all rows stay."""
    value = F.struct("word_no", "value")
    hits = (findings.where("is_secret").groupBy(F.col("doc_id").alias("__id__"), F.col("text_hash").alias("__hash__"))
            .agg(F.collect_set(value).alias("__found__")))
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__id__")) & (F.xxhash64(F.col(f"`{text}`")) == F.col("__hash__"))
    # Pieces are a word and the space behind it; a piece of space alone comes first if the text starts with one.
    pieces = F.split(F.col(f"`{text}`"), rf"(?<={SPACE})(?!{SPACE})")
    first = F.when(F.col(f"`{text}`").rlike(rf"^{SPACE}"), 1).otherwise(0)
    # One step per word with a finding, in order: what lies before it is taken as it is.
    words = F.array_sort(F.array_distinct(F.transform("__found__", lambda f: f["word_no"])))
    longest_first = F.array_sort("__found__", lambda a, b: F.length(b["value"]) - F.length(a["value"]))
    of_word = lambda n: F.filter("__longest__", lambda f: f["word_no"] == n)
    marked = lambda n: F.aggregate(of_word(n), F.get("__pieces__", n + F.col("__first__")),
                                   lambda t, f: F.replace(t, f["value"], F.lit(mark)))
    before = lambda i, n: F.slice("__pieces__", F.when(i == 0, 1).otherwise(
        F.get("__words__", i - 1) + F.col("__first__") + 2),
        n + F.col("__first__") - F.when(i == 0, 0).otherwise(F.get("__words__", i - 1) + F.col("__first__") + 1))
    parts = F.transform("__words__", lambda n, i: F.concat(F.array_join(before(i, n), ""), marked(n)))
    last = F.element_at("__words__", -1) + F.col("__first__") + 2
    rest = F.array_join(F.slice("__pieces__", last, F.size("__pieces__")), "")
    found = docs.join(hits, same, "left")
    whole = found.where("__found__ is null").select(*[F.col(f"`{c}`") for c in docs.columns])
    cut = bind_columns(found.where("__found__ is not null"), __pieces__=pieces, __first__=first, __words__=words,
                       __longest__=longest_first)
    return whole.unionAll(cut.select(*[
        F.concat(F.array_join(parts, ""), rest).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]))
