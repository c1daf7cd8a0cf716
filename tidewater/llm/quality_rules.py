"""Quality rules as weak supervision.

Rules look at statistics of a whole text and vote good (1), vote poor (-1) or
abstain (0).  Expectation-maximisation over the vote patterns estimates how
accurate each rule is and how common good documents are; a document is kept
when its posterior probability of being good is at least ``min_probability``,
instead of when all rules pass.

Only DataFrame operations: votes are aggregated to at most 3^rules patterns,
one row holds them as a list, and the rounds are one expression over that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import bind_columns, let
from .storage import write_table

SYMBOLS = r"[^#*$%&|<>]"
WORD_BREAK = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
ROUNDS = 30
TOLERANCE = 1e-6
MIN_PROBABILITY = 0.5
#: Start and bounds of a rule's accuracy on good and on poor documents, and of the share of good ones.  A rule for
#: one fault is silent on others, so few poor documents need trigger it, but bounds are set so that good ones seldom do.
OF_GOOD, OF_POOR, PRIOR = 0.99, 0.4, 20.0
LEAST_ACCURACY, MOST_ACCURACY, LEAST_RATIO = 0.99, 0.999, 10.0
GOOD, LEAST_GOOD, MOST_GOOD = 0.8, 0.05, 0.99


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_upper_words, n_distinct_words and n_lines (long).

    A null or blank text has 0 of each; a line without a word is no line; a
    text with fewer than three words has no window.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.array_remove(F.split(body, WORD_BREAK), "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # Generators keep the arrays as values: lambdas below read them, they don't split again.
    step = bind_columns(docs, __words__=words, __lines__=lines)
    n = F.size("__words__")
    windows = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1))),
        lambda i: F.struct(F.xxhash64(*[F.get("__words__", i + (k - 1)) for k in range(WINDOW)]).alias("h"),
                           i.alias("at"))))
    step = bind_columns(step, __windows__=F.sort_array(F.coalesce(
        windows, F.array().cast("array<struct<h:bigint,at:int>>"))))
    # Windows equal to a neighbour in hash order, back in text order.
    same = lambda x, i, k: F.coalesce(x["h"] == F.get("__windows__", i + k)["h"], F.lit(False))
    again = F.filter("__windows__", lambda x, i: same(x, i, -1) | same(x, i, 1))
    step = bind_columns(step, __again__=F.sort_array(F.transform(again, lambda x: x["at"])))
    # Each covers its words up to the start of the next one.
    covered = F.aggregate("__again__", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
                          lambda acc, at: F.struct(
                              (at + WINDOW).alias("end"),
                              (acc["n"] + (at + WINDOW - F.greatest(at, acc["end"]))).alias("n")))["n"]
    count = lambda x: x.cast("long")
    return step.select(
        *[F.col(f"`{c}`") for c in docs.columns], count(n).alias("n_words"),
        count(F.length(F.concat_ws("", "__words__"))).alias("word_chars"),
        count(F.length(F.regexp_replace(body, SYMBOLS, ""))).alias("n_symbols"),
        count(F.size("__lines__") - F.size(F.array_distinct("__lines__"))).alias("n_dup_lines"),
        count(covered).alias("n_repeat_words"),
        count(F.size(F.filter("__words__", lambda w: (w == F.upper(w)) & (w != F.lower(w)) & (F.length(w) > 2))))
        .alias("n_upper_words"),
        count(F.size(F.array_distinct("__words__"))).alias("n_distinct_words"),
        count(F.size("__lines__")).alias("n_lines"))


def _rule(share: Column, good_below: float, poor_above: float) -> Column:
    """Vote by a share: good below one bound, poor above another, else abstain."""
    return F.when(F.col("n_words") == 0, -1).when(share > poor_above, -1).when(share <= good_below, 1).otherwise(0)


def rules() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    mean = F.col("word_chars") / words
    return {
        "symbols": _rule(F.col("n_symbols") / words, 0.02, 0.15),
        "dup_lines": _rule(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), 0.05, 0.3),
        "repeats": _rule(F.col("n_repeat_words") / words, 0.1, 0.3),
        "upper": _rule(F.col("n_upper_words") / words, 0.03, 0.2),
        "word_length": F.when((mean < 2.5) | (mean > 15), -1).when((mean >= 3.5) & (mean <= 10), 1).otherwise(0),
        "distinct": F.when(F.col("n_distinct_words") / words < 0.2, -1)
        .when((F.col("n_distinct_words") / words > 0.4) | (F.col("n_words") > 2000), 1).otherwise(0),
    }


Accuracy = dict[str, tuple[float, float]]


def _log_odds(votes: list[Column], of_good: list, of_poor: list, good) -> Column:
    """Log odds of being good, given the votes."""
    total = F.log(good / (1 - good))
    for vote, g, p in zip(votes, of_good, of_poor):
        total = total + F.when(vote == 1, F.log(g / (1 - p))).when(vote == -1, F.log((1 - g) / p)).otherwise(0.0)
    return total


def _probability(votes: list[Column], of_good: list, of_poor: list, good) -> Column:
    return 1 / (1 + F.exp(-_log_odds(votes, of_good, of_poor, good)))


def _bounded(x: Column, least, most) -> Column:
    return F.least(F.lit(most), F.greatest(F.lit(least), x))


def _next(state: Column, patterns: Column, rules_: range) -> Column:
    """One round: the state (good, of_good, of_poor, change) after ``state``."""
    of_good, of_poor = ([state[kind][i] for i in rules_] for kind in ("of_good", "of_poor"))
    weighted = F.transform(patterns, lambda x: F.struct(
        x["votes"].alias("votes"), x["n"].cast("double").alias("n"),
        (x["n"] * _probability([x["votes"][i] for i in rules_], of_good, of_poor, state["good"])).alias("good")))

    def update(w: Column) -> Column:
        def total(value, vote=None, i=0) -> Column:
            return F.aggregate(w, F.lit(0.0), lambda acc, x: acc + (
                value(x) if vote is None else F.when(x["votes"][i] == vote, value(x)).otherwise(0.0)))

        good_of, poor_of = lambda x: x["good"], lambda x: x["n"] - x["good"]
        new_good, new_poor = [], []
        for i in rules_:
            # PRIOR votes at the starting accuracies, for rules that seldom vote.
            right, wrong = total(good_of, 1, i), total(good_of, -1, i)
            new_good.append(_bounded((right + PRIOR * OF_GOOD) / (right + wrong + PRIOR), LEAST_ACCURACY, MOST_ACCURACY))
            right, wrong = total(poor_of, -1, i), total(poor_of, 1, i)
            new_poor.append((right + PRIOR * OF_POOR) / (right + wrong + PRIOR))
        share = _bounded(total(good_of) / total(lambda x: x["n"]), LEAST_GOOD, MOST_GOOD)
        return F.struct(share.alias("good"), F.array(*new_good).alias("of_good"), F.array(*new_poor).alias("poor"))

    def close(new: Column) -> Column:
        poor = F.zip_with(new["poor"], new["of_good"], lambda p, g: _bounded(p, LEAST_RATIO * (1 - g), MOST_ACCURACY))
        return let(poor, lambda of_poor_: F.struct(
            new["good"].alias("good"), new["of_good"].alias("of_good"), of_poor_.alias("of_poor"),
            F.greatest(F.abs(new["good"] - state["good"]), *[
                F.abs(x[i] - state[kind][i]) for kind, x in (("of_good", new["of_good"]), ("of_poor", of_poor_))
                for i in rules_]).alias("change")))

    return let(weighted, lambda w: let(update(w), close))


def estimate(patterns: DataFrame, names: list[str], rounds: int = ROUNDS) -> tuple[Accuracy, float]:
    """Each rule's accuracy on good and on poor documents (when it votes), and
    the share of good documents, by expectation-maximisation over ``patterns``
    (one column per rule, and n).

    The patterns, at most 3^rules, become one sorted list in one row, and all
    rounds are one expression over it: one job, however many rounds.
    """
    rules_ = range(len(names))
    start = F.struct(F.lit(GOOD).alias("good"), F.array(*[F.lit(OF_GOOD)] * len(names)).alias("of_good"),
                     F.array(*[F.lit(OF_POOR)] * len(names)).alias("of_poor"), F.lit(1.0).alias("change"))
    listed = patterns.agg(F.sort_array(F.collect_list(F.struct(
        F.array(*[F.col(r).cast("int") for r in names]).alias("votes"), F.col("n")))).alias("patterns"))
    last = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda state, _: F.when(
        state["change"] < TOLERANCE, state).otherwise(_next(state, F.col("patterns"), rules_)))
    got = listed.select(F.when(F.size("patterns") == 0, start).otherwise(last).alias("state")).first()["state"]
    return dict(zip(names, zip(got["of_good"], got["of_poor"]))), got["good"]


def judge(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
          min_probability: float = MIN_PROBABILITY) -> DataFrame:
    """One row per document with the ``keep`` columns, the statistics, a vote
    per rule, base_failed (too short, or mostly repeated words), p_good and
    kept.

    Accuracies are estimated over the documents that pass the base.  A null or blank text fails it.  Repeated rows are judged alike.
    An empty table gives no rows.
    """
    made = rules()
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text__"))
    stats = with_statistics(source, "__text__").drop("__text__")
    voted = write_table(stats.select("*", *[v.alias(f"vote_{r}") for r, v in made.items()]), "quality-votes")
    names = [f"vote_{r}" for r in made]
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    accuracy, good = estimate(voted.where(~failed).groupBy(*names).agg(F.count("*").alias("n")), names)
    of_good, of_poor = ([F.lit(accuracy[r][k]) for r in names] for k in (0, 1))
    p = _probability([F.col(r) for r in names], of_good, of_poor, F.lit(good))
    return (voted.withColumn("base_failed", failed).withColumn("p_good", F.round(p, 6))
            .withColumn("kept", ~failed & (p >= min_probability)))
