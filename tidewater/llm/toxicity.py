"""Toxicity severity by cumulative-link regression: sparse text features, one
weight vector shared across the ordered severity thresholds, expected severity
as the score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ordinal

#: Flag a document from this probability of any severity above the lowest.
MIN_PROBABILITY = 0.5
#: Toxic words are few: a strong penalty leaves only them with weights.
FIT = {"l1": 10.0, "alpha": 1.0}


def rate_severity(docs: DataFrame, severities: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  grade: str = "grade", min_probability: float = MIN_PROBABILITY, **options) -> DataFrame:
    """``docs`` with severity (expected grade), severity_pred, p_toxic and toxic.

    ``severities`` holds (doc_id, grade), 0 the harmless grade.  Null and empty
    texts carry no features and are never flagged; without two grades to
    learn from, nothing is flagged.  Of grades that are equally probable the
    lowest is predicted.  Input columns called like a result are replaced, and
    expected_grade, grade_pred and tail_probabilities are left out.
    """
    model = ordinal.fit(docs, severities, "words", text, doc_id, grade, **(FIT | options))
    rated = ordinal.predict(docs, model, text=text)
    empty = F.coalesce(F.length(F.trim(F.col(f"`{text}`"))), F.lit(0)) == 0
    p = F.when(empty, 0.0).otherwise(F.coalesce(F.try_element_at("tail_probabilities", F.lit(1)), F.lit(0.0)))
    return (rated.withColumn("p_toxic", p).withColumn("toxic", F.col("p_toxic") >= min_probability)
            .withColumn("severity", F.when(empty, float(model.grades[0])).otherwise(F.col("expected_grade")))
            .withColumn("severity_pred", F.when(empty, model.grades[0]).otherwise(F.col("grade_pred")))
            .drop("tail_probabilities", "expected_grade", "grade_pred"))
