"""Quality classifier: cumulative-link regression on graded ratings gives each
document an expected grade, and the tail probability of being at or above the
wanted grade selects it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ordinal

#: Keep a document from this probability of reaching the wanted grade.
MIN_PROBABILITY = 0.5
FIT = {"l1": 3.0, "alpha": 0.1}


def grade_quality(docs: DataFrame, ratings: DataFrame, at_least: int = 1, text: str = "text",
                  doc_id: str = "doc_id", grade: str = "grade", min_probability: float = MIN_PROBABILITY,
                  **options) -> DataFrame:
    """``docs`` with quality (expected grade), grade_pred, p_good (probability
    of grade ``at_least`` or above) and selected.

    Null texts and texts without a word are not selected (p_good 0, the
    lowest grade); a model that saw only one grade selects by that grade.  Of
    grades that are equally probable the lowest is predicted.  Input columns
    called like a result are replaced, and expected_grade and
    tail_probabilities are left out.
    """
    model = ordinal.fit(docs, ratings, "shapes", text, doc_id, grade, **(FIT | options))
    rated = ordinal.predict(docs, model, text=text)
    above = [k for k, g in enumerate(model.grades) if g >= at_least]
    if not above:
        tail = F.lit(0.0)
    elif above[0] == 0:
        tail = F.lit(1.0)
    else:
        tail = F.try_element_at("tail_probabilities", F.lit(above[0]))
    blank = ~F.coalesce(F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return (rated.withColumn("p_good", F.when(blank, 0.0).otherwise(tail))
            .withColumn("selected", F.col("p_good") >= min_probability)
            .withColumn("quality", F.when(blank, float(model.grades[0])).otherwise(F.col("expected_grade")))
            .withColumn("grade_pred", F.when(blank, model.grades[0]).otherwise(F.col("grade_pred")))
            .drop("tail_probabilities", "expected_grade"))
