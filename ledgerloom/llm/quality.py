"""Quality classifier: supervised subword embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fold
from ledgerloom.llm.subwords import Model, Settings, fit, score

# Case is kept and repeated words are features of their own: both tell poor text.
SETTINGS = Settings(repeats=True, contrast=6.0, sample_per_class=2000)
FOLDS, HELD_OUT = 5, 0
ACCEPTED = 0.3


def quality_model(docs: DataFrame, labels: DataFrame, settings: Settings = SETTINGS) -> Model:
    """A model of ``labels.quality``, learned outside the held-out fold of ids.

    Labels that are null, contradictory or of no document teach nothing; with one class
    or none the model is constant. Labels of documents with a null id are not used.
    """
    return fit(docs, labels, "quality", fold(F.col("doc_id"), FOLDS) != HELD_OUT, settings)


def score_quality(docs: DataFrame, model: Model, threshold: float = ACCEPTED) -> DataFrame:
    """All columns of ``docs`` but ``text``, and ``held_out``, ``score``, ``predicted``.

    Every row is scored over its whole text. A null or empty text has the average of
    nothing and so the model's bias. Columns of ``docs`` with the new names are replaced.
    The text may also be a field of a struct column ``row``, which is kept whole.
    Repeated rows and rows without an id are each scored; an empty table gives no rows.
    """
    rows = docs.drop("held_out", "score", "predicted")
    return score(rows, model).withColumns(
        {
            "held_out": fold(F.col("doc_id"), FOLDS) == HELD_OUT,
            "predicted": (F.col("score") >= threshold).cast("int"),
        }
    )
