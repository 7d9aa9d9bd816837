"""Toxicity: subword bags averaged into a linear softmax."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fold
from ledgerloom.llm.subwords import Model, Settings, fit, score

# A few words make a long text toxic: the step is large and goes on for long, so that
# their entries outweigh a text full of others. Case says nothing.
SETTINGS = Settings(lower=True, contrast=6.0, rate=2.0, epochs=300)
FOLDS, HELD_OUT = 3, 1
FLAGGED = 0.7


def toxicity_model(docs: DataFrame, labels: DataFrame, settings: Settings = SETTINGS) -> Model:
    """A model of ``labels.toxic``, learned outside the held-out fold of ids.

    Unseen spellings share character n-grams with those learned. Null, contradictory
    and ownerless labels teach nothing; with one class or none the model is constant.
    """
    return fit(docs, labels, "toxic", fold(F.col("doc_id"), FOLDS) != HELD_OUT, settings)


def score_toxicity(docs: DataFrame, model: Model, threshold: float = FLAGGED) -> DataFrame:
    """All columns of ``docs`` but ``text``, and ``held_out``, ``score``, ``predicted``.

    Every row is scored over its whole text; a null or empty one has the model's bias.
    Columns of ``docs`` with the new names are replaced. Repeated rows and rows without
    an id are each scored; an empty table gives no rows.
    """
    rows = docs.drop("held_out", "score", "predicted")
    return score(rows, model).withColumns(
        {
            "held_out": fold(F.col("doc_id"), FOLDS) == HELD_OUT,
            "predicted": (F.col("score") >= threshold).cast("int"),
        }
    )
