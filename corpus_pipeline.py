"""From raw documents to packed training sequences, a written table per stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import jaccard, langid, mixing, packing, quality
from ledgerloom.llm.common import released, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts, learned from the labels of ``docs``."""
    model = quality.quality_model(docs, table(spark, sf_dir, "labels"))
    return _where(docs, lambda d: quality.score_quality(d, model), F.col("predicted") == 1)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learned from ``docs``; what no language's model fits goes."""
    models = langid.fit_languages(docs)
    return _where(docs, lambda d: langid.predict(d, models), F.col("accepted"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Repeated rows of that document are one. A row without an id goes by a number drawn
    from its text, above all ids, so it stays only where no document of its group has one.
    """
    unnamed = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(docs["text"]), 2)
    name = F.coalesce(docs["doc_id"], unnamed)
    found = jaccard.near_duplicates(docs.select(name.alias("doc_id"), "text"))
    keepers = found.filter(F.col("doc_id") == F.col("component_id")).select(
        F.col("doc_id").alias("_kept")
    )
    kept = docs.join(keepers, name == keepers["_kept"], "left_semi")
    return kept.dropDuplicates(["doc_id", "text"])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, and every copy the mix takes of it, cut and placed in sequences."""
    return packing.pack(spark, docs)


def _where(
    docs: DataFrame, judged: Callable[[DataFrame], DataFrame], condition: Column
) -> DataFrame:
    """Rows of ``docs`` that ``judged`` accepts; the row rides along, so nothing is joined."""
    row = F.struct(*docs.columns).alias("row")
    return judged(docs.select("doc_id", row)).filter(condition).select("row.*")


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("mixing", mixed),
    ("packing", packed),
]

# Trained models and a tokenizer decide the rows: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written down before the next reads it.

    Null and empty texts have no language and go with the second stage, nulls in other
    columns stay. No documents give no rows. Models are taken back after their stage.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with released():
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
