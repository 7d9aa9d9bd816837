"""Small tables that hold what every operator must bear."""

import os

from pyspark.sql import functions as F

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SMALL = "/root/testdata/sf0.001"

WORDS = "the quick brown fox jumps over a lazy dog and runs away from every river bank".split()
LONG = " ".join(f"{WORDS[i % 15]}{i % 97}" for i in range(30_000))

ODD_DOCS = [
    (1, None, "en", "s1"),
    (2, "", "en", "s1"),
    (3, " \n\t ", None, None),
    (4, "one", "en", "s2"),
    (5, " ".join(WORDS), "en", "s2"),
    (5, " ".join(WORDS), "en", "s2"),
    (6, " ".join(WORDS), None, None),
    (None, " ".join(WORDS), "en", "s1"),
    (None, None, None, None),
    (7, LONG, "en", "s1"),
    (8, "12 34 !!", "de", None),
    (9, "ünï cödé \U0001f600 <|endoftext|> text", "de", "s1"),
]
DOC_SCHEMA = "doc_id long, text string, lang string, source string"
# Names the operators use inside.
CLASHING = (
    "size", "score", "n", "a", "b", "row", "copies", "row_rank", "_copy", "_size", "node",
    "root", "component", "length", "offset", "held_out", "predicted", "at", "n_chars",
)


def odd_docs(spark):
    docs = spark.createDataFrame(ODD_DOCS, DOC_SCHEMA).repartition(3)
    return docs.withColumns({name: F.lit("x") for name in CLASHING})


def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
