"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import WORD_PATTERN, ranked_within, written

# Weights of the sources in the order of their names, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, most: int
) -> DataFrame:
    """Each source's ``target``: its share by weight, but at most ``most`` times its size.

    What a full source leaves is shared again by weight until no target is too high.
    That ends at one level per unit of weight. Sources fill up in the order of size per
    weight, and the level is the highest one that its own source can still take. Takes
    one row per source (``source``, ``source_size``); weights follow the names, null last.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy().rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    listed = F.array(*[F.lit(int(w)) for w in weights])
    weighed = sizes.select(
        "source",
        "source_size",
        F.get(listed, ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")).alias("weight"),
    ).withColumn("fill", F.lit(float(most)) * F.col("source_size") / F.col("weight"))
    # With every source before this one full, the level that the rest would reach.
    left = F.lit(share) * F.sum("source_size").over(whole) - F.lit(float(most)) * F.coalesce(
        F.sum("source_size").over(before), F.lit(0)
    )
    rest = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = weighed.withColumn("level", left / rest)
    reached = F.max(F.when(F.col("level") <= F.col("fill"), F.col("level"))).over(whole)
    return levels.withColumn(
        "target",
        F.when(
            F.col("fill") <= F.coalesce(reached, F.col("fill")),
            F.lit(float(most)) * F.col("source_size"),
        ).otherwise(F.col("weight") * reached),
    ).select("source", "source_size", "target")


def start_offset(source: Column) -> Column:
    """A number from 0 to 1 drawn for each source; the same on every run."""
    name = F.coalesce(source, F.lit("\0"))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def mix_sizes(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken`` per document.

    Every document of a source expects target / source size copies. These are summed
    over the source's documents in order of size, one offset is added, and a document
    is taken once per integer the sum passes. Because neighbours in that order are of
    like size, a source's taken words differ from its target by about one document.

    A null text has size 0, a null source is a source of its own, the last one. Rows
    that share id, source and size (repeated rows, null ids) are counted and ranked as
    one run, and the copies of the run are dealt to its rows. Sources without words have
    target 0 and are not taken. No rows give no rows.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    decided = _decided(_runs(sized, ["source", "size", "doc_id"]), ["size", "doc_id"], weights, share, most)
    number = F.col("row_rank") - F.col("rows") + F.col("_number")
    copies = _passed(number, F.col("expected"), F.col("offset")) - _passed(
        number - 1, F.col("expected"), F.col("offset")
    )
    return (
        _times(decided, F.col("rows"), "_number")
        .withColumn("copies", F.least(copies, F.lit(most).cast("long")))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select("doc_id", "source", "size", "source_size", "target", "copies", "taken")
    )


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
) -> DataFrame:
    """The rows of ``docs``, all columns, each as many times as :func:`mix_sizes` takes it.

    Rows with the same id, source and size but other contents are told apart by a digest
    of the whole row. Rows equal in every column cannot be: one of them is written as
    often as all of them together are taken, which is the same rows.
    """
    names = {n: f"_{n}_{uuid.uuid4().hex}" for n in ("digest", "of", "total", "rows", "number", "row")}
    whole = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))
    marked = docs.withColumn(names["digest"], whole)
    sized = marked.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.col(names["digest"]).alias("digest")
    )
    runs = _runs(sized, ["source", "size", "doc_id", "digest"])
    decided = _decided(runs, ["size", "doc_id", "digest"], weights, share, most)
    taken = _passed(F.col("row_rank"), F.col("expected"), F.col("offset")) - _passed(
        F.col("row_rank") - F.col("rows"), F.col("expected"), F.col("offset")
    )
    chosen = written(
        decided.select(
            F.col("digest").alias(names["of"]),
            F.least(taken, F.col("rows") * most).alias(names["total"]),
            F.col("rows").alias(names["rows"]),
        ).filter(F.col(names["total"]) > 0),
        "mixing-chosen",
    )
    same = F.col(names["digest"]) == F.col(names["of"])
    single = marked.join(chosen.filter(F.col(names["rows"]) == 1), same)
    # A row repeated many times is one per task before it moves.
    columns = [F.col(f"`{c}`") for c in docs.columns]
    repeated = chosen.filter(F.col(names["rows"]) > 1)
    one = (
        marked.join(repeated.select(names["of"]), same, "left_semi")
        .groupBy(names["digest"])
        .agg(F.first(F.struct(*columns)).alias(names["row"]))
        .join(repeated, same)
    )
    kept = single.select(*columns, names["total"]).unionByName(
        one.select(f"{names['row']}.*", names["total"])
    )
    return _times(kept, F.col(names["total"]), names["number"]).select(*columns)


def _runs(sized: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows counted by all of ``keys``, written for the looks at them."""
    return written(sized.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")), "mixing-runs")


def _passed(rank: Column, expected: Column, offset: Column) -> Column:
    """Whole numbers that the sum has passed after ``rank`` rows."""
    return F.floor(rank * expected + offset)


def _times(df: DataFrame, times: Column, number: str) -> DataFrame:
    """Every row ``times`` times, with ``number`` from 1; made in blocks, so none is long."""
    block = "_block_" + uuid.uuid4().hex
    size = F.lit(1 << 16).cast("long")
    one = F.lit(1).cast("long")
    blocks = df.withColumn(block, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((times - 1) / size))))
    first = F.col(block) * size
    rows = F.sequence(first + one, F.least(first + size, times))
    return blocks.withColumn(number, F.explode(rows)).drop(block)


def _decided(
    runs: DataFrame, order: Sequence[str], weights: Sequence[int], share: float, most: int
) -> DataFrame:
    """Every run with the number of its last row, and what a row of its source expects."""
    if not weights or min(weights) <= 0 or not 0 <= share <= most:
        raise ValueError("weights must be positive, and the share between 0 and the most copies")
    ranked = ranked_within(runs, "source", order, "mixing-ranks", rows="rows")
    sizes = runs.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    targets = written(source_targets(sizes, weights, share, most), "mixing-targets")
    targets = targets.withColumnRenamed("source", "_of_source")
    expected = F.when(
        F.col("source_size") > 0, F.col("target") / F.col("source_size")
    ).otherwise(F.lit(0.0))
    return (
        ranked.join(targets, F.col("source").eqNullSafe(F.col("_of_source")))
        .withColumn("expected", expected)
        .withColumn("offset", start_offset(F.col("source")))
        .drop("_of_source")
    )
