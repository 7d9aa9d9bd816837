"""Comparing two large tables by a tree of checksums over ranges of their key.

Each side is summed up once, range by range; sums of ranges add up to sums of wider
ranges, up to the whole table. From the top down only ranges whose sums differ are
followed, and only rows in the ranges found are read again. Tables that agree move a row
per range and task. A tree can be stored, so a side that did not change is not read at
all, and trees of parts of a table add up to the tree of the whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.checksums import LANE_BITS, LANE_COUNT
from ledgerloom.functions.keys import length_prefixed
from ledgerloom.operators.compare import compared_columns, row_diff
from ledgerloom.operators.ranges import (
    cuts_column,
    distinct_cuts,
    quantile_cuts,
    range_filter,
    with_range,
)

# Ranges of one pass, and how many of them make a range one level up.
LEAVES = 1024
FAN_OUT = 32
# Ranges that differ are divided further while they hold more rows than this.
SMALL_ENOUGH = 5_000_000
# Passes at most over ever fewer rows; what is left then is compared row by row.
MOST_PASSES = 5

# Two independent fingerprints: a difference goes unseen once in 2^128.
SALTS = ("a", "b")
LANES = [f"{salt}{i}" for salt in SALTS for i in range(LANE_COUNT)]


def _lane_sums(columns: Sequence[str]) -> tuple[list[Column], list[Column]]:
    """Fingerprint columns, and the aggregates over them.

    Values are written with their lengths, so null, empty and shifted values differ.
    """
    text = F.concat(*[length_prefixed(c) for c in columns])
    prints = [F.xxhash64(F.lit(salt), text).alias(f"print_{salt}") for salt in SALTS]
    mask = F.lit((1 << LANE_BITS) - 1).cast("bigint")
    sums = []
    for salt in SALTS:
        value = F.col(f"print_{salt}")
        for i in range(LANE_COUNT):
            lane = F.shiftright(value, LANE_BITS * i)
            last = i == LANE_COUNT - 1
            sums.append(F.sum(lane if last else lane.bitwiseAND(mask)).alias(f"{salt}{i}"))
    return prints, sums


def checksum_tree(
    df: DataFrame, keys: Sequence[str], cuts: Sequence[Any], columns: Sequence[str] | None = None
) -> DataFrame:
    """``level``, ``node``, ``row_count`` and lane sums of every range that has rows.

    Level 0 holds the ranges between the cuts of the first key, the next one groups of
    :data:`FAN_OUT` of these, and so on; the last is the whole table. One pass; ranges are
    summed on the map side, so at most a row per range leaves a task.
    """
    compared = list(columns) if columns is not None else [c for c in df.columns if c not in keys]
    prints, sums = _lane_sums([*keys, *compared])
    placed = with_range(df.select(*dict.fromkeys([*keys, *compared])), keys[0], cuts, "tree_node")
    leaves = (
        placed.select("tree_node", *prints)
        .groupBy(F.col("tree_node").alias("node"))
        .agg(F.count(F.lit(1)).alias("row_count"), *sums)
    )
    # Every range also counts for those above it: a handful of rows each, no second pass.
    levels = tree_levels(len(distinct_cuts(cuts)) + 1)
    above = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(level).alias("level"),
                    F.floor(F.col("node") / width).cast("int").alias("node"),
                )
                for level, width in enumerate(levels)
            ]
        )
    ).alias("at")
    nodes = leaves.select(above, "row_count", *LANES).select("at.*", "row_count", *LANES)
    return merge_trees([nodes])


def tree_levels(leaves: int) -> list[int]:
    """How many leaves a node of each level spans, up to the one that spans all.

    Nulls lie before leaf 0, in a node of their own on every level.
    """
    widths = [1]
    while widths[-1] < leaves:
        widths.append(widths[-1] * FAN_OUT)
    return widths


def merge_trees(trees: Sequence[DataFrame]) -> DataFrame:
    """The tree of tables put together, from the trees of each over the same cuts."""
    both = reduce(lambda a, b: a.unionByName(b), trees)
    return both.groupBy("level", "node").agg(
        F.sum("row_count").alias("row_count"), *[F.sum(c).alias(c) for c in LANES]
    )


def differing_leaves(source: DataFrame, target: DataFrame, leaves: int) -> list[tuple[int, int, int]]:
    """``(leaf, rows in source, rows in target)`` of ranges whose sums differ.

    Goes down from the top: on each level only children of nodes that differ are looked
    at, and none if the tops agree. What reaches the driver are ranges, never rows.
    """
    suspects: list[int] | None = None
    found: list[tuple[int, int, int]] = []
    for level in range(len(tree_levels(leaves)) - 1, -1, -1):
        at_level = F.col("level") == level
        if suspects is not None:
            parent = F.floor(F.col("node") / FAN_OUT).cast("int")
            at_level = at_level & parent.isin(suspects)
        found = [tuple(r) for r in _differing_nodes(source.filter(at_level), target.filter(at_level))]
        suspects = [node for node, _, _ in found]
        if not suspects:
            return []
    return found


def _differing_nodes(source: DataFrame, target: DataFrame) -> list:
    none = F.lit(0).cast("bigint")
    measures = ["row_count", *LANES]
    sides = source.select(
        "node", *measures, *[none.alias(f"other_{c}") for c in measures]
    ).unionByName(
        target.select(
            "node", *[none.alias(c) for c in measures], *[F.col(c).alias(f"other_{c}") for c in measures]
        )
    )
    sums = sides.groupBy("node").agg(
        *[F.sum(c).alias(c) for c in measures], *[F.sum(f"other_{c}").alias(f"other_{c}") for c in measures]
    )
    unlike = reduce(lambda a, b: a | b, [F.col(c) != F.col(f"other_{c}") for c in measures])
    return sums.filter(unlike).select("node", "row_count", "other_row_count").orderBy("node").collect()


def rows_of_leaves(df: DataFrame, key: str, cuts: Sequence[Any], leaves: Sequence[int]) -> DataFrame:
    """Rows in the given ranges; the bounds are pushed to the scan, the numbers make it exact."""
    near = df.filter(range_filter(key, df.schema[key].dataType, cuts, leaves))
    placed = with_range(near, key, cuts, "tree_leaf")
    return placed.filter(F.col("tree_leaf").isin(list(leaves))).drop("tree_leaf")


def range_checksum_diff(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    leaves: int = LEAVES,
    small_enough: int = SMALL_ENOUGH,
    passes: list[dict] | None = None,
) -> DataFrame:
    """The same rows as :func:`~ledgerloom.operators.compare.row_diff`, reading far less.

    Key, rows on each side, and CHANGED, MISSING or UNEXPECTED for keys whose rows differ.
    Both sides are read once for cut points (the first key alone) and once for sums. Ranges
    that differ are divided again, reading those ranges only, while they hold more than
    ``small_enough`` rows and division helps; then their rows are compared. It pays where
    tables are sorted or clustered by the first key and differ in few places; where they
    differ everywhere it costs two reads more than ``row_diff``. Jobs run while this is
    called; ``passes`` receives what each found. A key value that holds very many rows is
    one range, whose rows ``row_diff`` combines on the map side.
    """
    compared = compared_columns(source, target, keys, columns)
    wanted = list(dict.fromkeys([*keys, *compared]))
    sides = [side.select(*wanted) for side in (source, target)]
    key, before = keys[0], None
    for _ in range(MOST_PASSES):
        whole = sides[0].select(key).unionByName(sides[1].select(key))
        cuts = distinct_cuts(quantile_cuts(whole, key, leaves))
        trees = [checksum_tree(side, keys, cuts, compared) for side in sides]
        found = differing_leaves(*[_kept(tree) for tree in trees], len(cuts) + 1)
        numbers = [leaf for leaf, _, _ in found]
        rows = sum(max(a, b) for _, a, b in found)
        if passes is not None:
            passes.append({"ranges": len(cuts) + 1, "differing": len(found), "rows": rows})
        sides = [rows_of_leaves(side, key, cuts, numbers) for side in sides]
        if rows <= small_enough or rows == before or len(numbers) > len(cuts) // 2:
            break
        before = rows
    return row_diff(*sides, keys, compared)


def _kept(tree: DataFrame) -> DataFrame:
    """The tree, computed once for all the looks at it: as many rows as it has ranges."""
    rows = [tuple(r) for r in tree.collect()]
    return tree.sparkSession.createDataFrame(rows, tree.schema)


def range_report(
    source: DataFrame, target: DataFrame, keys: Sequence[str], cuts: Sequence[Any],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Per range between the cuts: its lowest key, rows on both sides, and whether sums agree.

    The range of nulls, and the one before the first cut, have no lowest key.
    """
    compared = compared_columns(source, target, keys, columns)
    listed = distinct_cuts(cuts)
    trees = [
        checksum_tree(side, keys, listed, compared).filter("level = 0") for side in (source, target)
    ]
    one, other = trees[0].alias("s"), trees[1].alias("t")
    joined = one.join(other, F.col("s.node") == F.col("t.node"), "full_outer")
    equal = reduce(
        lambda a, b: a & b,
        [F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("row_count", *LANES)],
    )
    lowest = cuts_column(listed, source.schema[keys[0]].dataType)
    node = F.coalesce("s.node", "t.node")
    return joined.select(
        node.alias("range_number"),
        F.when(node > 0, F.get(lowest, node - 1)).alias("lowest_key"),
        F.coalesce("s.row_count", F.lit(0)).alias("source_rows"),
        F.coalesce("t.row_count", F.lit(0)).alias("target_rows"),
        F.when(equal, "MATCHED").otherwise("CHANGED").alias("status"),
    )

