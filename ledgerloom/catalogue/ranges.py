"""Balanced ranges and checksum trees over the given tables, and their SQL twins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalogue.oracles import ORACLES
from ledgerloom.catalogue.queries import _drifted_orders, query
from ledgerloom.catalogue.standins import table
from ledgerloom.operators import checksum_tree, ranges

SLICES = 8
REPORT_CUTS = (1_000, 4_000, 9_000, 9_500)


def _evenness(df: DataFrame, column: str) -> DataFrame:
    """Every slice, and whether its rows are within a fifth of an even share."""
    cuts = ranges.quantile_cuts(df, column, SLICES)
    counts = ranges.slice_counts(df, column, cuts)
    share = df.filter(F.col(column).isNotNull()).agg(F.count("*") / SLICES).scalar()
    return counts.select(
        "slice", (F.abs(F.col("row_count") - share) <= 0.2 * share).alias("within_a_fifth")
    )


@query
def balanced_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths of documents, from a word to twenty thousand: even ranges would hold nearly all in one."""
    return _evenness(table(spark, sf_dir, "documents"), "n_chars")


@query
def balanced_cuts_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evenness(table(spark, sf_dir, "lineitem").withColumn("key", F.md5(F.col("l_orderkey").cast("string"))), "key")


@query
def balanced_slices_of_hot_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of seven values in sixteen slices: each row in one slice, none far too large."""
    lines = table(spark, sf_dir, "lineitem")
    cuts = ranges.quantile_cuts(lines, "l_linenumber", 16)
    rules = ranges.balanced_predicates("l_linenumber", cuts, "l_partkey")
    inside = [F.when(F.expr(rule), 1).otherwise(0) for rule in rules]
    largest = [F.sum(hit) for hit in inside]
    return lines.agg(
        F.sum(reduce(lambda a, b: a + b, inside)).alias("rows_in_slices"),
        (F.greatest(*largest) <= 1.5 * F.count("*") / 16).alias("even"),
    )


@query
def range_checksum_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as ``row_diff``; ranges that differ are divided again and again."""
    orders = table(spark, sf_dir, "orders")
    return checksum_tree.range_checksum_diff(
        orders, _drifted_orders(orders), ["o_orderkey"], leaves=256, small_enough=2_000
    )


@query
def range_checksum_diff_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A handful of lines changed in a few stretches of the key."""
    lines = table(spark, sf_dir, "lineitem")
    changed = F.col("l_orderkey").between(700, 720) | (F.col("l_orderkey") == 11_000)
    target = lines.withColumn(
        "l_returnflag", F.when(changed, F.lit("X")).otherwise(F.col("l_returnflag"))
    )
    return checksum_tree.range_checksum_diff(
        lines, target, ["l_orderkey", "l_linenumber"], small_enough=1_000
    )


@query
def range_checksum_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    target = orders.filter("o_orderkey <> 4200").withColumn(
        "o_orderstatus",
        F.when(F.col("o_orderkey") == 9_100, F.lit("Z")).otherwise(F.col("o_orderstatus")),
    )
    return checksum_tree.range_report(orders, target, ["o_orderkey"], REPORT_CUTS)


_ALL_EVEN = f"SELECT CAST(unnest(range({SLICES})) AS INTEGER) AS slice, TRUE AS within_a_fifth"
ORACLES["balanced_cuts"] = ORACLES["balanced_cuts_of_text"] = _ALL_EVEN
ORACLES["balanced_slices_of_hot_values"] = (
    "SELECT count(*) AS rows_in_slices, TRUE AS even FROM lineitem"
)
ORACLES["range_checksum_diff"] = ORACLES["row_diff"]
ORACLES["range_checksum_diff_few"] = """
    SELECT l_orderkey, l_linenumber, count(*) AS source_rows, count(*) AS target_rows,
        'CHANGED' AS status FROM lineitem
    WHERE l_orderkey BETWEEN 700 AND 720 OR l_orderkey = 11000 GROUP BY 1, 2"""
_RANGE = " + ".join(f"CASE WHEN o_orderkey >= {c} THEN 1 ELSE 0 END" for c in REPORT_CUTS)
ORACLES["range_checksum_report"] = f"""
    SELECT CAST({_RANGE} AS INTEGER) AS range_number,
        CASE {_RANGE} {' '.join(f'WHEN {i + 1} THEN {c}::BIGINT' for i, c in enumerate(REPORT_CUTS))} END
            AS lowest_key,
        count(*) AS source_rows, count(*) FILTER (WHERE o_orderkey <> 4200) AS target_rows,
        CASE WHEN bool_or(o_orderkey IN (4200, 9100)) THEN 'CHANGED' ELSE 'MATCHED' END AS status
    FROM orders GROUP BY 1, 2"""
