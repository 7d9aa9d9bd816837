"""Source-to-target comparison without joins.

Both sides are tagged, put together with a union and aggregated on the key. Rows
of one key are combined on the map side first, so a key that holds a large share
of either table is neither multiplied out nor gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import row_hash
from ledgerloom.operators.checks import FAIL, PASS

MATCHED, CHANGED, MISSING, UNEXPECTED = "MATCHED", "CHANGED", "MISSING", "UNEXPECTED"


def _both_sides(left: DataFrame, right: DataFrame, columns: Sequence[Column | str]) -> DataFrame:
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    return left.select(*columns, one.alias("in_source"), none.alias("in_target")).unionByName(
        right.select(*columns, none.alias("in_source"), one.alias("in_target"))
    )


def _require_same_types(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> None:
    for name in columns:
        a, b = left.schema[name].dataType, right.schema[name].dataType
        if a != b:
            raise TypeError(
                f"{name} is {a.simpleString()} on one side and {b.simpleString()} on the other"
            )


def compared_columns(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str] | None
) -> list[str]:
    """The columns given, or all of the source but the keys; types must agree on both sides."""
    compared = list(columns) if columns is not None else [c for c in source.columns if c not in keys]
    _require_same_types(source, target, [*keys, *compared])
    return compared


def count_comparison(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts before and after a step, with their difference."""
    return (
        _both_sides(before, after, [])
        .agg(
            F.coalesce(F.sum("in_source"), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum("in_target"), F.lit(0)).alias("rows_after"),
        )
        .withColumn("difference", F.col("rows_after") - F.col("rows_before"))
    )


def count_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count per value of the columns."""
    return df.groupBy(*columns).agg(F.count("*").alias("row_count"))


def exact_amount(df: DataFrame, name: str, precision: int = 18, scale: int = 2) -> Column:
    """The column as a number whose sum is exact and independent of row order.

    Decimals and whole numbers stay as they are; a float or text becomes a decimal of
    the given precision and scale, and a value beyond that raises.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, (T.DecimalType, T.IntegralType)):
        return F.col(name)
    return F.col(name).cast(f"decimal({precision},{scale})")


def sum_by(
    df: DataFrame,
    columns: Sequence[str],
    amounts: Sequence[str],
    precision: int = 18,
    scale: int = 2,
) -> DataFrame:
    """Row count and exact sums of amounts per value of the columns."""
    return df.groupBy(*columns).agg(
        F.count("*").alias("row_count"),
        *[F.sum(exact_amount(df, a, precision, scale)).alias(f"sum_{a}") for a in amounts],
    )


def compare_totals(
    source: DataFrame,
    target: DataFrame,
    columns: Sequence[str],
    amounts: Sequence[str],
    precision: int = 18,
    scale: int = 2,
) -> DataFrame:
    """Counts and exact sums of both sides per group, with PASS or FAIL.

    Decimals are compared to their last digit; see :func:`exact_amount` for the rest.
    """
    def exact(side: DataFrame) -> DataFrame:
        kept = [exact_amount(side, a, precision, scale).alias(a) for a in amounts]
        return side.select(*columns, *kept)

    tagged = _both_sides(exact(source), exact(target), [*columns, *amounts])
    sides = (("source", F.col("in_source") == 1), ("target", F.col("in_target") == 1))
    measures = [
        F.sum("in_source").alias("source_rows"),
        F.sum("in_target").alias("target_rows"),
    ]
    equal = F.col("source_rows") == F.col("target_rows")
    for amount in amounts:
        for side, belongs in sides:
            measures.append(F.sum(F.when(belongs, F.col(amount))).alias(f"{side}_{amount}"))
        equal = equal & F.col(f"source_{amount}").eqNullSafe(F.col(f"target_{amount}"))
    totals = tagged.groupBy(*columns).agg(*measures)
    return totals.withColumn("status", F.when(equal, F.lit(PASS)).otherwise(F.lit(FAIL)))


def key_diff(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys found on one side only: MISSING from the target, or UNEXPECTED in it."""
    _require_same_types(source, target, keys)
    sides = (
        _both_sides(source, target, list(keys))
        .groupBy(*keys)
        .agg(F.max("in_source").alias("in_source"), F.max("in_target").alias("in_target"))
    )
    return sides.filter(F.col("in_source") != F.col("in_target")).select(
        *keys, F.when(F.col("in_source") == 1, MISSING).otherwise(UNEXPECTED).alias("status")
    )


def row_diff(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    keep_matched: bool = False,
) -> DataFrame:
    """Per key: rows on each side and MATCHED, CHANGED, MISSING or UNEXPECTED.

    Rows are compared as multisets by a SHA-256 of their length-prefixed values,
    which keeps nulls apart from empty strings. Repeated keys are allowed on both
    sides. Without ``columns``, all columns of the source but the keys are compared.
    """
    compared = compared_columns(source, target, keys, columns)
    content = F.unhex(row_hash(compared, strict=True)) if compared else F.lit("")
    versions = (
        _both_sides(source, target, [*keys, content.alias("content")])
        .groupBy(*keys, "content")
        .agg(F.sum("in_source").alias("in_source"), F.sum("in_target").alias("in_target"))
    )
    per_key = versions.groupBy(*keys).agg(
        F.sum("in_source").alias("source_rows"),
        F.sum("in_target").alias("target_rows"),
        F.count_if(F.col("in_source") != F.col("in_target")).alias("differing"),
    )
    status = (
        F.when(F.col("target_rows") == 0, MISSING)
        .when(F.col("source_rows") == 0, UNEXPECTED)
        .when(F.col("differing") > 0, CHANGED)
        .otherwise(MATCHED)
    )
    result = per_key.select(*keys, "source_rows", "target_rows", status.alias("status"))
    return result if keep_matched else result.filter(F.col("status") != MATCHED)


def link_count_check(expected: DataFrame, links: DataFrame) -> DataFrame:
    """Expected and actual rows per source system and relationship type.

    ``expected`` comes from ``expected_link_counts``; types found only in the
    links are reported too.
    """
    kind = ["SRC_STM_ID", "AR_X_AU_RLTNP_TP_ID"]
    none = F.lit(0).cast("bigint")
    sides = expected.select(
        *kind, F.col("EXPECTED_ROWS").alias("expected"), none.alias("actual")
    ).unionByName(links.groupBy(*kind).agg(none.alias("expected"), F.count("*").alias("actual")))
    totals = sides.groupBy(*kind).agg(
        F.sum("expected").alias("EXPECTED_ROWS"), F.sum("actual").alias("ACTUAL_ROWS")
    )
    equal = F.col("EXPECTED_ROWS") == F.col("ACTUAL_ROWS")
    return totals.withColumn("STATUS", F.when(equal, F.lit(PASS)).otherwise(F.lit(FAIL)))
