"""Ranges of a column that hold about as many rows each.

Cut points come from one pass over one column. Numbers, dates and timestamps go through
a mergeable quantile sketch; texts, which the sketch does not take, through a sample of
rows of a fixed size. A value is placed among the cuts by binary search in a built-in
expression, so that thousands of ranges cost a dozen comparisons a row.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Sequence
from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A sketch's rank error is a share of this size of a slice.
SKETCH_ERROR = 0.02
# Rows sampled per slice where no sketch can be used; the error is their square root.
SAMPLE_PER_SLICE = 400
# The range of nulls, which lie before all values.
NULL_RANGE = -1


def quantile_cuts(df: DataFrame, column: str, slices: int, seed: int = 7) -> list[Any]:
    """``slices`` - 1 ascending cut points between slices of about equal row counts.

    Nulls are left out. A value that fills several slices stands several times, which
    tells callers that it is hot. An empty column has no cuts.
    """
    if slices < 1:
        raise ValueError("slices must be at least 1")
    kind = df.schema[column].dataType
    if slices == 1:
        return []
    if isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        shares = [i / slices for i in range(1, slices)]
        accuracy = int(slices / SKETCH_ERROR)
        found = F.percentile_approx(column, shares, accuracy)
        if isinstance(kind, T.TimestampType):
            # As the session's clock shows it, which is how its text is read back.
            found = found.cast("array<timestamp_ntz>")
        return list(df.agg(found.alias("cuts")).first()[0] or [])
    wanted = SAMPLE_PER_SLICE * slices
    # Each task keeps its `wanted` smallest draws, and the smallest of all of them remain.
    sampled = (
        df.filter(F.col(column).isNotNull())
        .select(F.col(column).alias("value"), F.rand(seed).alias("draw"))
        .orderBy("draw")
        .limit(wanted)
    )
    values = sorted(r["value"] for r in sampled.select("value").collect())
    return [values[len(values) * i // slices] for i in range(1, slices)] if values else []


def distinct_cuts(cuts: Sequence[Any]) -> list[Any]:
    return sorted(set(cuts))


def cuts_column(cuts: Sequence[Any], kind: T.DataType) -> Column:
    """The cuts as one constant array, however many they are."""
    texts = json.dumps([_exact_text(c) for c in cuts])
    return F.from_json(F.lit(texts), T.ArrayType(T.StringType())).cast(T.ArrayType(kind))


def _exact_text(value: Any) -> str:
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, float):
        return repr(value)
    return value.isoformat() if isinstance(value, date) else str(value)


def with_range(df: DataFrame, column: str, cuts: Sequence[Any], name: str) -> DataFrame:
    """``df`` with the number of its range: how many of the distinct cuts are not above it.

    Range 0 lies before the first cut, and nulls have :data:`NULL_RANGE`. The search is one
    expression that loops over its steps, so filters on the number stay small wherever the
    optimizer moves them.
    """
    listed = distinct_cuts(cuts)
    value = F.col(column)
    if not listed:
        return df.withColumn(name, F.when(value.isNull(), NULL_RANGE).otherwise(0))
    array = cuts_column(listed, df.schema[column].dataType)
    steps = [1 << i for i in reversed(range(len(listed).bit_length()))]

    def further(found: Column, step: Column) -> Column:
        inside = found + step <= len(listed)
        passed = inside & (F.get(array, found + step - 1) <= value)
        return found + F.when(passed, step).otherwise(0)

    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), further)
    return df.withColumn(name, F.when(value.isNull(), NULL_RANGE).otherwise(found))


def range_filter(
    column: str, kind: T.DataType, cuts: Sequence[Any], wanted: Sequence[int], most: int = 64
) -> Column:
    """A filter on ranges by their bounds, in a form that scans can prune files with.

    Ranges that touch are one. Beyond ``most`` stretches, those closest to one another by
    range number are taken together, so the filter may let more rows through but never
    fewer: filter by range number as well for exactness.
    """
    listed = distinct_cuts(cuts)
    stretches = _stretches(sorted(r for r in set(wanted) if r != NULL_RANGE), most)
    value = F.col(column)
    hit = value.isNull() if NULL_RANGE in wanted else F.lit(False)
    for first, last in stretches:
        inside = value.isNotNull()
        if first > 0:
            inside = value >= F.lit(_exact_text(listed[first - 1])).cast(kind)
        if last < len(listed):
            inside = inside & (value < F.lit(_exact_text(listed[last])).cast(kind))
        hit = hit | inside
    return hit


def _stretches(numbers: Sequence[int], most: int) -> list[tuple[int, int]]:
    if not numbers:
        return []
    gaps = sorted(
        (b - a for a, b in zip(numbers, numbers[1:], strict=False) if b - a > 1), reverse=True
    )
    allowed = gaps[most - 1] if len(gaps) >= most else 1
    out = [[numbers[0], numbers[0]]]
    for a, b in zip(numbers, numbers[1:], strict=False):
        if b - a > allowed:
            out.append([b, b])
        else:
            out[-1][1] = b
    return [(a, b) for a, b in out]


def slice_counts(df: DataFrame, column: str, cuts: Sequence[Any]) -> DataFrame:
    """Rows per range, one pass: how even the cuts are."""
    return (
        with_range(df.select(column), column, cuts, "slice")
        .groupBy("slice")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def sql_literal(value: int | float | Decimal | str | date) -> str:
    """A value as SQL text that common databases read alike."""
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return repr(value) if isinstance(value, float) else str(value)


def balanced_predicates(
    column: str, cuts: Sequence[Any], spread_by: str | None = None
) -> list[str]:
    """SQL predicates of even slices, for a source that reads one slice per predicate.

    ``cuts`` are quantiles as :func:`quantile_cuts` gives them. A value that stands several
    times among them fills slices by itself and no range can divide it: it gets slices of
    its own, one per time it stands, by the remainder of ``spread_by``, a whole-number SQL
    expression, or a single one without that. Predicates are disjoint and cover all rows;
    nulls are in the first.
    """
    times = Counter(cuts)
    listed = distinct_cuts(cuts)
    if not listed:
        return ["1 = 1"]
    hot = [c for c in listed if times[c] > 1]
    texts = [sql_literal(c) for c in listed]
    slices = [f"{column} < {texts[0]} OR {column} IS NULL"]
    for i, (cut, low) in enumerate(zip(listed, texts, strict=True)):
        sign = ">" if cut in hot else ">="
        upper = f" AND {column} < {texts[i + 1]}" if i + 1 < len(texts) else ""
        slices.append(f"{column} {sign} {low}{upper}")
        if cut in hot and spread_by:
            parts = times[cut]
            remainder = f"ABS(MOD({spread_by}, {parts}))"
            slices.append(f"{column} = {low} AND ({remainder} = 0 OR ({spread_by}) IS NULL)")
            slices += [f"{column} = {low} AND {remainder} = {p}" for p in range(1, parts)]
        elif cut in hot:
            slices.append(f"{column} = {low}")
    return slices
