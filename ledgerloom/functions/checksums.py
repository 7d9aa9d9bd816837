"""Order-insensitive table checksums.

A checksum is the row count plus the sum of one 64-bit fingerprint per row, taken
modulo 2**64 and read as a signed number. It ignores row order, notices duplicate
rows, and is not proof against deliberate collisions.

Summing the fingerprints as bigint overflows under ANSI within a few thousand
rows. Each is split into four 16-bit lanes, summed as bigint (safe up to 2**47
rows) and put together as a decimal once, on the final row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keys import portable_fingerprint, xxhash_fingerprint

LANE_COUNT = 4
LANE_BITS = 16

# Text forms of a checksum (fixed values).
EMPTY_CHECKSUM = "empty_dataframe"
ROWS_LABEL = "rows:"
SUM_LABEL = "|hash_sum:"

FINGERPRINTS = {"xxhash64": xxhash_fingerprint, "sha256": portable_fingerprint}


def fingerprint(columns: Sequence[str], method: str) -> Column:
    if method not in FINGERPRINTS:
        raise ValueError(f"unknown checksum method {method!r}; use one of {sorted(FINGERPRINTS)}")
    return FINGERPRINTS[method](columns)


def hash_sum_lanes(fingerprint_column: str) -> list[Column]:
    """Aggregates ``lane_0`` .. ``lane_3`` over a bigint column; the top lane keeps the sign."""
    value = F.col(fingerprint_column)
    mask = F.lit((1 << LANE_BITS) - 1).cast("bigint")
    lanes = [
        F.sum(F.shiftright(value, LANE_BITS * i).bitwiseAND(mask)) for i in range(LANE_COUNT - 1)
    ]
    lanes.append(F.sum(F.shiftright(value, LANE_BITS * (LANE_COUNT - 1))))
    return [lane.alias(f"lane_{i}") for i, lane in enumerate(lanes)]


def merge_lanes() -> list[Column]:
    """Second-level aggregates adding up lanes that were summed per group."""
    return [F.sum(f"lane_{i}").alias(f"lane_{i}") for i in range(LANE_COUNT)]


def _wide(value: Column | int) -> Column:
    column = value if isinstance(value, Column) else F.lit(str(value))
    return column.cast("decimal(38,0)")


def signed_sum() -> Column:
    """The lanes as one sum, folded into the signed 64-bit range."""
    total = _wide(0)
    for i in range(LANE_COUNT):
        lane = F.coalesce(F.col(f"lane_{i}"), F.lit(0))
        total = _wide(total + _wide(_wide(lane) * _wide(1 << (LANE_BITS * i))))
    half, full = _wide(1 << 63), _wide(1 << 64)
    return _wide(F.pmod(_wide(total + half), full) - half)


def checksum_text(row_count: Column) -> Column:
    """``rows:N|hash_sum:S`` from a row count and the lane columns."""
    return F.when(row_count == 0, F.lit(EMPTY_CHECKSUM)).otherwise(
        F.concat(
            F.lit(ROWS_LABEL),
            row_count.cast("string"),
            F.lit(SUM_LABEL),
            signed_sum().cast("string"),
        )
    )


def table_checksum(df: DataFrame, columns: Sequence[str], method: str = "xxhash64") -> DataFrame:
    """One row, one column ``CHECKSUM``; a single pass with partial aggregation."""
    hashed = df.select(fingerprint(columns, method).alias("fingerprint"))
    sums = hashed.agg(F.count("*").alias("row_count"), *hash_sum_lanes("fingerprint"))
    return sums.select(checksum_text(F.col("row_count")).alias("CHECKSUM"))
