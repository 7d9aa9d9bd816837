"""Hash identities built from native Spark expressions.

Everything here returns a ``Column``, so hashing stays inside whole-stage
codegen and no Python worker is started.

A hash covers the *string cast* of a value, so the type of an id is part of its
identity: bigint ``123`` and decimal(38,10) ``123`` give different keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separator between the components of a row hash (fixed value).
ROW_HASH_SEPARATOR = "||"


def surrogate_key(prefix: str, value: Column) -> Column:
    """SHA-256 of ``prefix`` followed by ``value``, as 64 hex characters.

    A null value hashes like an empty one, so the key is never null. There is no
    delimiter between the two parts; ``LinkSpec`` checks that the prefixes used
    together cannot run into one another.
    """
    return F.sha2(F.concat(F.lit(prefix), F.coalesce(value.cast("string"), F.lit(""))), 256)


def composite_value(columns: Sequence[str], joiner: str = ".", suffix: str = "") -> Column:
    """Join the columns into one string; a null in any of them makes it null."""
    parts: list[Column] = []
    for position, name in enumerate(columns):
        if position:
            parts.append(F.lit(joiner))
        parts.append(F.col(name).cast("string"))
    if suffix:
        parts.append(F.lit(suffix))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def _blank_if_null(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def length_prefixed(name: str) -> Column:
    """The value as text after its length, and null as a mark of its own."""
    text = F.col(name).cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_hash(columns: Sequence[str], algorithm: str = "sha2", strict: bool = False) -> Column:
    """Hash of several columns, hex encoded.

    The default form joins the values with ``||`` and treats null as an empty
    string, so ``("a||b", "")`` equals ``("a", "b||")``. ``strict=True`` writes
    each value with its length instead, which keeps such rows, and nulls, apart.
    """
    if not columns:
        raise ValueError("row_hash needs at least one column")
    if strict:
        text = F.concat(*[length_prefixed(c) for c in columns])
    else:
        text = F.concat_ws(ROW_HASH_SEPARATOR, *[_blank_if_null(c) for c in columns])
    if algorithm == "sha2":
        return F.sha2(text, 256)
    if algorithm == "md5":
        return F.md5(text)
    raise ValueError(f"unknown hash algorithm {algorithm!r}; use 'sha2' or 'md5'")


def with_row_hash(
    df: DataFrame,
    columns: Sequence[str],
    output: str = "HASH_VALUE",
    algorithm: str = "sha2",
    strict: bool = False,
) -> DataFrame:
    """Add :func:`row_hash` of ``columns`` under the name ``output``."""
    return df.withColumn(output, row_hash(columns, algorithm, strict))


def xxhash_fingerprint(columns: Sequence[str]) -> Column:
    """64-bit xxHash of the string forms of the columns, nulls as empty strings."""
    return F.xxhash64(*[_blank_if_null(c) for c in columns])


def portable_fingerprint(columns: Sequence[str]) -> Column:
    """First 60 bits of the SHA-256 row hash, a number other SQL engines can compute too."""
    return F.conv(F.substring(row_hash(columns), 1, 15), 16, 10).cast("bigint")
