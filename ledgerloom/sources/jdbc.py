"""Reading source databases over JDBC.

A read without slices is one task on one connection, whatever the table's size, and
warns unless that is asked for. Slices should be ranges of an indexed column: evenly
spaced ones (``partition_column``) for an evenly spread column, chosen cut points
(``value_slices``, or balanced ones from ``read_cuts``) for another, or row-id ranges of the source given as predicates.
``even_slices`` cuts on a remainder, which no hot value can unbalance, but no index
serves it: each slice scans the source's whole table, so it is for a source where
scans are cheap and ranges are not to be had.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession

DEFAULT_FETCH_SIZE = 10000
DEFAULT_PARTITIONS = 4


@dataclass(frozen=True)
class JdbcConnection:
    """URL, driver and further Spark JDBC options such as user and password."""

    url: str
    driver: str
    options: Mapping[str, str] = field(default_factory=dict)
    fetch_size: int = DEFAULT_FETCH_SIZE

    def reader_options(self) -> dict[str, str]:
        return {
            **self.options,
            "url": self.url,
            "driver": self.driver,
            "fetchsize": str(self.fetch_size),
        }


def bounds_table(table: str, column: str) -> str:
    """Derived table that finds the bounds inside the source; the alias is needed outside Oracle."""
    return f"(SELECT MIN({column}) AS min_value, MAX({column}) AS max_value FROM {table}) bounds"


def bound_texts(low: Any, high: Any) -> tuple[str, str] | None:
    """Bounds as Spark's options want them, or None if there is nothing to slice."""
    if low is None or high is None:
        return None
    if isinstance(low, datetime):
        return low.isoformat(sep=" "), high.isoformat(sep=" ")
    if isinstance(low, date):
        return low.isoformat(), high.isoformat()
    if isinstance(low, (int, float, Decimal)):
        floor = Decimal(str(low)).to_integral_value(ROUND_FLOOR)
        ceiling = Decimal(str(high)).to_integral_value(ROUND_CEILING)
        return str(int(floor)), str(int(ceiling))
    raise TypeError(f"cannot slice on a {type(low).__name__} column; use even_slices")


def even_slices(expression: str, slices: int) -> list[str]:
    """Predicates that cut a table by the remainder of an integer SQL expression.

    They are disjoint and cover every row, negative and null ones included.
    """
    if slices < 1:
        raise ValueError("slices must be at least 1")
    if slices == 1:
        return ["1 = 1"]
    remainder = f"ABS(MOD({expression}, {slices}))"
    first = f"{remainder} = 0 OR ({expression}) IS NULL"
    return [first, *[f"{remainder} = {i}" for i in range(1, slices)]]


def value_slices(column: str, cuts: Sequence[int | date]) -> list[str]:
    """Half-open range predicates between ascending cut points, nulls in the first slice."""
    texts = [f"DATE '{c.isoformat()}'" if isinstance(c, date) else str(c) for c in cuts]
    if not texts:
        return ["1 = 1"]
    slices = [f"{column} < {texts[0]} OR {column} IS NULL"]
    slices += [f"{column} >= {a} AND {column} < {b}" for a, b in zip(texts, texts[1:])]
    return [*slices, f"{column} >= {texts[-1]}"]


def read_bounds(
    spark: SparkSession, connection: JdbcConnection, table: str, column: str
) -> tuple[str, str] | None:
    """Smallest and largest value, found by the source database; one row is fetched."""
    reader = spark.read.format("jdbc").options(**connection.reader_options())
    row = reader.option("dbtable", bounds_table(table, column)).load().first()
    return bound_texts(row[0], row[1])


def cuts_table(table: str, column: str, slices: int) -> str:
    """Derived table of the cut points between even slices, found inside the source.

    One row per slice but the first, a value that fills several slices several times. A
    large table may be given with the source's own sampling clause.
    """
    if slices < 1:
        raise ValueError("slices must be at least 1")
    return (
        f"(SELECT MIN(cut_value) AS cut_point FROM (SELECT {column} AS cut_value, "
        f"NTILE({slices}) OVER (ORDER BY {column}) AS slice FROM {table} "
        f"WHERE {column} IS NOT NULL) ranked WHERE slice > 1 GROUP BY slice) cuts"
    )


def read_cuts(
    spark: SparkSession, connection: JdbcConnection, table: str, column: str, slices: int
) -> list[Any]:
    """Cut points of even slices, as many rows as slices, fetched from the source."""
    reader = spark.read.format("jdbc").options(**connection.reader_options())
    rows = reader.option("dbtable", cuts_table(table, column, slices)).load().collect()
    return sorted(r[0] for r in rows)


def read_table(
    spark: SparkSession,
    connection: JdbcConnection,
    table: str,
    partition_column: str | None = None,
    num_partitions: int = DEFAULT_PARTITIONS,
    predicates: Sequence[str] | None = None,
    one_task: bool = False,
) -> DataFrame:
    """A whole table; simple filters and the column list are pushed to the source.

    ``predicates`` reads one slice per predicate (see :func:`value_slices`); without
    any slices, ``one_task`` says that the table is small enough for that. Otherwise ``partition_column`` (numeric, date or timestamp) reads
    ``num_partitions`` ranges; rows outside the bounds found, and nulls, are kept.
    """
    if predicates:
        if partition_column:
            raise ValueError("give partition_column or predicates, not both")
        properties = {k: v for k, v in connection.reader_options().items() if k != "url"}
        return spark.read.jdbc(
            connection.url, table, predicates=list(predicates), properties=properties
        )

    if not partition_column and not one_task:
        _warn_of_one_task(table)
    reader = spark.read.format("jdbc").options(**connection.reader_options())
    reader = reader.option("dbtable", table)
    if partition_column:
        bounds = read_bounds(spark, connection, table, partition_column)
        if bounds:
            reader = reader.options(
                partitionColumn=partition_column,
                lowerBound=bounds[0],
                upperBound=bounds[1],
                numPartitions=str(num_partitions),
            )
    return reader.load()


def _warn_of_one_task(what: str) -> None:
    warnings.warn(
        f"{what} is read by one task over one connection; slice it by ranges of an indexed "
        "column, or say one_task=True if it is small",
        stacklevel=3,
    )


def read_query(
    spark: SparkSession, connection: JdbcConnection, query: str, one_task: bool = False
) -> DataFrame:
    """The result of a query run by the source, always over one connection.

    A large result is better read as a table: ``read_table`` takes a parenthesised
    query with an alias, which slices apply to.
    """
    if not one_task:
        _warn_of_one_task("a query")
    reader = spark.read.format("jdbc").options(**connection.reader_options())
    return reader.option("query", query).load()
