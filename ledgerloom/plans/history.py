"""Deduplication of a new day's rows against all earlier days, by a kept fingerprint index.

The index holds a 64-bit fingerprint and the day of every distinct row seen, in a partition
per day, sorted by fingerprint. A new day's fingerprints are looked up in it; full rows of
earlier days are read only from days where a fingerprint was met, and compared whole.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.keys import length_prefixed
from ledgerloom.operators.staging import drop_duplicate_rows
from ledgerloom.sources import sinks
from ledgerloom.sources.zones import shared_scratch

DAY = "SEEN_DAY"
PRINT = "ROW_PRINT"
INDEX = T.StructType([T.StructField(PRINT, T.LongType()), T.StructField(DAY, T.StringType())])


def row_print(columns: Sequence[str]) -> Column:
    """64-bit hash of a row's values, nulls and empty texts apart."""
    return F.xxhash64(*[length_prefixed(c) for c in columns])


def dedup_against_history(
    spark: SparkSession,
    rows: DataFrame,
    day: str,
    history: str,
    index: str,
    fingerprint: Callable[[Sequence[str]], Column] = row_print,
) -> sinks.WriteResult:
    """Add those of ``rows`` that stood on no earlier day to ``history``, each once.

    ``history`` is a table in partitions by :data:`DAY`, ``index`` its fingerprints; both are
    made when absent. Days are texts that sort by time, and come in order. A day run again
    replaces its own partition of both, and is compared with the other days before it only.
    Rows are equal when all columns are, nulls included; columns must be those of the history.
    """
    columns = rows.columns
    if DAY in columns or PRINT in columns:
        raise ValueError(f"{DAY} and {PRINT} are columns of the history")
    scratch = shared_scratch(spark, "new-day")
    printed = drop_duplicate_rows(rows).withColumn(PRINT, fingerprint(columns))
    printed.write.parquet(scratch)
    fresh = spark.read.schema(printed.schema).parquet(scratch)

    known = _earlier(spark, index, INDEX, day)
    table = _earlier(spark, history, None, day)
    if known is not None and table is not None:
        _same_columns(rows.schema, table.schema, history)
        fresh = _unseen(fresh, known, table, columns, fingerprint)
    kept = shared_scratch(spark, "unseen")
    fresh.write.parquet(kept)
    unseen = spark.read.schema(printed.schema).parquet(kept).withColumn(DAY, F.lit(day))
    # Rows before their fingerprints: a run cut short between them is made good by the day's
    # next run, and no fingerprint stands without its row.
    result = _replace_day(unseen.drop(PRINT), history, day)
    prints = unseen.select(PRINT, DAY).repartitionByRange(PRINT).sortWithinPartitions(PRINT)
    _replace_day(prints, index, day)
    return result


def _replace_day(rows: DataFrame, path: str, day: str) -> sinks.WriteResult:
    """Write the day's partition in place of an earlier run's, which stands until then."""
    result = sinks.write_table(rows, path, partition_by=[DAY], replace_partitions=True)
    if not result.rows:
        sinks.drop_partition(rows.sparkSession, path, DAY, day)
    return result


def _earlier(
    spark: SparkSession, path: str, schema: T.StructType | None, day: str
) -> DataFrame | None:
    """Days before the given one, in the columns of the newest; None if there are none."""
    if not sinks.path_exists(spark, path):
        return None
    days = [d for d in sinks.partition_values(spark, path, DAY) if d < day]
    if not days:
        return None
    if schema is None:
        newest = spark.read.parquet(f"{path.rstrip('/')}/{DAY}={max(days)}")
        schema = T.StructType([*newest.schema, INDEX[DAY]])
    return spark.read.schema(schema).parquet(path).filter(F.col(DAY) < day)


def _same_columns(rows: T.StructType, table: T.StructType, path: str) -> None:
    new = {f.name: f.dataType for f in rows}
    old = {f.name: f.dataType for f in table if f.name != DAY}
    if new != old:
        unlike = sorted(n for n in {**new, **old} if new.get(n) != old.get(n))
        raise ValueError(f"columns {unlike} are not those of {path}")


def _unseen(
    fresh: DataFrame, known: DataFrame, table: DataFrame, columns: Sequence[str],
    fingerprint: Callable[[Sequence[str]], Column],
) -> DataFrame:
    """Rows of ``fresh`` that are not in ``table``.

    A row whose fingerprint the index does not have is new. The others, and the earlier
    rows bearing their fingerprints, are grouped by all columns, where equal rows meet.
    """
    spark = fresh.sparkSession
    path = shared_scratch(spark, "met")
    known.join(fresh.select(PRINT), PRINT, "left_semi").write.parquet(path)
    met = spark.read.schema(INDEX).parquet(path)
    days = [row[0] for row in met.select(DAY).distinct().collect()]
    if not days:
        return fresh
    prints = met.select(PRINT).distinct()
    old = (
        table.filter(F.col(DAY).isin(days))
        .withColumn(PRINT, fingerprint(columns))
        .join(prints, PRINT, "left_semi")
    )
    suspects = fresh.join(prints, PRINT, "left_semi")
    both = suspects.select(*columns, PRINT, F.lit(False).alias("_old")).unionByName(
        old.select(*columns, PRINT, F.lit(True).alias("_old"))
    )
    told = both.groupBy(*columns, PRINT).agg(F.bool_or("_old").alias("_old"))
    new = told.filter(~F.col("_old")).drop("_old")
    return fresh.join(prints, PRINT, "left_anti").select(*columns, PRINT).unionByName(new)
