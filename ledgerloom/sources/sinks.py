"""Writing zone tables.

Row counts come from an ``Observation`` on the written rows, so nothing is computed
twice. The observation sits on top of the plan: its counters then belong to the
writing tasks, whose results Spark counts once per partition even if an executor is
lost and tasks run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.merge import (
    IS_DELETED,
    ChangeLog,
    Watermark,
    change_states,
    in_base_order,
    latest_per_key,
    merge_states,
    newest_of_both,
    replace_keys,
    without_old_tombstones,
)

SAVE_MODES = ("overwrite", "append", "error", "errorifexists", "ignore")


@dataclass(frozen=True)
class WriteResult:
    path: str
    rows: int


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    format: str = "parquet",
    replace_partitions: bool = False,
    rebalance: bool = False,
    max_records_per_file: int = 0,
) -> WriteResult:
    """Write a table and return its path and the number of rows written.

    ``replace_partitions`` overwrites only the partitions the rows fall in.
    ``rebalance`` shuffles once so that files come out evenly sized: Spark merges
    small partitions and splits a large one, so one date holding most rows does not
    end in one task.
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}; use one of {SAVE_MODES}")
    if replace_partitions and not partition_by:
        raise ValueError("replace_partitions needs partition_by")
    if mode == "ignore" and path_exists(df.sparkSession, path):
        return WriteResult(path, 0)

    rows = df.hint("rebalance", *partition_by) if rebalance else df
    counter = Observation(f"written-{uuid.uuid4().hex}")
    writer = rows.observe(counter, F.count(F.lit(1)).alias("rows")).write.format(format).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)
    return WriteResult(path, int(counter.get["rows"]))


def replace_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    format: str = "parquet",
) -> WriteResult:
    """Replace a table that ``df`` itself may be reading.

    The rows go to a sibling folder first; only when that write is complete is the
    old table moved aside, the new one moved in, and the old one removed. A failure
    before the swap leaves the table as it was; :func:`recover_table` repairs one
    that stopped inside it. Renames are quick on HDFS but copy data on most object
    stores, where the swap is not atomic either; a partitioned table with
    :func:`upsert_partitions` suits those better. A table has one writer at a time: a
    second one would take a swap in progress for one cut short.
    """
    spark = df.sparkSession
    base = path.rstrip("/")
    staged, previous = f"{base}__staged_{uuid.uuid4().hex}", f"{base}__previous"
    recover_table(spark, base)
    fs, target = _file_system(spark, base)
    old, new = _file_system(spark, previous)[1], _file_system(spark, staged)[1]
    try:
        result = write_table(df, staged, "error", partition_by, format)
    except Exception:
        fs.delete(new, True)
        raise

    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"could not move {base} aside")
    if not fs.rename(new, target):
        raise OSError(f"could not move {staged} to {base}; the old table is at {previous}")
    fs.delete(old, True)
    return WriteResult(base, result.rows)


def drop_partition(spark: SparkSession, path: str, column: str, value: str) -> bool:
    """Remove one partition of a table written with ``partition_by=[column]``."""
    fs, target = _file_system(spark, f"{path.rstrip('/')}/{column}={value}")
    return fs.delete(target, True)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the outermost partition column, as they stand in the folders' names."""
    fs, folder = _file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    return [n.partition("=")[2] for n in names if n.startswith(f"{column}=")]


def recover_table(spark: SparkSession, path: str) -> bool:
    """Finish or undo a swap that was cut short; True if anything was repaired."""
    base = path.rstrip("/")
    fs, target = _file_system(spark, base)
    old = _file_system(spark, f"{base}__previous")[1]
    if not fs.exists(old):
        return False
    if fs.exists(target):
        fs.delete(old, True)
    elif not fs.rename(old, target):
        raise OSError(f"could not restore {base}")
    return True


@contextmanager
def _written_updates(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
) -> Iterator[DataFrame]:
    """The newest row per key as a table beside ``path``.

    An upsert uses its updates more than once. Writing them down means the source is
    read once, all uses see the same rows, and a lost executor never goes back to it.
    Their size on disk is then known to Spark, which picks the join by its own settings.
    """
    folder = f"{path.rstrip('/')}__updates_{uuid.uuid4().hex}"
    fresh = latest_per_key(updates, keys, order_by)
    fs, target = _file_system(spark, folder)
    try:
        fresh.write.parquet(folder)
        yield spark.read.schema(fresh.schema).parquet(folder)
    finally:
        fs.delete(target, True)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns a written table's folders are named by, outermost first."""
    fs, folder = _file_system(spark, path)
    names: list[str] = []
    while True:
        inner = [
            s.getPath() for s in fs.listStatus(folder)
            if s.isDirectory() and "=" in s.getPath().getName()
        ]
        if not inner:
            return names
        folder = inner[0]
        names.append(folder.getName().partition("=")[0])


def upsert_table(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    keep_newer: bool = False,
) -> WriteResult:
    """Merge updates into a table and swap the result in; creates a missing table.

    Columns the table does not have yet are added. The whole table is written again,
    so this is for small ones; a table in partitions is refused, since it would lose
    them: :func:`upsert_partitions` is for those. ``keep_newer`` lets a row of the table
    stand against an update that is older in ``order_by``.
    """
    recover_table(spark, path)
    if not path_exists(spark, path):
        return replace_table(latest_per_key(updates, keys, order_by), path)
    layout = partition_columns(spark, path)
    if layout:
        raise ValueError(f"{path} is partitioned by {layout}; use upsert_partitions")
    base = spark.read.parquet(path)
    ordered = in_base_order(base, updates)
    with _written_updates(spark, path, ordered, keys, order_by) as fresh:
        if keep_newer:
            fresh = newest_of_both(base, fresh, keys, order_by)
        return replace_table(replace_keys(base, fresh, keys), path)


# Partitions rewritten by one job; it bounds the length of a pruning filter. All
# touched partitions are worked through, in as many jobs as that takes.
PARTITIONS_PER_JOB = 1_000


def upsert_partitions(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    order_by: Sequence[str] = (),
    keep_newer: bool = False,
) -> WriteResult:
    """Merge updates into a partitioned table, rewriting only the partitions they touch.

    The partition columns must be part of the key, otherwise a key could move
    between partitions and leave its old row behind. Spark stages dynamic partition
    overwrites and commits them after all tasks are done, so the partitions being
    rewritten can still be read meanwhile. Rows are rebalanced by partition before they
    are written, so a partition gets as many files as its size asks for, not one from
    every task. ``keep_newer`` lets a row of the table stand against an update that is
    older in ``order_by``.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError(f"partition columns {list(partition_by)} must be part of the key")
    if not path_exists(spark, path):
        first = updates.select(*[_as_stored(f, partition_by) for f in updates.schema.fields])
        newest = latest_per_key(first, keys, order_by)
        return write_table(newest, path, "overwrite", partition_by, rebalance=True)

    base = spark.read.parquet(path)
    added = sorted(set(updates.columns) - set(base.columns))
    if added:
        raise ValueError(f"columns {added} are not in {path}; untouched partitions would lack them")
    cast = updates.select(*[_as_stored(f, partition_by) for f in base.schema.fields])
    rows = 0
    with _written_updates(spark, path, cast, keys, order_by) as fresh:
        # The driver lists a table's partitions to read it; these are no more than that.
        touched = [tuple(r) for r in fresh.select(*partition_by).distinct().collect()]
        for first in range(0, len(touched), PARTITIONS_PER_JOB):
            some = touched[first:first + PARTITIONS_PER_JOB]
            old = rows_of_partitions(base, partition_by, some)
            new = rows_of_partitions(fresh, partition_by, some)
            if keep_newer:
                new = newest_of_both(old, new, keys, order_by)
            rows += write_table(
                replace_keys(old, new, keys), path, "overwrite", partition_by,
                replace_partitions=True, rebalance=True,
            ).rows
    return WriteResult(path, rows)


def _as_stored(field: T.StructField, partition_by: Sequence[str]) -> Column:
    """A column in the table's type; a blank partition value is stored, and read, as null."""
    value = F.col(field.name).cast(field.dataType)
    if field.name in partition_by and isinstance(field.dataType, T.StringType):
        value = F.nullif(value, F.lit(""))
    return value.alias(field.name)


def rows_of_partitions(
    df: DataFrame, partition_by: Sequence[str], listed: Sequence[tuple]
) -> DataFrame:
    """Rows in the listed partitions, null ones included; the filters prune the scan."""
    for i, name in enumerate(partition_by):
        df = df.filter(_one_of(name, {values[i] for values in listed}))
    if len(partition_by) == 1:
        return df
    schema = T.StructType([T.StructField(f"listed_{c}", df.schema[c].dataType) for c in partition_by])
    names = df.sparkSession.createDataFrame(list(listed), schema)
    same = [df[c].eqNullSafe(names[f"listed_{c}"]) for c in partition_by]
    return df.join(names, reduce(lambda a, b: a & b, same), "left_semi")


def _one_of(name: str, values: set) -> Column:
    """A filter on listed values in a form partition pruning can use."""
    known = [v for v in values if v is not None]
    hit = F.col(name).isin(known) if known else F.lit(False)
    return hit | F.col(name).isNull() if None in values else hit


# --- change logs -------------------------------------------------------------

# A written column may be this many times larger in memory than in its files.
UNPACKED = 4


def fits_broadcast(spark: SparkSession, path: str) -> bool:
    """Whether a written table is, unpacked, below the session's own broadcast limit."""
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    fs, folder = _file_system(spark, path)
    return UNPACKED * fs.getContentSummary(folder).getLength() < limit


def _horizon_path(path: str) -> str:
    return f"{path.rstrip('/')}__horizon"


def change_horizon(spark: SparkSession, path: str) -> Watermark:
    """The latest horizon a state table was brought to, as text; None before the first."""
    folder = _horizon_path(path)
    if not path_exists(spark, folder):
        return None
    passed = spark.read.parquet(folder).orderBy(F.desc("horizon")).first()
    return None if passed is None else str(passed["horizon"])


def move_horizon(
    spark: SparkSession, path: str, kind: T.DataType, horizon: Watermark
) -> Watermark:
    """The later of the table's horizon and the one given, which is then kept with it.

    Tombstones that are gone cannot come back, so a horizon never goes back either.
    """
    stored = change_horizon(spark, path)
    if horizon is None:
        return stored
    given = spark.range(1).select(F.lit(str(horizon)).cast(kind).alias("horizon"))
    if stored is not None:
        later = given.select(F.col("horizon") > F.lit(stored).cast(kind)).first()[0]
        if not later:
            return stored
    given.write.mode("append").parquet(_horizon_path(path))
    return horizon


def apply_change_log(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    log: ChangeLog,
    partition_by: Sequence[str] = (),
    horizon: Watermark = None,
) -> WriteResult:
    """Bring a written state table up to a change log; creates a missing one.

    The newest change of each key is written down first: the log is read once, and its
    size decides whether the state is shuffled at all (``merge_states``). With
    ``partition_by``, which must be part of the key, only partitions with changes are
    read and rewritten; without, the table is replaced by a staged swap. ``horizon`` is
    kept beside the table and only moves forward; see :func:`~ledgerloom.operators.merge.
    apply_changes`. Applying a log again changes nothing, so a failed run is repeated whole.
    """
    if not set(partition_by) <= set(log.keys):
        raise ValueError(f"partition columns {list(partition_by)} must be part of the key")
    horizon = move_horizon(spark, path, changes.schema[log.sequence].dataType, horizon)
    if not partition_by:
        recover_table(spark, path)
    if not path_exists(spark, path):
        typed = changes.select(*[_as_stored(f, partition_by) for f in changes.schema.fields])
        first = without_old_tombstones(change_states(typed, log, horizon), log, horizon)
        return write_table(first, path, partition_by=partition_by, rebalance=bool(partition_by))

    state = spark.read.parquet(path)
    layout = partition_columns(spark, path)
    if layout != list(partition_by):
        raise ValueError(f"{path} is partitioned by {layout}, not by {list(partition_by)}")
    stored = [f for f in state.schema.fields if f.name != IS_DELETED]
    names = [f.name for f in stored]
    missing = sorted(set(names) - set(changes.columns))
    added = sorted(set(changes.columns) - {*names, log.operation})
    if missing or (added and partition_by):
        raise ValueError(f"columns {missing or added} are not on both sides of {path}")
    typed = changes.select(
        *[_as_stored(f, partition_by) for f in stored], log.operation, *added
    )
    folder = f"{path.rstrip('/')}__changes_{uuid.uuid4().hex}"
    fs, written = _file_system(spark, folder)
    try:
        arrived = change_states(typed, log, horizon)
        arrived.write.parquet(folder)
        fresh = spark.read.schema(arrived.schema).parquet(folder)
        few = not added and fits_broadcast(spark, folder)
        if not partition_by:
            merged = merge_states(state, fresh, log, few)
            return replace_table(without_old_tombstones(merged, log, horizon), path)
        rows = 0
        # The driver lists a table's partitions to read it; these are no more than that.
        touched = [tuple(r) for r in fresh.select(*partition_by).distinct().collect()]
        for first_one in range(0, len(touched), PARTITIONS_PER_JOB):
            some = touched[first_one:first_one + PARTITIONS_PER_JOB]
            merged = merge_states(
                rows_of_partitions(state, partition_by, some),
                rows_of_partitions(fresh, partition_by, some), log, few,
            )
            rows += write_table(
                without_old_tombstones(merged, log, horizon), path, "overwrite", partition_by,
                replace_partitions=True, rebalance=True,
            ).rows
        return WriteResult(path, rows)
    finally:
        fs.delete(written, True)
