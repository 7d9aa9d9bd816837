"""Audits of a partitioned table from kept state, reading only partitions that changed.

Beside the table lies its audit state: a row of measures per partition, and the hashes of
the partition's keys with their counts. Both merge by adding up, so an audit measures the
partitions whose files changed since the last one and takes the others as they were kept.
Keys are compared across partitions by hash; where a hash stands twice, the rows that bear
it are read from the partitions they lie in and compared by the keys themselves.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.checksums import LANE_COUNT, hash_sum_lanes
from ledgerloom.operators.checks import (
    AuditSpec,
    audit_links,
    duplicate_key_count,
    measured_rows,
    missing_columns,
)
from ledgerloom.sources import sinks

_SUMS = ("target_rows", "null_rows", "collapsed_rows", *[f"lane_{i}" for i in range(LANE_COUNT)])
# The partition a row lies in, while its table is measured.
PART = "_AUDITED_PART"

MEASURES = T.StructType(
    [
        T.StructField("part", T.StringType()),
        T.StructField("part_id", T.StringType()),
        T.StructField("files", T.StringType()),
        T.StructField("basis", T.StringType()),
        *[T.StructField(name, T.LongType()) for name in _SUMS],
    ]
)
KEYS = T.StructType(
    [
        T.StructField("key_hash", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("part_id", T.StringType()),
    ]
)


def _folders(file: str, depth: int) -> str:
    """The file's innermost folders, which name its partition within the table."""
    return "/".join(file.split("/")[-depth - 1:-1])


def _digest(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def table_parts(table: DataFrame, depth: int) -> dict[str, str]:
    """Folder of each partition below the table's, and a digest of the names of its files.

    Spark gives every file it writes a name of its own, so a partition written again, or
    added to, has another digest. Only the listing that any scan needs is made.
    """
    files = defaultdict(list)
    for file in table.inputFiles():
        files[_folders(file, depth)].append(file)
    return {part: _digest("\n".join(sorted(names))) for part, names in files.items()}


def _basis(spec: AuditSpec, method: str) -> str:
    """What the kept measures depend on beside the rows."""
    prefixes = sorted((name, tuple(values)) for name, values in spec.key_prefixes.items())
    return _digest(repr((spec.keys, spec.checksum_columns, prefixes, method)))


def _rows_of(spark: SparkSession, path: str, parts: list[str], schema: T.StructType) -> DataFrame:
    """Rows of the given partitions; no other folder is listed."""
    folders = [f"{path.rstrip('/')}/{unquote(part)}" for part in parts]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def _kept_measures(spark: SparkSession, state: str) -> list:
    path = f"{state.rstrip('/')}/measures"
    sinks.recover_table(spark, path)
    if not sinks.path_exists(spark, path):
        return []
    return spark.read.schema(MEASURES).parquet(path).collect()


def refresh_audit_state(
    spark: SparkSession, path: str, state: str, spec: AuditSpec, method: str = "xxhash64"
) -> list[str]:
    """Bring the state in line with the table; the folders that had to be read.

    A partition is read where its files, or what is measured, are not those of the state.
    The measures of such partitions are taken out first and put in last, so a refresh cut
    short is made up for by the next. A table has one refresh at a time. The driver holds a
    row per partition, as it does for any scan.
    """
    table = spark.read.parquet(path)
    if missing := missing_columns(table, _wanted(spec)):
        raise ValueError(f"no state can be kept without {missing}; use audit_links")
    depth = len(sinks.partition_columns(spark, path))
    basis, parts = _basis(spec, method), table_parts(table, depth)
    kept = [
        row
        for row in _kept_measures(spark, state)
        if parts.get(row["part"]) == row["files"] and row["basis"] == basis
    ]
    known = {row["part"] for row in kept}
    changed = sorted(set(parts) - known)
    measures, keys = f"{state.rstrip('/')}/measures", f"{state.rstrip('/')}/keys"
    gone = _part_ids(spark, keys) - {row["part_id"] for row in kept}
    if not changed and not gone:
        return []

    sinks.replace_table(spark.createDataFrame(kept, MEASURES).coalesce(1), measures)
    for part_id in gone:
        sinks.drop_partition(spark, keys, "part_id", part_id)
    fresh: list = []
    if changed:
        folder = F.slice(F.split("_metadata.file_path", "/"), -depth - 1, depth)
        rows = _rows_of(spark, path, changed, table.schema).withColumn(PART, F.array_join(folder, "/"))
        seen = measured_rows(rows, spec, method, PART)
        hashes = seen.groupBy(F.md5(PART).alias("part_id"), "key_hash").agg(
            F.count(F.lit(1)).alias("n")
        )
        sinks.write_table(hashes, keys, "append", partition_by=["part_id"], rebalance=True)
        sums = seen.groupBy(PART).agg(
            F.count(F.lit(1)).alias("target_rows"),
            F.sum("null_key").alias("null_rows"),
            F.sum("bare_key").alias("collapsed_rows"),
            *hash_sum_lanes("fingerprint"),
        )
        found = {row[PART]: row for row in sums.collect()}
        if unlisted := sorted(set(found) - set(changed)):
            raise RuntimeError(f"rows of {unlisted} were read, which are no partitions of {path}")
        for part in changed:
            values = [found[part][name] if part in found else 0 for name in _SUMS]
            fresh.append((part, _digest(part), parts[part], basis, *values))
    whole = spark.createDataFrame([*map(tuple, kept), *fresh], MEASURES)
    sinks.replace_table(whole.coalesce(1), measures)
    return changed


def _wanted(spec: AuditSpec) -> T.StructType:
    names = dict.fromkeys([*spec.keys, *spec.checksum_columns])
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _part_ids(spark: SparkSession, keys: str) -> set[str]:
    if not sinks.path_exists(spark, keys):
        return set()
    return set(sinks.partition_values(spark, keys, "part_id"))


def audit_from_state(
    spark: SparkSession,
    path: str,
    state: str,
    source: DataFrame,
    spec: AuditSpec,
    checksum_method: str = "xxhash64",
    **options,
) -> DataFrame:
    """The check rows of :func:`~ledgerloom.operators.checks.audit_links` on a written table.

    Refreshes the state, then adds it up. Partitions that did not change are not scanned
    unless a key hash of theirs stands more than once in the table. Jobs run while the
    report is being built. ``options`` are those of ``audit_links``.
    """
    refresh_audit_state(spark, path, state, spec, checksum_method)
    table = spark.read.parquet(path)
    measures = spark.read.schema(MEASURES).parquet(f"{state.rstrip('/')}/measures")
    sums = measures.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in _SUMS]
    )
    repeated = repeated_key_hashes(spark, state)
    suspects = repeated.select("key_hash")
    ids = [row[0] for row in repeated.select(F.explode("parts")).distinct().collect()]
    duplicates = F.lit(0).cast("bigint")
    if ids:
        parts = [row["part"] for row in _kept_measures(spark, state) if row["part_id"] in set(ids)]
        rows = _rows_of(spark, path, parts, table.schema)
        duplicates = duplicate_key_count(rows, spec.keys, suspects).scalar()
    metrics = sums.withColumn("duplicate_keys", duplicates)
    return audit_links(
        table, source, spec, checksum_method, metrics=metrics, **options
    )


def repeated_key_hashes(spark: SparkSession, state: str) -> DataFrame:
    """Key hashes that stand more than once in the table, and the partitions they lie in."""
    path = f"{state.rstrip('/')}/keys"
    if not sinks.path_exists(spark, path):
        return spark.createDataFrame([], "key_hash bigint, parts array<string>")
    return (
        spark.read.schema(KEYS).parquet(path)
        .groupBy("key_hash")
        .agg(F.sum("n").alias("n"), F.collect_set("part_id").alias("parts"))
        .filter(F.col("n") > 1)
        .select("key_hash", "parts")
    )
