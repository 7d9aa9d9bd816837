"""What follows a load: releasing quarantined rows, archiving raw days, resuming a run."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.checksums import checksum_text, hash_sum_lanes
from ledgerloom.functions.keys import length_prefixed
from ledgerloom.operators.merge import rows_after
from ledgerloom.operators.staging import (
    REJECT_REASON,
    ColumnRule,
    drop_duplicate_rows,
    normalise,
    reject_reason,
)
from ledgerloom.plans.jobs import (
    FAILED,
    QUARANTINE_RUN,
    SUCCESS,
    IngestFailed,
    StepResult,
    append_run_log,
    ingest_increment,
    ingest_tables,
    run_log,
)
from ledgerloom.sources import sinks
from ledgerloom.sources.files import TableSource
from ledgerloom.sources.zones import QUARANTINE, RAW, RECONCILE, STAGING, Zones, shared_scratch

ARCHIVE = "archive"
RAW_DAY = "ETL_DATE"
RUN_LOG = "etl_pipeline_audit"
WATERMARKS = "watermarks"
WATERMARK_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)
MANIFEST_COLUMNS = ("row_count", "checksum")


class ArchiveUnverified(RuntimeError):
    """Raised when archived rows, read back, are not those of raw; raw is left as it is."""


# --- release ------------------------------------------------------------------


def _with_text(table: DataFrame, column: str) -> T.StructType:
    """The schema with a partition column as text, whatever its values look like."""
    return T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name == column else f for f in table.schema]
    )


def release_quarantine(
    spark: SparkSession, zones: Zones, name: str, rules: Sequence[ColumnRule]
) -> tuple[sinks.WriteResult, sinks.WriteResult]:
    """Judge held rows again: those that pass go to staging, the others stay, with new reasons.

    Returns what was added to staging and what is still held. Each row ends in one place:
    staging takes a row only if it has none like it, and only then do its rows leave the
    quarantine, so a release cut short is finished by the next. Staging is added to, not
    rewritten; of its rows only those sharing a fingerprint with a released one are compared.
    """
    held_path, staged_path = zones.table(QUARANTINE, name), zones.table(STAGING, name)
    schema = _with_text(spark.read.parquet(held_path), QUARANTINE_RUN)
    held = spark.read.schema(schema).parquet(held_path)
    runs = sinks.partition_values(spark, held_path, QUARANTINE_RUN)
    raw = [c for c in held.columns if c not in (REJECT_REASON, QUARANTINE_RUN)]

    folder = shared_scratch(spark, f"judged-again-{name}")
    rated = held.select(*raw, QUARANTINE_RUN, reject_reason(rules).alias(REJECT_REASON)).withColumn(
        "rejected", F.col(REJECT_REASON) != ""
    )
    sinks.write_table(rated, folder, partition_by=["rejected"])
    judged = spark.read.schema(rated.schema).parquet(folder)

    passed = drop_duplicate_rows(normalise(judged.filter("NOT rejected").select(*raw), rules))
    released = sinks.write_table(_not_staged(spark, passed, staged_path), staged_path, "append")

    stay = judged.filter("rejected").select(*raw, REJECT_REASON, QUARANTINE_RUN)
    kept = sinks.write_table(
        stay, held_path, partition_by=[QUARANTINE_RUN], replace_partitions=True
    )
    left = {r[0] for r in stay.select(QUARANTINE_RUN).distinct().collect()}
    for run in set(runs) - left:
        sinks.drop_partition(spark, held_path, QUARANTINE_RUN, run)
    return released, kept


def _not_staged(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """Rows staging does not have, written down: staging is read for them and added to."""
    if sinks.path_exists(spark, path):
        staged = spark.read.parquet(path)
        kinds = {f.name: f.dataType for f in staged.schema}
        if kinds != {f.name: f.dataType for f in rows.schema}:
            raise ValueError(f"the rules do not give the columns of {path}")
        rows = rows.select(*staged.columns)
        mark = F.xxhash64(*[length_prefixed(c) for c in staged.columns])
        alike = staged.withColumn("_mark", mark).join(
            rows.select(mark.alias("_mark")).distinct(), "_mark", "left_semi"
        )
        rows = rows.subtract(alike.select(*staged.columns))
    folder = shared_scratch(spark, "released")
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


# --- archive ------------------------------------------------------------------


def day_sums(rows: DataFrame) -> DataFrame:
    """Rows and checksum of every day; summed on the map side, so one row a day and task."""
    columns = [c for c in rows.columns if c != RAW_DAY]
    printed = rows.select(
        RAW_DAY, F.xxhash64(*[length_prefixed(c) for c in columns]).alias("fingerprint")
    )
    sums = printed.groupBy(RAW_DAY).agg(
        F.count(F.lit(1)).alias("row_count"), *hash_sum_lanes("fingerprint")
    )
    return sums.select(RAW_DAY, "row_count", checksum_text(F.col("row_count")).alias("checksum"))


def archive_days(spark: SparkSession, zones: Zones, name: str, keep_from: str) -> list[str]:
    """Move raw days before ``keep_from`` to the archive; the days moved.

    Raw must be kept by date. The days are copied, read back, and compared with raw by count
    and checksum; the manifest gets a row per day; only then do they leave raw. Any step may
    be cut short: a day still in raw is archived again, over what is there of it.
    """
    raw_path, path = zones.table(RAW, name), zones.table(ARCHIVE, name)
    days = [d for d in sinks.partition_values(spark, raw_path, RAW_DAY) if d < keep_from]
    if not days:
        return []
    schema = _with_text(spark.read.parquet(raw_path), RAW_DAY)
    old = spark.read.schema(schema).parquet(raw_path).filter(F.col(RAW_DAY).isin(days))
    sinks.write_table(old, path, partition_by=[RAW_DAY], replace_partitions=True)
    copied = spark.read.schema(schema).parquet(path).filter(F.col(RAW_DAY).isin(days))
    want, got = (sorted(tuple(r) for r in day_sums(rows).collect()) for rows in (old, copied))
    if want != got:
        unlike = sorted({r[0] for r in set(want) ^ set(got)})
        raise ArchiveUnverified(f"{name}: archived rows of {unlike} are not those of raw")
    manifest = spark.createDataFrame(
        want, f"{RAW_DAY} string, row_count bigint, checksum string"
    ).withColumn("archived_at", F.current_timestamp())
    sinks.write_table(
        manifest.coalesce(1), zones.table(ARCHIVE, f"{name}_manifest"),
        partition_by=[RAW_DAY], replace_partitions=True,
    )
    for day in days:
        sinks.drop_partition(spark, raw_path, RAW_DAY, day)
    return sorted(days)


def archive_manifest(spark: SparkSession, zones: Zones, name: str) -> DataFrame:
    """Day, rows, checksum and time of every archived day."""
    path = zones.table(ARCHIVE, f"{name}_manifest")
    return spark.read.schema(
        f"row_count bigint, checksum string, archived_at timestamp, {RAW_DAY} string"
    ).parquet(path)


def archive_report(spark: SparkSession, zones: Zones, name: str) -> DataFrame:
    """Every archived day, and whether its rows are still those of the manifest."""
    path = zones.table(ARCHIVE, name)
    schema = _with_text(spark.read.parquet(path), RAW_DAY)
    found = day_sums(spark.read.schema(schema).parquet(path)).alias("f")
    noted = archive_manifest(spark, zones, name).alias("m")
    same = F.lit(True)
    for column in MANIFEST_COLUMNS:
        same = same & F.col(f"f.{column}").eqNullSafe(F.col(f"m.{column}"))
    return noted.join(found, F.col(f"f.{RAW_DAY}") == F.col(f"m.{RAW_DAY}"), "full_outer").select(
        F.coalesce(f"m.{RAW_DAY}", f"f.{RAW_DAY}").alias(RAW_DAY),
        F.col("m.row_count").alias("row_count"),
        same.alias("verified"),
    )


# --- resumed runs --------------------------------------------------------------


@dataclass(frozen=True)
class Run:
    """A run of a pipeline's stage, as the run log names it; a restart has the same id."""

    run_id: str
    pipeline: str
    stage: str = "ingest"


def finished_tables(spark: SparkSession, zones: Zones, run: Run) -> dict[str, int]:
    """Tables whose newest entry of this run is a success, and their rows."""
    path = zones.table(RECONCILE, RUN_LOG)
    if not sinks.path_exists(spark, path):
        return {}
    log = spark.read.parquet(path).filter(
        (F.col("run_id") == run.run_id)
        & (F.col("pipeline_name") == run.pipeline)
        & (F.col("stage_name") == run.stage)
    )
    newest = log.groupBy("table_name").agg(
        F.max_by(F.struct("status", "row_count"), F.struct("created_at", "end_time")).alias("last")
    )
    done = newest.filter(F.col("last.status") == SUCCESS).select("table_name", "last.row_count")
    return {r[0]: r[1] for r in done.collect()}


def ingest_resumed(
    spark: SparkSession,
    sources: Iterable[TableSource],
    zones: Zones,
    run_date: str,
    run: Run,
    by_date: bool = False,
    raise_on_failure: bool = True,
) -> list[StepResult]:
    """Ingest the tables this run has not finished; each is logged as soon as it is done.

    A table is skipped if the log says so and raw has it; its source is then not read. So a
    run that stopped, with its driver or for one bad table, goes on where it was.
    """
    done = finished_tables(spark, zones, run)
    results = []
    for source in sources:
        path = zones.table(RAW, source.name)
        if by_date:
            path = f"{path}/{RAW_DAY}={run_date}"
        if source.name in done and sinks.path_exists(spark, path):
            now = datetime.now()
            results.append(
                StepResult(source.name, SUCCESS, done[source.name], now, now, "finished before")
            )
            continue
        found = ingest_tables(
            spark, [source], zones, run_date, by_date=by_date, raise_on_failure=False
        )
        append_run_log(run_log(spark, found, run.run_id, run.pipeline, run.stage), zones, RUN_LOG)
        results.extend(found)
    if raise_on_failure and any(r.status == FAILED for r in results):
        raise IngestFailed(results)
    return results


def kept_watermark(spark: SparkSession, zones: Zones, name: str) -> str | None:
    """How far increments of a table have come, as text; None before the first."""
    path = zones.table(RECONCILE, WATERMARKS)
    if not sinks.path_exists(spark, path):
        return None
    kept = spark.read.schema(WATERMARK_SCHEMA).parquet(path).filter(F.col("table_name") == name)
    return kept.agg(F.max_by("watermark", "created_at")).first()[0]


def ingest_increment_kept(
    spark: SparkSession,
    source: DataFrame,
    zones: Zones,
    name: str,
    keys: Sequence[str],
    changed_column: str,
    partition_by: Sequence[str] = (),
) -> sinks.WriteResult:
    """:func:`~ledgerloom.plans.jobs.ingest_increment` from the kept watermark on.

    The staging table is not scanned for it. The next one is the largest value among the
    source's new rows, looked up before they are taken and kept after they are written: rows
    that come in between, or a run cut short, are taken again, which merging by key bears.
    """
    last = kept_watermark(spark, zones, name)
    fresh = rows_after(source, changed_column, last, inclusive=True, nulls=True)
    reached = fresh.agg(F.max(changed_column).cast("string")).first()[0]
    result = ingest_increment(
        spark, source, zones, name, keys, changed_column, last, partition_by
    )
    if reached is not None and reached != last:
        row = spark.createDataFrame([(name, reached, datetime.now())], WATERMARK_SCHEMA)
        sinks.write_table(row.coalesce(1), zones.table(RECONCILE, WATERMARKS), "append")
    return result
