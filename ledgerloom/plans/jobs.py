"""The jobs that move tables from zone to zone.

Each takes its session, zones, dates and specs as arguments and returns what it
wrote. Scheduling and retries are left to whatever calls them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.checks import (
    AuditSpec,
    audit_links,
    count_snapshot,
    raise_on_failures,
)
from ledgerloom.operators.compare import row_diff
from ledgerloom.operators.mapping import (
    ALL_BLOCKS,
    LinkSpec,
    expected_link_counts,
    map_links,
    select_blocks,
)
from ledgerloom.operators.merge import (
    ChangeLog,
    Watermark,
    current_rows,
    high_water_mark,
    refused_changes,
    rows_after,
)
from ledgerloom.operators.staging import (
    REJECT_REASON,
    ColumnRule,
    drop_duplicate_rows,
    normalise,
    reject_reason,
    with_etl_date,
    with_ingest_metadata,
)
from ledgerloom.plans.links import (
    ACCOUNT_TABLE,
    BILL_TABLE,
    LINK_AUDIT,
    LINKS,
    with_key_prefixes,
)
from ledgerloom.sources.files import TableSource, read_csv, read_parquet, split_corrupt
from ledgerloom.sources.sinks import (
    WriteResult,
    apply_change_log,
    change_horizon,
    drop_partition,
    path_exists,
    upsert_partitions,
    upsert_table,
    write_table,
)
from ledgerloom.sources.zones import (
    QUARANTINE,
    RAW,
    RECONCILE,
    SOR,
    STAGING,
    Zones,
    shared_scratch,
)

SUCCESS, FAILED = "SUCCESS", "FAILED"

# The partition of quarantined rows, and its value where no run date was given.
QUARANTINE_RUN, NO_RUN_DATE = "RUN_DATE", "undated"

# Columns of the run log (fixed values; the numeric id of a database table is
# replaced by a run id, since appending files hands out no sequence).
RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("pipeline_name", T.StringType(), False),
        T.StructField("stage_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("row_count", T.LongType(), True),
        T.StructField("start_time", T.TimestampType(), True),
        T.StructField("end_time", T.TimestampType(), True),
        T.StructField("message", T.StringType(), True),
        T.StructField("created_at", T.TimestampType(), True),
    ]
)


@dataclass(frozen=True)
class StepResult:
    """Outcome of one table in one stage."""

    table: str
    status: str
    rows: int | None
    started: datetime
    ended: datetime
    message: str = ""

    @property
    def seconds(self) -> float:
        return (self.ended - self.started).total_seconds()


class IngestFailed(RuntimeError):
    """Raised after all tables were tried; ``results`` holds every outcome."""

    def __init__(self, results: Sequence[StepResult]) -> None:
        self.results = list(results)
        failed = [r for r in results if r.status == FAILED]
        parts = ", ".join(f"{r.table} ({r.message})" for r in failed)
        super().__init__(f"{len(failed)} of {len(self.results)} tables were not ingested: {parts}")


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _attempt(table: str, step: Callable[[], WriteResult]) -> StepResult:
    started = _now()
    try:
        written = step()
    except Exception as error:  # one bad table must not stop the others
        return StepResult(table, FAILED, None, started, _now(), str(error))
    return StepResult(table, SUCCESS, written.rows, started, _now())


def ingest_tables(
    spark: SparkSession,
    sources: Iterable[TableSource],
    zones: Zones,
    run_date: str,
    by_date: bool = False,
    workers: int = 1,
    raise_on_failure: bool = True,
) -> list[StepResult]:
    """Copy source tables into the raw zone, each on its own.

    Every table is read once, stamped with ETL_DATE and INGESTION_TIMESTAMP and
    written; the count is taken from the write. All tables are tried before
    :class:`IngestFailed` is raised. ``by_date`` keeps one partition per run date
    instead of replacing the table; ``workers`` submits that many tables at a time.
    """

    def copy(source: TableSource) -> StepResult:
        def step() -> WriteResult:
            rows = with_ingest_metadata(source.read(spark), run_date)
            path = zones.table(RAW, source.name)
            if by_date:
                return write_table(
                    rows, path, partition_by=["ETL_DATE"], replace_partitions=True
                )
            return write_table(rows, path)

        return _attempt(source.name, step)

    listed = list(sources)
    if workers > 1:
        with ThreadPoolExecutor(workers) as pool:
            results = list(pool.map(inheritable_thread_target(spark)(copy), listed))
    else:
        results = [copy(s) for s in listed]
    if raise_on_failure and any(r.status == FAILED for r in results):
        raise IngestFailed(results)
    return results


def raw_tables(
    spark: SparkSession, zones: Zones, run_date: str | None = None
) -> Callable[[str], DataFrame]:
    """Reader of raw tables by name; with a run date, of that date's partition only."""

    def read(name: str) -> DataFrame:
        rows = read_parquet(spark, zones.table(RAW, name))
        return rows if run_date is None else of_run(rows, run_date)

    return read


def of_run(rows: DataFrame, run_date: str) -> DataFrame:
    """Rows of one run; on a table kept by date the filter prunes partitions.

    Spark reads partition values that look like numbers as numbers, so the run date
    is compared in the column's type and handed on as text.
    """
    stored = rows.schema["ETL_DATE"].dataType
    picked = rows.filter(F.col("ETL_DATE") == F.lit(run_date).cast(stored))
    return with_etl_date(picked, run_date)


def run_log(
    spark: SparkSession,
    results: Sequence[StepResult],
    run_id: str,
    pipeline: str,
    stage: str,
) -> DataFrame:
    """Step outcomes as log rows, one per table of the run."""
    created = _now()
    rows = [
        (
            run_id, pipeline, stage, r.table, r.status, r.rows,
            r.started, r.ended, r.message or None, created,
        )
        for r in results
    ]
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def append_run_log(log: DataFrame, zones: Zones, name: str = "etl_pipeline_audit") -> WriteResult:
    return write_table(log, zones.table(RECONCILE, name), "append")


def land_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    zones: Zones,
    name: str,
    run_date: str,
    header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Write landed CSV files to raw as Parquet; (readable rows, misfits) read from there."""
    table = zones.table(RAW, name)
    write_table(with_ingest_metadata(read_csv(spark, path, schema, header), run_date), table)
    return split_corrupt(spark.read.parquet(table))


def ingest_increment(
    spark: SparkSession,
    source: DataFrame,
    zones: Zones,
    name: str,
    keys: Sequence[str],
    changed_column: str,
    watermark: Watermark = None,
    partition_by: Sequence[str] = (),
) -> WriteResult:
    """Take rows from the watermark on and merge them into the staging table by key.

    Without a watermark, the largest value already in the staging table is used; a
    caller who keeps the last one spares that scan. Rows at the watermark, of which some
    may arrive late, and rows without a value are taken every time; merging by key makes
    that harmless. Versions of one key, in the table or new, resolve to the newest, and
    one without a value loses. ``partition_by`` keeps the table in partitions, of which
    only those with new rows are rewritten.
    """
    path = zones.table(STAGING, name)
    if watermark is None and path_exists(spark, path):
        watermark = high_water_mark(spark.read.parquet(path), changed_column).first()[0]
    fresh = rows_after(source, changed_column, watermark, inclusive=True, nulls=True)
    if partition_by:
        return upsert_partitions(
            spark, path, fresh, keys, partition_by, [changed_column], keep_newer=True
        )
    return upsert_table(spark, path, fresh, keys, [changed_column], keep_newer=True)


def ingest_changes(
    spark: SparkSession,
    changes: DataFrame,
    zones: Zones,
    name: str,
    log: ChangeLog,
    run_date: str,
    partition_by: Sequence[str] = (),
    horizon: Watermark = None,
) -> tuple[WriteResult, WriteResult]:
    """Apply a change log, deletions included, to the staging table of a source.

    The staging table is a state with tombstones; :func:`publish_current` makes the table
    itself of it. Changes that cannot be applied go to the quarantine of the run date,
    with the reason, and replace those of an earlier attempt. Returns what was written to
    both. The log should be a written table: it is read twice.
    """
    path, held = zones.table(STAGING, name), zones.table(QUARANTINE, f"{name}_changes")
    result = apply_change_log(spark, path, changes, log, partition_by, horizon)
    refused = refused_changes(changes, log, change_horizon(spark, path))
    drop_partition(spark, held, QUARANTINE_RUN, run_date)
    return result, write_table(
        refused.withColumn(QUARANTINE_RUN, F.lit(run_date)),
        held, partition_by=[QUARANTINE_RUN], replace_partitions=True,
    )


def publish_current(
    spark: SparkSession, zones: Zones, name: str, log: ChangeLog, partition_by: Sequence[str] = ()
) -> WriteResult:
    """The live rows of a staged state as the system of record's table."""
    rows = current_rows(spark.read.parquet(zones.table(STAGING, name)), log)
    return write_table(
        rows, zones.table(SOR, name), partition_by=partition_by, rebalance=bool(partition_by)
    )


def stage_table(
    spark: SparkSession,
    zones: Zones,
    name: str,
    rules: Sequence[ColumnRule] = (),
    merge_schema: bool = False,
    run_date: str | None = None,
) -> tuple[WriteResult, WriteResult | None]:
    """Raw to staging: clean by the rules, drop duplicate rows, quarantine bad ones.

    A run date takes only that run of a table kept by date. Without rules it only
    drops duplicates and the second result is None. With rules raw is read and judged
    once: the judged rows are written beside the staging table, split by verdict, and
    both results are made from there. Quarantine keeps every run: rows go into the
    partition of their run date, which a repeated run replaces.
    """
    raw = read_parquet(spark, zones.table(RAW, name), merge_schema)
    if run_date is not None:
        raw = of_run(raw, run_date)
    path = zones.table(STAGING, name)
    if not rules:
        return write_table(drop_duplicate_rows(raw), path), None
    folder = shared_scratch(spark, f"judged-{name}")
    rated = raw.select(
        F.struct(*raw.columns).alias("raw"), reject_reason(rules).alias(REJECT_REASON)
    ).withColumn("rejected", F.col(REJECT_REASON) != "")
    write_table(rated, folder, partition_by=["rejected"])
    kept = spark.read.schema(rated.schema).parquet(folder)
    good = normalise(kept.filter("NOT rejected").select("raw.*"), rules)
    staged = write_table(drop_duplicate_rows(good), path)
    bad = kept.filter("rejected").select("raw.*", REJECT_REASON)
    run, held = run_date or NO_RUN_DATE, zones.table(QUARANTINE, name)
    stamped = bad.withColumn(QUARANTINE_RUN, F.lit(run))
    # A run without bad rows would leave those of its earlier attempt in place.
    drop_partition(spark, held, QUARANTINE_RUN, run)
    return staged, write_table(
        stamped, held, partition_by=[QUARANTINE_RUN], replace_partitions=True
    )


def publish_table(
    spark: SparkSession,
    zones: Zones,
    name: str,
    keys: Sequence[str] = (),
    order_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> WriteResult:
    """Staging to system of record: a full copy, or an upsert when keys are given.

    ``partition_by`` keeps the table in partitions; an upsert then rewrites only those
    that staging has rows for.
    """
    staged = spark.read.parquet(zones.table(STAGING, name))
    path = zones.table(SOR, name)
    if keys and partition_by:
        return upsert_partitions(spark, path, staged, keys, partition_by, order_by)
    if keys:
        return upsert_table(spark, path, staged, keys, order_by)
    return write_table(staged, path, partition_by=partition_by, rebalance=bool(partition_by))


def build_links(
    spark: SparkSession,
    zones: Zones,
    run_date: str,
    run_type: str = "FULL",
    blocks: str | Iterable[str] = ALL_BLOCKS,
    spec: LinkSpec = LINKS,
    null_keys: str = "collapse",
    tables: Callable[[str], DataFrame] | None = None,
) -> WriteResult:
    """Raw to the relationship table in the system of record, replacing it whole.

    A run of some blocks therefore leaves only those blocks in the table. Where raw
    is kept by date, pass ``raw_tables(spark, zones, run_date)`` as ``tables``.
    """
    read = tables or raw_tables(spark, zones)
    links = map_links(read, spec, run_date, run_type, blocks, null_keys)
    return write_table(links, zones.table(SOR, spec.name))


def stamp_bills(
    spark: SparkSession, zones: Zones, run_date: str, name: str = BILL_TABLE, output: str = "JOB_B_OUTPUT"
) -> WriteResult:
    """Copy a raw table to the system of record with ETL_DATE set to this run."""
    raw = spark.read.parquet(zones.table(RAW, name))
    return write_table(with_etl_date(raw, run_date), zones.table(SOR, output))


def audit_of(spec: LinkSpec, audit: AuditSpec = LINK_AUDIT) -> AuditSpec:
    """The audit of a mapping's own table: its first source's rule, its key prefixes."""
    return replace(with_key_prefixes(audit, spec), source_valid=spec.sources[0].valid)


def audit_link_table(
    spark: SparkSession,
    zones: Zones,
    spec: LinkSpec = LINKS,
    thorough: bool = False,
    blocks: str | Iterable[str] = ALL_BLOCKS,
    raise_on_fail: bool = False,
    prescreen: bool = False,
    tables: Callable[[str], DataFrame] | None = None,
    null_keys: str = "collapse",
    checksum_method: str = "xxhash64",
    expected_checksum: str | None = None,
) -> DataFrame:
    """Audit a mapping's table against raw and write the summary.

    The table, the source counted against it and that source's rule come from the spec.
    ``thorough`` adds the Expected Rows and Collapsed Key checks, expecting what
    ``null_keys`` says the build did with null key parts. Failed checks are only
    reported unless ``raise_on_fail`` is set; the summary is written either way.
    ``prescreen`` is explained at :func:`audit_links`; it pays on large tables known to
    hold hardly any repeated key.
    """
    target = spark.read.parquet(zones.table(SOR, spec.name))
    read = tables or raw_tables(spark, zones)
    source = read(spec.sources[0].table)
    audit, expected = audit_of(spec), None
    if thorough:
        select_blocks(spec, blocks)
        counts = expected_link_counts(read, spec, blocks, null_keys)
        expected = counts.agg(F.sum("EXPECTED_ROWS"))
    else:
        audit = replace(audit, key_prefixes={})
    path = zones.table(RECONCILE, spec.name)
    report = audit_links(
        target, source, audit, checksum_method, expected, expected_checksum, prescreen=prescreen
    )
    write_table(report, path)
    report = spark.read.parquet(path)
    if raise_on_fail:
        raise_on_failures(report)
    return report


def reconcile_table(
    spark: SparkSession,
    zones: Zones,
    name: str,
    keys: Sequence[str],
    columns: Sequence[str],
    source_zone: str = STAGING,
    target_zone: str = SOR,
) -> WriteResult:
    """Write every key whose rows differ between two zones; no rows means they agree."""
    wanted = [*keys, *columns]
    source = spark.read.parquet(zones.table(source_zone, name)).select(*wanted)
    target = spark.read.parquet(zones.table(target_zone, name)).select(*wanted)
    return write_table(row_diff(source, target, keys), zones.table(RECONCILE, f"{name}_diff"))


def snapshot_counts(
    spark: SparkSession, zones: Zones, name: str, run_date: str, output: str = "date"
) -> WriteResult:
    """Append the row count of a system-of-record table as a JSON line."""
    summary = count_snapshot(spark.read.parquet(zones.table(SOR, name)), run_date)
    return write_table(summary, zones.table(RECONCILE, output), "append", format="json")
