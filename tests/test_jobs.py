from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.checks import ChecksFailed
from ledgerloom.plans import jobs
from ledgerloom.plans.links import ACCOUNT_TABLE, BILL_TABLE, LINK_TABLE, LINKS
from ledgerloom.sources import sinks
from ledgerloom.sources.files import TableSource
from ledgerloom.sources.zones import QUARANTINE, RAW, RECONCILE, SOR, STAGING, Zones
from tests.test_mapping import FBM, GAM, gam_row
from tests.test_staging import DIRTY, DIRTY_SCHEMA, RULES


@pytest.fixture
def zones(tmp_path):
    return Zones(f"file:{tmp_path}/lake")


@pytest.fixture
def sources(spark, zones):
    sinks.write_table(spark.range(5), zones.table("source", "five"))
    sinks.write_table(spark.range(7), zones.table("source", "seven"))
    return [
        TableSource("five", zones.table("source", "five")),
        TableSource("gone", zones.table("source", "gone")),
        TableSource("seven", zones.table("source", "seven")),
    ]


@pytest.mark.parametrize("workers", [1, 3])
def test_one_bad_table_does_not_stop_the_others(spark, zones, sources, workers):
    with pytest.raises(jobs.IngestFailed, match="1 of 3 tables were not ingested: gone") as caught:
        jobs.ingest_tables(spark, sources, zones, "20240131", workers=workers)
    results = caught.value.results
    assert [(r.table, r.status, r.rows) for r in results] == [
        ("five", "SUCCESS", 5), ("gone", "FAILED", None), ("seven", "SUCCESS", 7),
    ]
    assert all(r.seconds >= 0 for r in results)
    raw = spark.read.parquet(zones.table(RAW, "seven"))
    assert raw.columns == ["id", "ETL_DATE", "INGESTION_TIMESTAMP"]
    assert raw.count() == 7

    log = jobs.run_log(spark, results, "r1", "ingest", RAW)
    jobs.append_run_log(log, zones)
    jobs.append_run_log(log, zones)
    stored = spark.read.parquet(zones.table(RECONCILE, "etl_pipeline_audit"))
    assert stored.count() == 6
    failed = stored.filter("status = 'FAILED'").first()
    assert failed.table_name == "gone" and failed.message and failed.start_time <= failed.end_time


def test_ingest_again_gives_the_same_table(spark, zones, sources):
    for by_date in (False, True):
        for _ in range(2):
            jobs.ingest_tables(spark, sources[:1], zones, "20240131", by_date=by_date)
        assert spark.read.parquet(zones.table(RAW, "five")).count() == 5


def test_ingest_reads_the_source_once(spark, zones, sources):
    """The count comes from the write: one accumulator hit per row, not one per action."""
    seen = spark.sparkContext.accumulator(0)

    class Counted(TableSource):
        def read(self, session):
            def count(batches):
                for batch in batches:
                    seen.add(len(batch))
                    yield batch

            return super().read(session).mapInPandas(count, "id bigint")

    source = Counted("five", sources[0].location)
    assert jobs.ingest_tables(spark, [source], zones, "20240131")[0].rows == 5
    assert seen.value == 5


def banking(spark, zones, accounts, bills):
    sinks.write_table(spark.createDataFrame(accounts, GAM), zones.table(RAW, ACCOUNT_TABLE))
    sinks.write_table(spark.createDataFrame(bills, FBM), zones.table(RAW, BILL_TABLE))


def test_links_and_audit(spark, zones):
    banking(spark, zones, [gam_row(), gam_row("A2", scheme="CLA")], [("B1", "N", "Y")])
    assert jobs.build_links(spark, zones, "20240131").rows == 8
    report = jobs.audit_link_table(spark, zones, thorough=True, raise_on_fail=True)
    assert {r.STATUS for r in report.collect()} == {"PASS"}
    assert report.columns == ["CHECK_NAME", "STATUS", "DETAILS", "CHECK_TIMESTAMP"]

    assert jobs.build_links(spark, zones, "20240131", blocks="7").rows == 2
    assert spark.read.parquet(zones.table(SOR, LINK_TABLE)).count() == 2
    report = {r.CHECK_NAME: r.STATUS for r in
              jobs.audit_link_table(spark, zones, thorough=True).collect()}
    assert report["Row Count"] == "PASS" and report["Expected Rows"] == "FAIL"


def test_raw_kept_by_date_is_read_one_run_at_a_time(spark, zones):
    for run_date, rows in (("20240130", [gam_row()]), ("20240131", [gam_row(), gam_row("A2")])):
        for name, data, schema in ((ACCOUNT_TABLE, rows, GAM), (BILL_TABLE, [], FBM)):
            location = zones.table("source", f"{name}_{run_date}")
            sinks.write_table(spark.createDataFrame(data, schema), location)
            jobs.ingest_tables(
                spark, [TableSource(name, location)], zones, run_date, by_date=True
            )
    run = jobs.raw_tables(spark, zones, "20240131")
    plan = run(ACCOUNT_TABLE)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ETL_DATE" in plan
    assert {r.ETL_DATE for r in run(ACCOUNT_TABLE).collect()} == {"20240131"}
    assert jobs.build_links(spark, zones, "20240131", tables=jobs.raw_tables(
        spark, zones, "20240130"), blocks="1,2,3,7").rows == 3
    assert jobs.build_links(spark, zones, "20240131", tables=run, blocks="1,2,3,7").rows == 6
    report = jobs.audit_link_table(spark, zones, tables=run)
    assert report.filter("CHECK_NAME = 'Row Count'").first().DETAILS == (
        "Raw GAM Valid Rows: 2, SOR Rows: 6"
    )
    assert jobs.stage_table(spark, zones, ACCOUNT_TABLE, run_date="20240130")[0].rows == 1


def test_a_failed_audit_is_written_before_it_raises(spark, zones):
    banking(spark, zones, [gam_row(acid=None)], [])
    jobs.build_links(spark, zones, "20240131", blocks="2,3,7")
    assert {r.STATUS for r in jobs.audit_link_table(spark, zones).collect()} == {"PASS", "FAIL"}
    with pytest.raises(ChecksFailed, match="Duplicate Key"):
        jobs.audit_link_table(spark, zones, raise_on_fail=True)
    assert spark.read.parquet(zones.table(RECONCILE, LINK_TABLE)).count() == 5


def test_stage_and_publish(spark, zones):
    raw = spark.createDataFrame(DIRTY + DIRTY[:1], DIRTY_SCHEMA)
    sinks.write_table(raw, zones.table(RAW, "t"))
    staged, rejected = jobs.stage_table(spark, zones, "t", RULES)
    assert (staged.rows, rejected.rows) == (2, 2)
    assert spark.read.parquet(zones.table(QUARANTINE, "t")).count() == 2
    assert jobs.publish_table(spark, zones, "t").rows == 2
    assert jobs.publish_table(spark, zones, "t", keys=["key"]).rows == 2
    staged, rejected = jobs.stage_table(spark, zones, "t")
    assert staged.rows == 4 and rejected is None


def test_clean_tables_are_staged_in_one_pass(spark, zones):
    sinks.write_table(spark.createDataFrame(DIRTY[:2], DIRTY_SCHEMA), zones.table(RAW, "t"))
    staged, rejected = jobs.stage_table(spark, zones, "t", RULES)
    assert (staged.rows, rejected.rows) == (2, 0)
    assert not list(spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true").load(zones.table(QUARANTINE, "t")).collect())


def test_raw_is_judged_once(spark, zones, monkeypatch):
    real = jobs.read_parquet
    sinks.write_table(spark.createDataFrame(DIRTY, DIRTY_SCHEMA), zones.table(RAW, "t"))
    judged = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            judged.add(len(batch))
            yield batch

    monkeypatch.setattr(
        jobs, "read_parquet",
        lambda *a, **k: (lambda df: df.mapInPandas(count, df.schema))(real(*a, **k)),
    )
    staged, rejected = jobs.stage_table(spark, zones, "t", RULES)
    assert judged.value == len(DIRTY) and staged.rows + rejected.rows == len(DIRTY)


def test_quarantine_keeps_every_run(spark, zones):
    path = zones.table(RAW, "t")
    for run_date, rows in (("20240130", DIRTY), ("20240131", DIRTY), ("20240131", DIRTY[:2])):
        raw = spark.createDataFrame(rows, DIRTY_SCHEMA).withColumn("ETL_DATE", F.lit(run_date))
        sinks.write_table(raw, path, partition_by=["ETL_DATE"], replace_partitions=True)
        jobs.stage_table(spark, zones, "t", RULES, run_date=run_date)
    held = spark.read.parquet(zones.table(QUARANTINE, "t"))
    assert {str(r[jobs.QUARANTINE_RUN]) for r in held.collect()} == {"20240130"}
    assert held.count() == 2


def test_run_log_messages_are_whole(spark):
    now = jobs._now()
    result = jobs.StepResult("t", jobs.FAILED, None, now, now, "m" * 5000)
    assert jobs.run_log(spark, [result], "r", "p", "s").first().message == "m" * 5000


def test_an_audit_reads_its_own_specs_table(spark, zones):
    spec = replace(LINKS, name="OTHER", sources=LINKS.sources[:1])
    banking(spark, zones, [gam_row(), gam_row("A2")], [("B1", "N", "Y")])
    jobs.build_links(spark, zones, "20240131")
    jobs.build_links(spark, zones, "20240131", spec=spec, blocks="7")
    report = jobs.audit_link_table(spark, zones, spec)
    assert report.filter("CHECK_NAME = 'Row Count'").first().DETAILS == (
        "Raw GAM Valid Rows: 2, SOR Rows: 2"
    )


def test_a_rejecting_build_is_expected_to_reject(spark, zones):
    banking(spark, zones, [gam_row(), gam_row(acid=None)], [])
    jobs.build_links(spark, zones, "20240131", null_keys="reject")
    kinds = {
        how: {r.CHECK_NAME: r.STATUS for r in
              jobs.audit_link_table(spark, zones, thorough=True, null_keys=how).collect()}
        for how in ("reject", "collapse")
    }
    assert kinds["reject"]["Expected Rows"] == "PASS" and kinds["collapse"]["Expected Rows"] == "FAIL"


def test_increments_keep_partitions_and_untouched_files(spark, zones):
    rows = spark.range(40).select(
        (F.col("id") % 4).cast("int").alias("p"), "id", F.col("id").alias("version")
    )
    load = lambda df: jobs.ingest_increment(
        spark, df, zones, "t", ["id", "p"], "version", partition_by=["p"]
    )
    load(rows.filter("id < 38"))
    path = zones.table(STAGING, "t")
    before = {f for f in spark.read.parquet(path).inputFiles() if "/p=0/" in f}
    load(rows)
    spark.catalog.refreshByPath(path)
    table = spark.read.parquet(path)
    assert table.count() == 40 and before <= set(table.inputFiles())
    assert sinks.partition_columns(spark, path) == ["p"] and len(table.inputFiles()) <= 4
    staged = jobs.publish_table(spark, zones, "t", keys=["id", "p"], partition_by=["p"])
    assert staged.rows == 40 and sinks.partition_columns(spark, zones.table(SOR, "t")) == ["p"]


def test_reconcile_table(spark, zones):
    rows = spark.range(10).select("id", F.col("id").alias("v"))
    sinks.write_table(rows, zones.table(STAGING, "t"))
    sinks.write_table(rows, zones.table(SOR, "t"))
    assert jobs.reconcile_table(spark, zones, "t", ["id"], ["v"]).rows == 0
    edited = rows.filter("id > 0").withColumn("v", F.when(F.col("id") == 5, 0).otherwise(F.col("v")))
    sinks.write_table(edited, zones.table(SOR, "t"))
    assert jobs.reconcile_table(spark, zones, "t", ["id"], ["v"]).rows == 2
    diff = spark.read.parquet(zones.table(RECONCILE, "t_diff"))
    assert {r.id: r.status for r in diff.collect()} == {0: "MISSING", 5: "CHANGED"}


def test_increments_take_nothing_twice(spark, zones):
    rows = spark.range(10).select("id", F.col("id").alias("version"))
    jobs.ingest_increment(spark, rows.filter("id < 6"), zones, "t", ["id"], "version")
    newer = rows.unionByName(rows.filter("id = 2").withColumn("version", F.lit(99)))
    for _ in range(2):
        jobs.ingest_increment(spark, newer, zones, "t", ["id"], "version")
    table = spark.read.parquet(zones.table(STAGING, "t"))
    assert table.count() == 10
    assert table.filter("id = 2").first().version == 99


def test_snapshots_are_appended(spark, zones):
    sinks.write_table(spark.range(3), zones.table(SOR, "t"))
    for day in ("2024-01-30", "2024-01-31"):
        jobs.snapshot_counts(spark, zones, "t", day)
    lines = spark.read.text(zones.table(RECONCILE, "date")).collect()
    assert sorted(r.value for r in lines) == [
        '{"row_count":3,"run_date":"2024-01-30"}', '{"row_count":3,"run_date":"2024-01-31"}',
    ]


def test_stamped_bills(spark, zones):
    banking(spark, zones, [gam_row()], [("B1", "N", "Y"), ("B2", "Y", "N")])
    assert jobs.stamp_bills(spark, zones, "20240131").rows == 2
    out = spark.read.parquet(zones.table(SOR, "JOB_B_OUTPUT"))
    assert {r.ETL_DATE for r in out.collect()} == {"20240131"}
