"""Release of quarantined rows, archives of raw days, resumed runs."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import staging
from ledgerloom.plans import jobs, upkeep
from ledgerloom.sources import sinks
from ledgerloom.sources.files import TableSource
from ledgerloom.sources.zones import QUARANTINE, RAW, STAGING, Zones

STRICT = (staging.ColumnRule("n", "int"), staging.ColumnRule("k"))
MILD = (staging.ColumnRule("n", "int", null_tokens=("", "?")), staging.ColumnRule("k"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def zones(tmp_path):
    return Zones(str(tmp_path))


def held_rows(spark, zones):
    data = [("1", "a"), ("?", "b"), ("?", "b"), ("x", "c"), ("?", None), (None, "d")]
    sinks.write_table(spark.createDataFrame(data, "n string, k string"), zones.table(RAW, "t"))
    jobs.stage_table(spark, zones, "t", STRICT)


def test_release_moves_rows_once(spark, zones):
    held_rows(spark, zones)
    released, kept = upkeep.release_quarantine(spark, zones, "t", MILD)
    assert (released.rows, kept.rows) == (2, 1)
    want = sorted([(1, "a"), (None, "b"), (None, None), (None, "d")], key=repr)
    assert rows(spark.read.parquet(zones.table(STAGING, "t"))) == want
    released, kept = upkeep.release_quarantine(spark, zones, "t", MILD)
    assert (released.rows, kept.rows) == (0, 1)
    assert rows(spark.read.parquet(zones.table(STAGING, "t"))) == want
    held = spark.read.parquet(zones.table(QUARANTINE, "t")).collect()
    assert [(r["n"], r["k"], r["REJECT_REASON"]) for r in held] == [("x", "c", "n: not a int")]


def test_release_cut_short_is_finished_by_the_next(spark, zones, monkeypatch):
    held_rows(spark, zones)
    whole = sinks.write_table

    def cut(df, path, *args, **how):
        if path == zones.table(QUARANTINE, "t"):
            raise OSError("lost")
        return whole(df, path, *args, **how)

    monkeypatch.setattr(sinks, "write_table", cut)
    with pytest.raises(OSError):
        upkeep.release_quarantine(spark, zones, "t", MILD)
    monkeypatch.undo()
    released, kept = upkeep.release_quarantine(spark, zones, "t", MILD)
    assert (released.rows, kept.rows) == (0, 1)
    assert spark.read.parquet(zones.table(STAGING, "t")).count() == 4
    with pytest.raises(ValueError, match="do not give"):
        upkeep.release_quarantine(spark, zones, "t", (staging.ColumnRule("n"), staging.ColumnRule("k")))


def landed_days(spark, zones):
    data = [(i, None if i % 3 else "", f"2024010{i % 3 + 1}") for i in range(30)]
    df = spark.createDataFrame(data, f"a long, b string, {upkeep.RAW_DAY} string")
    sinks.write_table(df, zones.table(RAW, "t"), partition_by=[upkeep.RAW_DAY])


def test_days_are_moved_after_they_are_verified(spark, zones):
    landed_days(spark, zones)
    assert upkeep.archive_days(spark, zones, "t", "20240103") == ["20240101", "20240102"]
    assert upkeep.archive_days(spark, zones, "t", "20240103") == []
    assert sinks.partition_values(spark, zones.table(RAW, "t"), upkeep.RAW_DAY) == ["20240103"]
    assert rows(upkeep.archive_report(spark, zones, "t")) == [
        ("20240101", 10, True), ("20240102", 10, True)
    ]
    folder = f"{zones.table(upkeep.ARCHIVE, 't')}/{upkeep.RAW_DAY}=20240102"
    spark.createDataFrame([(99, "odd")], "a long, b string").write.mode("append").parquet(folder)
    assert rows(upkeep.archive_report(spark, zones, "t"))[1] == ("20240102", 10, False)


def test_raw_stays_where_the_archive_is_not_right(spark, zones, monkeypatch):
    landed_days(spark, zones)
    whole = sinks.write_table

    def losing(df, path, *args, **how):
        return whole(df.filter("a <> 4") if "a" in df.columns else df, path, *args, **how)

    monkeypatch.setattr(sinks, "write_table", losing)
    with pytest.raises(upkeep.ArchiveUnverified, match="20240102"):
        upkeep.archive_days(spark, zones, "t", "20240103")
    monkeypatch.undo()
    assert spark.read.parquet(zones.table(RAW, "t")).count() == 30
    assert upkeep.archive_days(spark, zones, "t", "20240103") == ["20240101", "20240102"]
    assert all(r["verified"] for r in upkeep.archive_report(spark, zones, "t").collect())


@pytest.mark.parametrize("by_date", [False, True])
def test_a_resumed_run_reads_only_what_is_left(spark, zones, tmp_path, monkeypatch, by_date):
    for name in ("a", "c"):
        sinks.write_table(spark.range(5), str(tmp_path / "src" / name))
    given = [TableSource(n, str(tmp_path / "src" / n)) for n in ("a", "b", "c")]
    run, reads, read = upkeep.Run("r1", "p"), [], TableSource.read

    def counted(source, session):
        reads.append(source.name)
        return read(source, session)

    monkeypatch.setattr(TableSource, "read", counted)
    with pytest.raises(jobs.IngestFailed):
        upkeep.ingest_resumed(spark, given, zones, "20240101", run, by_date)
    sinks.write_table(spark.range(7), str(tmp_path / "src" / "b"))
    results = upkeep.ingest_resumed(spark, given, zones, "20240101", run, by_date)
    assert reads == ["a", "b", "c", "b"]
    assert [(r.table, r.rows) for r in results] == [("a", 5), ("b", 7), ("c", 5)]
    # What the log names but raw has lost is read again, and so is all of another run.
    assert upkeep.finished_tables(spark, zones, run) == {"a": 5, "b": 7, "c": 5}
    os.rename(zones.table(RAW, "c"), str(tmp_path / "gone"))
    upkeep.ingest_resumed(spark, given, zones, "20240101", run, by_date)
    upkeep.ingest_resumed(spark, given, zones, "20240102", upkeep.Run("r2", "p"), by_date)
    assert reads == ["a", "b", "c", "b", "c", "a", "b", "c"]


def test_increments_go_on_from_the_kept_watermark(spark, zones):
    def load(*data):
        source = spark.createDataFrame(data, "k long, at date, v string") if data else none
        upkeep.ingest_increment_kept(spark, source.withColumn("at", F.col("at").cast("date")), zones, "t", ["k"], "at")
        return {r["k"]: r["v"] for r in spark.read.parquet(zones.table(STAGING, "t")).collect()}

    none = spark.createDataFrame([], "k long, at date, v string")
    day = [datetime.date(2024, 1, d) for d in range(1, 6)]
    assert upkeep.kept_watermark(spark, zones, "t") is None
    assert load((1, day[0], "a"), (2, day[2], "a")) == {1: "a", 2: "a"}
    assert upkeep.kept_watermark(spark, zones, "t") == "2024-01-03"
    # Rows before the watermark are not taken, those at it, after it and without a date are.
    found = load((1, day[1], "b"), (2, day[2], "a"), (3, day[2], "b"), (4, day[4], "b"), (5, None, "b"))
    assert found == {1: "a", 2: "a", 3: "b", 4: "b", 5: "b"}
    assert upkeep.kept_watermark(spark, zones, "t") == "2024-01-05"
    assert load() == found and upkeep.kept_watermark(spark, zones, "t") == "2024-01-05"
    assert upkeep.kept_watermark(spark, zones, "other") is None
