"""Kept audit state, history of rows, and rules between tables."""

import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import references
from ledgerloom.operators.checks import AuditSpec, audit_links
from ledgerloom.plans import audit_state, history
from ledgerloom.sources import sinks

FIELDS = "a string, b string, v string, day string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def spec(spark):
    contract = spark.createDataFrame([], FIELDS).schema
    return AuditSpec(("a", "b"), ("a", "b", "v"), contract, "true", "Source", "SOR")


def both_audits(spark, path, state, spec):
    table = spark.read.parquet(path)
    plain = audit_links(table, table, spec, stamped=False)
    kept = audit_state.audit_from_state(spark, path, state, table, spec, stamped=False)
    return rows(plain), rows(kept)


def write(spark, data, path, **how):
    df = spark.createDataFrame(data, FIELDS)
    sinks.write_table(df, path, partition_by=["day"], **how)


def test_state_equals_audit_through_changes(spark, spec, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "s")
    base = [(str(i), str(i % 7), "x", f"d {i % 4}/é") for i in range(200)]
    write(spark, base, path)
    plain, kept = both_audits(spark, path, state, spec)
    assert plain == kept
    # A key of one partition comes again in another, a null one in a new one.
    write(spark, [("8", "1", "y", "d 1/é"), ("1", "1", "y", "d 1/é"), (None, "1", "y", "new")], path, mode="append")
    plain, kept = both_audits(spark, path, state, spec)
    assert plain == kept
    assert any("Found 2 duplicate" in r[2] for r in kept)
    # A partition is written again, another is dropped.
    write(spark, [("1000", "1", "z", "d 0/é")], path, replace_partitions=True)
    value = [v for v in sinks.partition_values(spark, path, "day") if "2" in v][0]
    assert sinks.drop_partition(spark, path, "day", value)
    plain, kept = both_audits(spark, path, state, spec)
    assert plain == kept


def test_only_changed_partitions_are_read(spark, spec, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "s")
    write(spark, [(str(i), "k", "x", f"d{i % 5}") for i in range(50)], path)
    first = audit_state.refresh_audit_state(spark, path, state, spec)
    assert first == [f"day=d{i}" for i in range(5)]
    assert audit_state.refresh_audit_state(spark, path, state, spec) == []
    write(spark, [("9", "9", "x", "d3")], path, mode="append")
    # Files that cannot be read show what is read: only the partition added to.
    # The first one has to tell the columns.
    for day in ("d1", "d2", "d4"):
        folder = tmp_path / "t" / f"day={day}"
        for name in os.listdir(folder):
            if name.endswith(".parquet"):
                (folder / name).write_bytes(b"not a table")
    assert audit_state.refresh_audit_state(spark, path, state, spec) == ["day=d3"]
    table = spark.createDataFrame([], FIELDS)
    sums = spark.read.parquet(f"{state}/measures").agg(F.sum("target_rows")).first()[0]
    assert sums == 51 and table.isEmpty()


def test_state_cut_short_is_made_good(spark, spec, tmp_path, monkeypatch):
    path, state = str(tmp_path / "t"), str(tmp_path / "s")
    write(spark, [(str(i), "k", "x", f"d{i % 3}") for i in range(30)], path)
    audit_state.refresh_audit_state(spark, path, state, spec)
    write(spark, [("1", "k", "x", "d2")], path, mode="append")
    whole, calls = sinks.replace_table, []

    def cut(df, target):
        calls.append(target)
        if len(calls) == 2:
            raise OSError("lost")
        return whole(df, target)

    monkeypatch.setattr(sinks, "replace_table", cut)
    with pytest.raises(OSError):
        audit_state.refresh_audit_state(spark, path, state, spec)
    monkeypatch.undo()
    plain, kept = both_audits(spark, path, state, spec)
    assert plain == kept


def test_state_of_a_flat_empty_or_otherwise_measured_table(spark, spec, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "s")
    flat = spark.createDataFrame([("a", "b", None, "d"), ("a", "b", "v", "d")], FIELDS)
    sinks.write_table(flat, path)
    plain, kept = both_audits(spark, path, state, spec)
    assert plain == kept
    assert audit_state.refresh_audit_state(spark, path, state, spec, "sha256") == [""]
    sinks.write_table(flat.filter("a = 'none'"), path)
    plain, kept = both_audits(spark, path, state, spec)
    assert plain == kept
    sinks.write_table(flat.drop("b"), path)
    with pytest.raises(ValueError, match="without"):
        audit_state.refresh_audit_state(spark, path, state, spec)


@pytest.mark.parametrize("few_prints", [False, True])
def test_history_keeps_each_row_once(spark, tmp_path, few_prints):
    """Against sets of rows, also where nearly all fingerprints collide."""
    seen, index = str(tmp_path / "h"), str(tmp_path / "i")
    draw, known = random.Random(5), set()
    how = {"fingerprint": lambda c: F.pmod(history.row_print(c), F.lit(3))} if few_prints else {}
    for day in ("1", "2", "3"):
        data = [
            (draw.choice([None, "", "a", "b"]), draw.choice([None, 0, 1, 2]), draw.choice([None, 1.5]))
            for _ in range(40)
        ]
        df = spark.createDataFrame(data, "x string, y long, z double")
        # A run again of the same day gives the same.
        for _ in range(2):
            result = history.dedup_against_history(spark, df, day, seen, index, **how)
            assert result.rows == len(set(data) - known)
        known |= set(data)
    table = spark.read.parquet(seen)
    assert rows(table.select("x", "y", "z")) == sorted(known, key=repr)
    assert spark.read.parquet(index).count() == len(known)


def test_history_of_nothing_and_of_other_columns(spark, tmp_path):
    seen, index = str(tmp_path / "h"), str(tmp_path / "i")
    none = spark.createDataFrame([], "x string, y long")
    assert history.dedup_against_history(spark, none, "1", seen, index).rows == 0
    one = spark.createDataFrame([("a", 1)], "x string, y long")
    assert history.dedup_against_history(spark, one, "2", seen, index).rows == 1
    assert history.dedup_against_history(spark, none, "3", seen, index).rows == 0
    with pytest.raises(ValueError, match="not those"):
        history.dedup_against_history(spark, one.drop("y"), "4", seen, index)
    with pytest.raises(ValueError, match="columns of the history"):
        history.dedup_against_history(spark, one.withColumn(history.DAY, F.lit("")), "4", seen, index)


def test_history_reads_only_days_that_are_met(spark, tmp_path):
    seen, index = str(tmp_path / "h"), str(tmp_path / "i")
    for day in ("1", "2", "3"):
        df = spark.range(10).select(F.concat(F.lit(f"{day}-"), F.col("id").cast("string")).alias("x"))
        history.dedup_against_history(spark, df, day, seen, index)
    for name in os.listdir(tmp_path / "h" / "SEEN_DAY=1"):
        if name.endswith(".parquet"):
            (tmp_path / "h" / "SEEN_DAY=1" / name).write_bytes(b"not a table")
    df = spark.createDataFrame([("2-1",), ("3-1",), ("4-1",)], "x string")
    # The first day's rows cannot be read and need not be.
    assert history.dedup_against_history(spark, df, "4", seen, index).rows == 1


def test_rules_of_two_columns_and_a_hot_parent(spark):
    child = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("a"),
        F.when(F.col("id") % 100 != 1, F.lit("x")).alias("b"),
    )
    parent = spark.range(45).select(F.col("id").alias("p"), F.lit("x").alias("q"))
    rule = references.Reference("r", "c", ("a", "b"), "p", ("p", "q"), allow_null=False)
    got = references.referential_report({"c": child, "p": parent}, [rule]).first().asDict()
    data = [tuple(r) for r in child.collect()]
    nulls = [r for r in data if r[1] is None]
    orphans = [r for r in data if r[1] is not None and r[0] >= 45]
    assert got["status"] == "FAIL" and got["child_rows"] == len(data)
    assert (got["null_rows"], got["orphan_rows"]) == (len(nulls), len(orphans))
    assert (got["orphan_keys"], got["repeated_parents"]) == (len(set(orphans)), 0)
    found = references.orphan_rows(child, parent, rule)
    assert rows(found) == sorted(nulls + orphans, key=repr)
    plan = references.key_usage(child, parent, rule)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "partial_sum" in plan


def test_rules_with_nulls_casts_and_empty_tables(spark):
    child = spark.createDataFrame([("1", 1), ("x", 1), (None, 1), ("2", None)], "a string, b long")
    parent = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (2, None), (3, 3)], "p long, q long")
    rule = references.Reference("r", "c", ("a", "b"), "p", ("p", "q"))
    got = references.referential_report({"c": child, "p": parent}, [rule]).first().asDict()
    assert got == {
        "rule_name": "r", "status": "FAIL", "child_rows": 4, "null_rows": 2, "orphan_rows": 1,
        "orphan_keys": 1, "repeated_parents": 1, "unused_parents": 1,
    }
    assert rows(references.orphan_rows(child, parent, rule)) == [("x", 1)]
    empty = {"c": child.filter("false"), "p": parent.filter("false")}
    assert references.referential_report(empty, [rule]).first()["status"] == "PASS"
    assert references.orphan_rows(child, empty["p"], rule).count() == 2
    with pytest.raises(ValueError):
        references.Reference("r", "c", ("a",), "p", ())
