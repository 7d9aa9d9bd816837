import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import merge
from ledgerloom.sources import sinks

SCHEMA = "k string, v string, seen int"
BASE = [("a", "1", 1), ("b", "2", 1), (None, "0", 1)]
NEWS = [("b", "3", 2), ("b", "4", 3), ("c", "5", 1), (None, "9", 2)]
MERGED = {("a", "1", 1), ("b", "4", 3), ("c", "5", 1), (None, "9", 2)}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def base(spark):
    return spark.createDataFrame(BASE, SCHEMA)


@pytest.fixture
def news(spark):
    return spark.createDataFrame(NEWS, SCHEMA)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def test_merge_once_equals_merge_twice(base, news):
    once = merge.merge_rows(base, news, ["k"], ["seen"])
    assert set(rows(once)) == MERGED
    assert rows(merge.merge_rows(once, news, ["k"], ["seen"])) == rows(once)


def test_latest_breaks_ties_the_same_way_every_time(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 1), ("a", None, 1)], SCHEMA)
    for parts in (1, 3):
        assert rows(merge.latest_per_key(df.repartition(parts), ["k"], ["seen"])) == [("a", "y", 1)]
    assert rows(merge.latest_per_key(df.select("k"), ["k"])) == [("a",)]


def test_watermarks(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2, 3)), (3, None)],
        "id int, at timestamp_ntz",
    )
    assert merge.rows_after(df, "at", None).count() == 3
    assert merge.rows_after(df, "at", datetime(2024, 1, 1)).count() == 1
    assert merge.rows_after(df, "at", "2024-01-01 23:59:59").count() == 1
    assert merge.rows_after(df, "id", 2).count() == 1
    mark = merge.high_water_mark(df, "at").first()[0]
    assert merge.rows_after(df, "at", mark).count() == 0
    assert merge.unplaced_rows(df, "at").first()[0] == 1


def test_upsert_table_twice_and_from_nothing(spark, base, news, path):
    sinks.upsert_table(spark, path, base, ["k"], ["seen"])
    for _ in range(2):
        result = sinks.upsert_table(spark, path, news, ["k"], ["seen"])
    assert result.rows == 4
    assert set(rows(spark.read.parquet(path))) == MERGED


@pytest.mark.parametrize("limit", ["-1", "10m"])
def test_both_join_strategies_merge_alike(spark, base, news, path, limit):
    sinks.write_table(base, path)
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        sinks.upsert_table(spark, path, news, ["k"], ["seen"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert set(rows(spark.read.parquet(path))) == MERGED


def test_join_strategy_can_be_asked_for(base, news):
    fresh = merge.latest_per_key(news, ["k"], ["seen"])

    def plan(broadcast):
        merged = merge.replace_keys(base, fresh, ["k"], broadcast)
        return merged._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(True)
    assert "SortMergeJoin" in plan(False) and "BroadcastHashJoin" not in plan(False)


def test_updates_are_read_once(spark, base, news, path, tmp_path):
    """A source that changes between two reads must not lose or double keys."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    sinks.write_table(base, path)
    sinks.upsert_table(spark, path, news.mapInPandas(count, SCHEMA), ["k"], ["seen"])
    assert seen.value == len(NEWS)
    assert [p.name for p in tmp_path.iterdir()] == [path.rsplit("/", 1)[1]]


def test_updates_may_add_columns_but_not_lack_them(spark, base, news, path):
    sinks.write_table(base, path)
    sinks.upsert_table(spark, path, news.withColumn("extra", F.lit("e")), ["k"], ["seen"])
    got = {r.k: r.extra for r in spark.read.parquet(path).collect()}
    assert got == {"a": None, "b": "e", "c": "e", None: "e"}
    with pytest.raises(ValueError, match="seen"):
        sinks.upsert_table(spark, path, news.drop("seen"), ["k"])


def test_a_failed_write_keeps_the_table(spark, base, news, path, tmp_path):
    sinks.write_table(base, path)
    broken = news.withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        sinks.upsert_table(spark, path, broken, ["k"])
    assert rows(spark.read.parquet(path)) == sorted(BASE, key=repr)
    assert [p.name for p in tmp_path.iterdir() if "__" in p.name] == []


def test_recover_after_a_cut_swap(spark, base, news, path):
    sinks.write_table(base, path + "__previous")
    assert sinks.recover_table(spark, path)
    assert rows(spark.read.parquet(path)) == sorted(BASE, key=repr)

    sinks.write_table(news, path + "__previous")
    assert sinks.recover_table(spark, path)
    assert rows(spark.read.parquet(path)) == sorted(BASE, key=repr)
    assert not sinks.path_exists(spark, path + "__previous")
    assert not sinks.recover_table(spark, path)


@pytest.mark.parametrize("listed", [1_000, 1])
def test_upsert_partitions_rewrites_only_touched_ones(spark, path, monkeypatch, listed):
    monkeypatch.setattr(sinks, "PARTITIONS_PER_JOB", listed)
    schema = "day string, region int, k string, v string"
    keys, by = ["day", "region", "k"], ["day", "region"]
    old = [("d1", 1, "a", "1"), ("d1", 2, "a", "2"), ("d2", 1, "a", "3"), ("d2", 1, "b", "4")]
    sinks.upsert_partitions(spark, path, spark.createDataFrame(old, schema), keys, by)
    untouched = set(spark.read.parquet(path).filter("day = 'd1' AND region = 1").inputFiles())
    new = spark.createDataFrame(
        [("d2", 1, "a", "9"), ("d1", 2, "z", "8"), ("d3", 1, "a", "7")], schema
    )
    for _ in range(2):
        sinks.upsert_partitions(spark, path, new, keys, by)
    spark.catalog.refreshByPath(path)
    table = spark.read.parquet(path)
    assert rows(table.select("day", "region", "k", "v")) == [
        ("d1", 1, "a", "1"), ("d1", 2, "a", "2"), ("d1", 2, "z", "8"),
        ("d2", 1, "a", "9"), ("d2", 1, "b", "4"), ("d3", 1, "a", "7"),
    ]
    kept = set(table.filter("day = 'd1' AND region = 1").inputFiles())
    assert untouched & kept
    with pytest.raises(ValueError, match="extra"):
        sinks.upsert_partitions(spark, path, new.withColumn("extra", F.lit(1)), keys, by)
    with pytest.raises(ValueError, match="part of the key"):
        sinks.upsert_partitions(spark, path, new, ["k"], by)


@pytest.mark.parametrize("by", [["day"], ["day", "region"]])
@pytest.mark.parametrize("listed", [1_000, 1])
def test_null_and_blank_partitions_are_merged_not_lost(spark, path, monkeypatch, by, listed):
    monkeypatch.setattr(sinks, "PARTITIONS_PER_JOB", listed)
    schema, keys = "day string, region int, k string, v string", ["day", "region", "k"]
    old = [(None, 1, "a", "1"), (None, 1, "b", "2"), ("d1", 1, "c", "3"), (None, 2, "e", "5")]
    sinks.upsert_partitions(spark, path, spark.createDataFrame(old, schema), keys, by)
    new = [(None, 1, "a", "9"), ("", 1, "d", "4")]
    sinks.upsert_partitions(spark, path, spark.createDataFrame(new, schema), keys, by)
    spark.catalog.refreshByPath(path)
    assert rows(spark.read.parquet(path).select("day", "region", "k", "v")) == sorted(
        [(None, 1, "a", "9"), (None, 1, "b", "2"), (None, 1, "d", "4"), (None, 2, "e", "5"),
         ("d1", 1, "c", "3")],
        key=repr,
    )


def test_more_partitions_than_a_job_takes_are_pruned_all_the_same(spark, path, monkeypatch):
    monkeypatch.setattr(sinks, "PARTITIONS_PER_JOB", 3)
    table = spark.range(40).select((F.col("id") % 10).cast("int").alias("p"), "id", F.lit("old").alias("v"))
    sinks.write_table(table, path, partition_by=["p"], rebalance=True)
    untouched = {f for f in spark.read.parquet(path).inputFiles() if "/p=8/" in f or "/p=9/" in f}
    news = table.filter("p < 8 AND id < 10").withColumn("v", F.lit("new"))
    assert sinks.upsert_partitions(spark, path, news, ["p", "id"], ["p"]).rows == 32
    spark.catalog.refreshByPath(path)
    got = spark.read.parquet(path)
    assert got.filter("v = 'new'").count() == 8 and got.count() == 40
    assert len(untouched) == 2 and untouched <= set(got.inputFiles())
    assert len(got.inputFiles()) <= 10
    picked = sinks.rows_of_partitions(got, ["p"], [(1,), (2,)])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "p#" in plan.split("PartitionFilters: [")[1][:20]


def test_a_table_in_partitions_is_not_flattened(spark, base, path):
    sinks.write_table(base.withColumn("day", F.lit("d1")), path, partition_by=["day"])
    assert sinks.partition_columns(spark, path) == ["day"]
    with pytest.raises(ValueError, match="upsert_partitions"):
        sinks.upsert_table(spark, path, base.withColumn("day", F.lit("d1")), ["k"])


def test_a_newer_row_of_the_table_stands(spark, path):
    old = spark.createDataFrame([("a", "1", 5), ("b", "2", None), ("c", "3", 1)], SCHEMA)
    late = spark.createDataFrame([("a", "x", 3), ("b", "y", None), ("c", "z", None), ("d", "w", None)], SCHEMA)
    sinks.write_table(old, path)
    for _ in range(2):
        sinks.upsert_table(spark, path, late, ["k"], ["seen"], keep_newer=True)
        assert set(rows(spark.read.parquet(path))) == {
            ("a", "1", 5), ("b", "y", None), ("c", "3", 1), ("d", "w", None),
        }


def test_late_ties_and_rows_without_a_stamp_are_taken(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 20), (4, None), (5, 30)], "id int, at int")
    assert rows(merge.rows_after(df, "at", 20, inclusive=True, nulls=True).select("id")) == [(2,), (3,), (4,), (5,)]
    assert rows(merge.rows_after(df, "at", 20).select("id")) == [(5,)]
