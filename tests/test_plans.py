"""Physical plans: what reaches the scan, what shuffles, and that hot keys stay harmless."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.catalogue import QUERIES
from ledgerloom.operators import checks, compare, merge, staging

SF_DIR = "/root/testdata/sf0.001"

# Queries that return an unexecuted plan over the given tables.
LAZY = [
    "map_all_blocks", "map_blocks_subset", "map_delta_effectivity", "null_component_key",
    "expected_links", "link_counts", "surrogate_keys", "row_hash_sha2", "checksum_xxhash",
    "validity_filter", "in_list_filter", "full_row_dedup", "duplicate_keys", "audit_summary_xxhash",
    "audit_thorough", "schema_check", "constraint_suite", "null_rate_profile", "totals_compared",
    "key_diff", "row_diff", "normalise_staging", "quarantine_bad", "latest_version",
    "incremental_since",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_join_no_python_no_window(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for banned in ("CartesianProduct", "NestedLoop", "Python", "Window", "Arrow", "SortMergeJoin",
                   "BroadcastHashJoin"):
        assert banned not in plan


@pytest.mark.parametrize("name", ["map_all_blocks", "map_delta_effectivity", "normalise_staging",
                                  "quarantine_good", "incremental_since", "surrogate_keys"])
def test_narrow_operators_do_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, SF_DIR))


def test_all_blocks_of_a_source_share_a_scan(spark):
    plan = plan_of(QUERIES["map_all_blocks"](spark, SF_DIR))
    assert plan.count("FileScan") == 2
    assert plan_of(QUERIES["map_scan_per_block"](spark, SF_DIR)).count("FileScan") == 5


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["map_delta_effectivity"](spark, SF_DIR))
    assert "Not(EqualTo(o_orderstatus,P))" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderpriority:string>" in plan
    plan = plan_of(QUERIES["incremental_since"](spark, SF_DIR))
    assert "GreaterThan(ts,2024-01-20T12:00" in plan


def test_every_keyed_shuffle_follows_a_partial_aggregate(spark):
    for name in ("full_row_dedup", "duplicate_keys", "audit_summary_xxhash", "key_diff", "row_diff",
                 "totals_compared", "latest_version", "link_counts"):
        lines = plan_of(QUERIES[name](spark, SF_DIR)).splitlines()
        for line, below in zip(lines, lines[1:]):
            if "Exchange hashpartitioning" in line:
                assert re.search(r"(Hash|Sort)Aggregate", below), name


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, another third is copies of one row."""
    n = 90_000
    return spark.range(n).select(
        F.when(F.col("id") < n // 3, "hot")
        .when(F.col("id") < 2 * n // 3, "copy")
        .otherwise(F.col("id").cast("string"))
        .alias("k"),
        F.when(F.col("id").between(n // 3, 2 * n // 3 - 1), 0).otherwise(F.col("id")).alias("v"),
    )


def test_hot_keys_keep_results_whole(spark, skewed):
    n = 90_000
    assert staging.drop_duplicate_rows(skewed).count() == 2 * n // 3 + 1
    assert checks.duplicate_keys(skewed, ["k"]).count() == 2
    latest = merge.latest_per_key(skewed, ["k"], ["v"])
    assert latest.count() == n // 3 + 2
    assert latest.filter("k = 'hot'").first().v == n // 3 - 1

    edited = skewed.withColumn("v", F.when(F.col("v") == 5, -5).otherwise(F.col("v")))
    diff = compare.row_diff(skewed, edited, ["k"]).collect()
    assert [tuple(r) for r in diff] == [("hot", n // 3, n // 3, "CHANGED")]

    updates = spark.createDataFrame([("hot", -1), ("new", -2)], "k string, v bigint")
    merged = merge.merge_rows(skewed, updates, ["k"])
    assert merged.count() == 2 * n // 3 + 2


def test_sort_merge_upsert_splits_a_hot_base_partition(spark, skewed):
    tuned = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    before = {key: spark.conf.get(key) for key in tuned}
    updates = skewed.filter("k NOT IN ('hot', 'copy')").withColumn("v", -F.col("v"))
    try:
        for key, value in tuned.items():
            spark.conf.set(key, value)
        merged = merge.replace_keys(
            skewed.repartition(8), merge.latest_per_key(updates, ["k"]), ["k"], broadcast=False
        )
        checked = merged.agg(F.count("*").alias("n"), F.sum("v").alias("v"))
        row = checked.collect()[0]
        plan = plan_of(checked)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert "SortMergeJoin(skew=true)" in plan
    hot = sum(range(30_000))
    assert (row.n, row.v) == (90_000, hot - sum(range(60_000, 90_000)))
