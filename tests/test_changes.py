"""Change logs: any order of arrival, tombstones, horizons, and how little is read."""

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import merge
from ledgerloom.plans import jobs
from ledgerloom.sources import sinks
from ledgerloom.sources.zones import QUARANTINE, SOR, STAGING, Zones

LOG = merge.ChangeLog(("k",), "seq", "op")
SCHEMA = "k string, seq long, op string, v int, w string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plain_state(changes, horizon=None):
    """Newest applicable change per key; deletions win ties, then larger columns."""
    state = {}
    for k, seq, op, v, w in changes:
        if seq is None or op not in ("I", "U", "D") or (horizon is not None and seq < horizon):
            continue
        gone = op == "D"
        row = (seq, gone, (v is not None, v) if not gone else (False, None), (w is not None, w) if not gone else (False, None))
        if k not in state or _key(row) > _key(state[k]):
            state[k] = row
    return sorted(
        (
            (k, seq, gone, v[1], w[1]) for k, (seq, gone, v, w) in state.items()
            if not (gone and horizon is not None and seq < horizon)
        ),
        key=repr,
    )


def _key(row):
    seq, gone, v, w = row
    return seq, gone, v[0], v[1] or 0, w[0], w[1] or ""


def random_changes(seed, n=120):
    draw = random.Random(seed)
    return [
        (
            draw.choice(["a", "b", "c", "", None, "hot", "hot", "hot"]), draw.choice([*range(1, 40), None]),
            draw.choice(["I", "U", "D", "U", "?", None]), draw.choice([None, 1, 2]), draw.choice([None, "", "x"]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_any_split_in_any_order_ends_in_the_same_rows(spark, seed):
    changes = random_changes(seed)
    third = len(changes) // 3
    parts = [changes[:third] + changes[:5], changes[third:2 * third], changes[2 * third:]]
    want = plain_state(changes)
    for order in itertools.permutations(parts):
        state = merge.change_states(spark.createDataFrame(order[0], SCHEMA), LOG)
        for part in (*order[1:], order[0]):
            state = merge.apply_changes(state, spark.createDataFrame(part, SCHEMA), LOG)
        assert rows(state) == want


@pytest.mark.parametrize("few", [True, False])
def test_both_ways_of_merging_states_agree(spark, few):
    one, two = random_changes(7), random_changes(8)
    states = [merge.change_states(spark.createDataFrame(c, SCHEMA), LOG) for c in (one, two)]
    assert rows(merge.merge_states(*states, LOG, few)) == plain_state(one + two)


def test_few_changes_do_not_shuffle_the_state(spark, tmp_path):
    merge.change_states(spark.createDataFrame(random_changes(1), SCHEMA), LOG).write.parquet(f"{tmp_path}/s")
    state = spark.read.parquet(f"{tmp_path}/s")
    plan = merge.merge_states(state, state, LOG, few=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 3
    assert sinks.fits_broadcast(spark, f"{tmp_path}/s")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")
    try:
        assert not sinks.fits_broadcast(spark, f"{tmp_path}/s")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_changes_of_a_hot_key_are_combined_before_the_shuffle(spark):
    changes = spark.range(1000).select(
        F.lit("hot").alias("k"), F.col("id").alias("seq"), F.lit("U").alias("op"), F.lit(1).alias("v")
    )
    plan = merge.change_states(changes, LOG)._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "partial_max" in plan[exchange:]


def test_refused_changes_say_why(spark):
    changes = [("a", None, "I", 1, ""), ("a", 5, "?", 1, ""), ("a", 5, None, 1, ""), ("a", 2, "U", 1, ""), ("a", 3, "U", 1, "")]
    refused = merge.refused_changes(spark.createDataFrame(changes, SCHEMA), LOG, 3)
    assert sorted(r[merge.REFUSED_BECAUSE] for r in refused.collect()) == [
        "no sequence number", "older than the horizon", "unknown operation", "unknown operation",
    ]


def test_marks_and_columns_may_differ_and_grow(spark):
    log = merge.ChangeLog(("k",), "at", "kind", ("new",), ("set",), ("gone", "purged"))
    state = merge.snapshot_state(spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, v int"), log, 0)
    changes = [("a", 1, "purged", None, None), ("b", 1, "set", 9, 1.5), ("c", 1, "new", 4, None)]
    changes = spark.createDataFrame(changes, "k string, at int, kind string, v int, extra double")
    assert rows(merge.current_rows(merge.apply_changes(state, changes, log), log)) == [
        ("b", 9, 1.5), ("c", 4, None),
    ]
    with pytest.raises(ValueError):
        merge.snapshot_state(changes, log, 1)


def test_a_written_state_is_the_same_after_a_repeated_run(spark, tmp_path):
    path, changes = f"{tmp_path}/state", random_changes(3)
    for part in (changes[:50], changes[50:], changes[50:], changes[:10]):
        sinks.apply_change_log(spark, path, spark.createDataFrame(part, SCHEMA), LOG)
    assert rows(spark.read.parquet(path)) == plain_state(changes)
    assert [f for f in os.listdir(tmp_path) if f.startswith("state_")] == []


def test_horizons_only_move_forward(spark, tmp_path):
    path = f"{tmp_path}/state"
    first = [("a", 5, "D", None, None), ("b", 5, "I", 1, "x"), ("c", 20, "D", None, None)]
    late = [("a", 4, "U", 1, "back"), ("b", 12, "U", 2, "y")]
    sinks.apply_change_log(spark, path, spark.createDataFrame(first, SCHEMA), LOG)
    sinks.apply_change_log(spark, path, spark.createDataFrame(late[1:], SCHEMA), LOG, horizon=10)
    assert rows(spark.read.parquet(path)) == [("b", 12, False, 2, "y"), ("c", 20, True, None, None)]
    sinks.apply_change_log(spark, path, spark.createDataFrame(late, SCHEMA), LOG, horizon=3)
    assert sinks.change_horizon(spark, path) == "10"
    assert rows(spark.read.parquet(path)) == [("b", 12, False, 2, "y"), ("c", 20, True, None, None)]


def test_only_partitions_with_changes_are_rewritten(spark, tmp_path):
    path, log = f"{tmp_path}/state", merge.ChangeLog(("k", "p"), "seq", "op")
    base = [(f"k{i}", f"p{i % 3}", 1, "I", i) for i in range(30)]
    schema = "k string, p string, seq long, op string, v int"
    sinks.apply_change_log(spark, path, spark.createDataFrame(base, schema), log, ["p"])
    before = {p: sorted(os.listdir(f"{path}/p={p}")) for p in ("p0", "p1", "p2")}
    more = [("k0", "p0", 2, "D", None), ("new", "p0", 2, "I", 7)]
    result = sinks.apply_change_log(spark, path, spark.createDataFrame(more, schema), log, ["p"])
    after = {p: sorted(os.listdir(f"{path}/p={p}")) for p in ("p0", "p1", "p2")}
    assert after["p1"] == before["p1"] and after["p2"] == before["p2"] and after["p0"] != before["p0"]
    assert result.rows == 11
    live = merge.current_rows(spark.read.parquet(path), log)
    assert live.count() == 30 and live.filter("k = 'k0'").count() == 0
    with pytest.raises(ValueError, match="partitioned by"):
        sinks.apply_change_log(spark, path, spark.createDataFrame(more, schema), log)
    with pytest.raises(ValueError, match="part of the key"):
        sinks.apply_change_log(spark, path, spark.createDataFrame(more, schema), log, ["v"])


def test_the_job_quarantines_what_it_cannot_apply(spark, tmp_path):
    zones = Zones(f"file:{tmp_path}")
    changes = spark.createDataFrame([("a", 1, "I", 1, "x"), ("b", 1, "??", 1, "x"), ("c", 2, "I", 3, "")], SCHEMA)
    gone = spark.createDataFrame([("a", 3, "D", None, None)], SCHEMA)
    jobs.ingest_changes(spark, changes, zones, "t", LOG, "20240130")
    for _ in range(2):
        jobs.ingest_changes(spark, gone, zones, "t", LOG, "20240131")
    jobs.publish_current(spark, zones, "t", LOG)
    assert rows(spark.read.parquet(zones.table(SOR, "t"))) == [("c", 3, "")]
    assert spark.read.parquet(zones.table(STAGING, "t")).count() == 2
    held = spark.read.parquet(zones.table(QUARANTINE, "t_changes"))
    assert [(r["k"], r["REFUSED_BECAUSE"]) for r in held.collect()] == [("b", "unknown operation")]


def test_snapshots_give_the_changes_between_them(spark):
    before = spark.createDataFrame([("a", 1, None), ("b", 2, "x"), (None, 3, "n"), ("d", None, None)], "k string, v int, w string")
    after = spark.createDataFrame([("a", 1, None), ("b", 2, None), ("c", None, None), (None, 3, "n")], before.schema)
    changes = merge.snapshot_changes(before, after, LOG, 9)
    assert rows(changes) == sorted(
        [("b", 9, "U", 2, None), ("c", 9, "I", None, None), ("d", 9, "D", None, None)], key=repr
    )
    state = merge.apply_changes(merge.snapshot_state(before, LOG, 1), changes, LOG)
    assert rows(merge.current_rows(state, LOG)) == rows(after)
    assert merge.snapshot_changes(before, before, LOG, 9).count() == 0


def test_no_changes_leave_the_state(spark):
    state = merge.change_states(spark.createDataFrame(random_changes(2), SCHEMA), LOG)
    nothing = spark.createDataFrame([], SCHEMA)
    assert rows(merge.apply_changes(state, nothing, LOG)) == rows(state)
    assert merge.change_states(nothing, LOG).count() == 0
