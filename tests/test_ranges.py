"""Balanced ranges, their slices, and checksum trees."""

import datetime
import random
from bisect import bisect_right
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import checksum_tree, ranges
from ledgerloom.operators.compare import row_diff


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(
    "kind, values",
    [
        ("long", [-5, 0, 3, 3, 3, 9, 100, None]),
        ("double", [-1.5, 0.1, 0.1, 2.0, 1e300, None]),
        ("string", ["", "a", "a'b", "b", "é", None]),
        ("date", [datetime.date(2020, 1, 1), datetime.date(2024, 2, 29), None]),
        ("decimal(12,3)", [Decimal("-1.250"), Decimal("7.125"), None]),
    ],
)
def test_every_value_has_its_range(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    cuts = [v for v in values if v is not None][1:]
    listed = ranges.distinct_cuts(cuts)
    for value, found in ranges.with_range(df, "v", cuts, "r").collect():
        assert found == (ranges.NULL_RANGE if value is None else bisect_right(listed, value))
    wanted = [0, len(listed), ranges.NULL_RANGE]
    kept = df.filter(ranges.range_filter("v", df.schema["v"].dataType, cuts, wanted, most=1))
    exact = checksum_tree.rows_of_leaves(df, "v", cuts, wanted)
    should = [v for v in values if v is None or bisect_right(listed, v) in wanted]
    assert rows(exact) == sorted(((v,) for v in should), key=repr)
    assert set(rows(exact)) <= set(rows(kept))


def test_no_cuts_and_no_rows(spark):
    none = spark.createDataFrame([], "v long")
    assert ranges.quantile_cuts(none, "v", 8) == []
    assert ranges.quantile_cuts(none.select(F.col("v").cast("string").alias("v")), "v", 8) == []
    assert ranges.with_range(none, "v", [], "r").collect() == []
    assert ranges.balanced_predicates("v", []) == ["1 = 1"]
    with pytest.raises(ValueError):
        ranges.quantile_cuts(none, "v", 0)


def test_slices_of_a_skewed_column_are_even(spark):
    draw = random.Random(1)
    values = [int(draw.paretovariate(0.5)) for _ in range(20_000)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v long, i long")
    cuts = ranges.quantile_cuts(df.filter("v > 20"), "v", 10)
    counts = [r.row_count for r in ranges.slice_counts(df.filter("v > 20"), "v", cuts).collect()]
    share = df.filter("v > 20").count() / 10
    assert len(counts) == 10 and max(counts) <= 1.2 * share and min(counts) >= 0.8 * share


def test_predicates_are_disjoint_and_cover_all_rows(spark):
    draw = random.Random(2)
    values = [(None if i % 50 == 0 else 7 if i % 3 else draw.randrange(1000), None if i % 11 == 0 else i) for i in range(6_000)]
    df = spark.createDataFrame(values, "v long, i long")
    cuts = ranges.quantile_cuts(df, "v", 12)
    rules = ranges.balanced_predicates("v", cuts, "i")
    hits = df.select(*[F.expr(f"CASE WHEN {rule} THEN 1 ELSE 0 END").alias(f"s{n}") for n, rule in enumerate(rules)])
    total = [sum(r) for r in hits.collect()]
    assert set(total) == {1}
    sizes = hits.agg(*[F.sum(c).alias(c) for c in hits.columns]).first()
    # Rows without the spreading number share a slice, and nulls the first one.
    assert max(sizes) <= 2.5 * 6_000 / 12


def test_slices_of_texts_quote_them(spark):
    rules = ranges.balanced_predicates("v", ["a'b", "c"])
    df = spark.createDataFrame([("a",), ("a'b",), ("b",), ("c",), (None,)], "v string")
    assert [df.filter(rule).count() for rule in rules] == [2, 2, 1]


# --- checksum trees ----------------------------------------------------------------


def both_sides(spark, n=3_000):
    source = spark.range(n).select(
        F.col("id").alias("k"), (F.col("id") % 7).alias("part"), F.concat(F.lit("v"), F.col("id") % 13).alias("v")
    )
    changed = F.when(F.col("k").between(500, 503), "x").otherwise(F.col("v"))
    target = source.filter("k not in (40, 2999)").withColumn("v", changed)
    extra = spark.createDataFrame([(n + 5, 1, None), (77, 0, "v12"), (None, 3, "n")], "k long, part long, v string")
    return source, target.unionByName(extra)


@pytest.mark.parametrize("leaves, small", [(1, 10), (16, 50), (64, 10_000), (1024, 1)])
def test_the_tree_finds_the_rows_that_differ(spark, leaves, small):
    source, target = both_sides(spark)
    found = checksum_tree.range_checksum_diff(source, target, ["k", "part"], leaves=leaves, small_enough=small)
    assert rows(found) == rows(row_diff(source, target, ["k", "part"]))
    assert found.count() == 9


def test_agreeing_ranges_are_not_read_again(spark, tmp_path):
    source, target = both_sides(spark, 40_000)
    paths = []
    for name, side in (("s", source), ("t", target.filter("k is not null"))):
        paths.append(f"file:{tmp_path}/{name}")
        side.repartitionByRange(16, "k").sortWithinPartitions("k").write.parquet(paths[-1])
    sides = [spark.read.parquet(p) for p in paths]
    passes = []
    found = checksum_tree.range_checksum_diff(*sides, ["k", "part"], leaves=256, small_enough=2_000, passes=passes)
    assert passes[-1]["rows"] <= 2_000 and passes[0]["differing"] < 10
    assert rows(found) == rows(row_diff(*sides, ["k", "part"]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert pushed and all("GreaterThanOrEqual(k" in line for line in pushed)


def test_equal_tables_leave_nothing_to_read(spark):
    source, _ = both_sides(spark)
    passes = []
    found = checksum_tree.range_checksum_diff(source, source.repartition(5), ["k", "part"], passes=passes)
    assert found.collect() == [] and passes[-1]["differing"] == 0
    none = source.filter("k < 0")
    assert checksum_tree.range_checksum_diff(none, none, ["k", "part"]).collect() == []
    one_sided = checksum_tree.range_checksum_diff(source, none, ["k", "part"], small_enough=100)
    assert one_sided.count() == 3_000


def test_trees_of_parts_add_up(spark):
    source, _ = both_sides(spark)
    cuts = list(range(50, 3_000, 70))
    whole = checksum_tree.checksum_tree(source, ["k", "part"], cuts)
    parts = [checksum_tree.checksum_tree(source.filter(f"part = {p}"), ["k", "part"], cuts) for p in range(7)]
    assert rows(checksum_tree.merge_trees(parts)) == rows(whole)
    top = whole.groupBy("level").agg(F.sum("row_count").alias("n")).collect()
    assert {r.n for r in top} == {3_000} and len(top) == len(checksum_tree.tree_levels(len(cuts) + 1))
