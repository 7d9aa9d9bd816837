import random
from collections import Counter

import pytest

from ledgerloom.operators import compare

SCHEMA = "k string, v string"


def brute_force(source, target):
    a, b = Counter(source), Counter(target)
    result = set()
    for key in {k for k, _ in [*source, *target]}:
        mine = {r: n for r, n in a.items() if r[0] == key}
        theirs = {r: n for r, n in b.items() if r[0] == key}
        if not theirs:
            status = "MISSING"
        elif not mine:
            status = "UNEXPECTED"
        else:
            status = "MATCHED" if mine == theirs else "CHANGED"
        result.add((key, sum(mine.values()), sum(theirs.values()), status))
    return result


def test_row_diff_against_brute_force(spark):
    random.seed(7)
    keys = ["hot"] * 10 + [f"k{i}" for i in range(20)] + [None]
    values = ["x", "y", "", None]

    def rows(n):
        return [(random.choice(keys), random.choice(values)) for _ in range(n)]

    source = rows(200)
    target = source[:120] + rows(40)
    got = compare.row_diff(
        spark.createDataFrame(source, SCHEMA), spark.createDataFrame(target, SCHEMA), ["k"],
        keep_matched=True,
    )
    assert {tuple(r) for r in got.collect()} == brute_force(source, target)


def test_row_diff_tells_null_from_blank(spark):
    left = spark.createDataFrame([("a", None)], SCHEMA)
    right = spark.createDataFrame([("a", "")], SCHEMA)
    assert [r.status for r in compare.row_diff(left, right, ["k"]).collect()] == ["CHANGED"]
    assert compare.row_diff(left, right, ["k"], columns=[]).count() == 0


def test_diffs_refuse_other_types(spark):
    left = spark.createDataFrame([("a", "1")], SCHEMA)
    right = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(TypeError, match="v is string"):
        compare.row_diff(left, right, ["k"])


def test_key_diff_with_null_and_repeated_keys(spark):
    left = spark.createDataFrame([("a", "1"), ("a", "2"), (None, "3"), ("b", "4")], SCHEMA)
    right = spark.createDataFrame([("a", "1"), (None, "9"), ("c", "5"), ("c", "6")], SCHEMA)
    got = {tuple(r) for r in compare.key_diff(left, right, ["k"]).collect()}
    assert got == {("b", "MISSING"), ("c", "UNEXPECTED")}


def test_totals_see_a_cent(spark):
    left = spark.createDataFrame([("F", 0.1), ("F", 0.2), ("O", 5.0)], "s string, amount double")
    right = spark.createDataFrame([("F", 0.3), ("F", 0.0), ("O", 5.01)], "s string, amount double")
    got = {r.s: r.status for r in compare.compare_totals(left, right, ["s"], ["amount"]).collect()}
    assert got == {"F": "PASS", "O": "FAIL"}
    assert compare.sum_by(left, ["s"], ["amount"]).count() == 2


def test_count_comparison(spark):
    row = compare.count_comparison(spark.range(5), spark.range(2)).first()
    assert tuple(row) == (5, 2, -3)
    empty = spark.range(0)
    assert tuple(compare.count_comparison(empty, empty).first()) == (0, 0, 0)


def test_decimals_are_compared_to_their_last_digit(spark):
    a = spark.sql("SELECT 'x' AS g, CAST('1.001' AS DECIMAL(20,6)) AS v")
    b = spark.sql("SELECT 'x' AS g, CAST('1.004' AS DECIMAL(20,6)) AS v")
    assert compare.compare_totals(a, b, ["g"], ["v"]).first().status == "FAIL"
    assert compare.compare_totals(a, a, ["g"], ["v"]).first().status == "PASS"
    wide = spark.sql("SELECT 'x' AS g, 1e17D AS v")
    assert str(compare.sum_by(wide, ["g"], ["v"], 30, 4).first().sum_v) == "100000000000000000.0000"
