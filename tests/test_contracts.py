"""Promotion of types, and contracts compared."""

from decimal import Decimal

import pytest
from pyspark.sql import types as T

from ledgerloom.operators import contracts

KINDS = [
    "tinyint", "smallint", "int", "bigint", "decimal(5,2)", "decimal(38,0)", "decimal(38,30)", "float",
    "double", "date", "timestamp_ntz", "timestamp", "string", "boolean", "binary",
]


def parsed(kind):
    return T._parse_datatype_string(kind)


def test_promotion_is_a_lattice(spark):
    kinds = [parsed(k) for k in KINDS]
    for a in kinds:
        assert contracts.promoted_type(a, a) == a
        assert contracts.promoted_type(a, T.NullType()) == a
        for b in kinds:
            both = contracts.promoted_type(a, b)
            assert both == contracts.promoted_type(b, a)
            # The result holds both: promoting again changes nothing.
            assert contracts.promoted_type(both, a) == both == contracts.promoted_type(both, b)


@pytest.mark.parametrize(
    "one, other, both",
    [
        ("int", "bigint", "bigint"),
        ("bigint", "decimal(5,2)", "decimal(21,2)"),
        ("int", "double", "double"),
        ("bigint", "double", "string"),
        ("decimal(38,0)", "decimal(38,30)", "string"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("date", "timestamp", "string"),
        ("boolean", "int", "string"),
    ],
)
def test_promoted_types(spark, one, other, both):
    assert contracts.promoted_type(parsed(one), parsed(other)) == parsed(both)


def test_misfits_are_named_and_others_kept(spark):
    versions = [
        spark.createDataFrame([(1, "a"), (None, "b"), (2**40, "c")], "n bigint, k string"),
        spark.createDataFrame([(Decimal("1.50"), "d"), (Decimal("7.00"), "e")], "n decimal(5,2), k string"),
        spark.createDataFrame([("9", "f"), ("x", "g"), (None, "h")], "n string, k string"),
        spark.createDataFrame([("i",)], "k string"),
    ]
    free = contracts.promoted_versions(versions)
    assert free.schema["n"].dataType == T.StringType()
    assert {r["n"] for r in free.collect()} == {"1", None, str(2**40), "1.50", "7.00", "9", "x"}
    held = contracts.promoted_versions(versions, T.StructType([T.StructField("n", T.IntegerType())]))
    got = {r["k"]: (r["n"], r[contracts.MISFITS]) for r in held.collect()}
    assert got == {
        "a": (1, []), "b": (None, []), "c": (None, ["n"]), "d": (None, ["n"]), "e": (7, []),
        "f": (9, []), "g": (None, ["n"]), "h": (None, []), "i": (None, []),
    }
    with pytest.raises(ValueError):
        contracts.promoted_versions(versions, T.StructType([T.StructField("z", T.LongType())]))


def test_contracts_without_change_or_rows(spark):
    one = parsed("struct<a:int,b:string>")
    df = spark.createDataFrame([(1, "x")], one)
    assert contracts.contract_changes(one, one, df).collect() == []
    wide = parsed("struct<a:bigint,b:string,c:date>")
    got = contracts.contract_changes(one, wide, df.filter("false")).collect()
    assert [(r["column_name"], r["change"], r["rows_at_odds"]) for r in got] == [
        ("a", "WIDENED", 0), ("c", "ADDED", 0)
    ]
    assert contracts.compatible(one, wide, "backward")
    assert not contracts.compatible(one, wide, "forward") and not contracts.compatible(one, wide)
    assert contracts.compatible(one, one)
