from datetime import date, datetime
from decimal import Decimal

import pytest

from ledgerloom.operators import staging
from ledgerloom.operators.staging import ColumnRule

DIRTY = [
    (" 7 ", "2024-01-31", " 10.5", "x", 1),
    ("8", "20240131", "n/a", "  NULL ", 2),
    ("nine", "31/01/2024", "1,0", "", 3),
    (None, "31.01.2024", "-", "y", 4),
]
DIRTY_SCHEMA = "id string, day string, amount string, note string, extra int"
RULES = (
    ColumnRule("key", "bigint", source="id", required=True),
    ColumnRule("day", "date"),
    ColumnRule("amount", "decimal(10,2)"),
    ColumnRule("note"),
)


def test_normalise(spark):
    got = staging.normalise(spark.createDataFrame(DIRTY, DIRTY_SCHEMA), RULES)
    assert got.columns == ["key", "day", "amount", "note", "extra"]
    day = date(2024, 1, 31)
    assert [tuple(r) for r in got.collect()] == [
        (7, day, Decimal("10.50"), "x", 1),
        (8, day, None, None, 2),
        (None, day, None, None, 3),
        (None, None, None, "y", 4),
    ]
    narrow = staging.normalise(spark.createDataFrame(DIRTY, DIRTY_SCHEMA), RULES, keep_rest=False)
    assert narrow.columns == ["key", "day", "amount", "note"]


def test_quarantine_keeps_every_row_and_says_why(spark):
    good, bad = staging.quarantine_split(spark.createDataFrame(DIRTY, DIRTY_SCHEMA), RULES)
    assert sorted(r.extra for r in good.collect()) == [1, 2]
    assert {r.extra: r.REJECT_REASON for r in bad.collect()} == {
        3: "key: not a bigint; amount: not a decimal(10,2)",
        4: "key: required; day: not a date",
    }


@pytest.mark.parametrize(
    "text, rule, want",
    [
        ("2024-01-31 10:11:12", ColumnRule("v", "timestamp_ntz"), datetime(2024, 1, 31, 10, 11, 12)),
        ("2024-01-31T10:11:12", ColumnRule("v", "timestamp_ntz"), datetime(2024, 1, 31, 10, 11, 12)),
        ("31 Jan 2024", ColumnRule("v", "date", formats=("d MMM yyyy",)), date(2024, 1, 31)),
        ("1/2/2024", ColumnRule("v", "date", formats=("d/M/yyyy",)), date(2024, 2, 1)),
        ("2024.01.31", ColumnRule("v", "date", formats=("yyyy.MM.dd",)), date(2024, 1, 31)),
        ("2024-02-30", ColumnRule("v", "date"), None),
        ("-", ColumnRule("v", null_tokens=()), "-"),
        ("2147483648", ColumnRule("v", "int"), None),
    ],
)
def test_single_values(spark, text, rule, want):
    df = staging.normalise(spark.createDataFrame([(text,)], "v string"), [rule])
    assert df.first()[0] == want


def test_split_by_rule_sends_unknown_to_the_second_part(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "v int")
    good, bad = staging.split_by_rule(df, "v > 0")
    assert (good.count(), bad.count()) == (1, 2)


def test_dedup_and_metadata(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "k int, v string")
    assert staging.drop_duplicate_rows(df).count() == 2
    stamped = staging.with_ingest_metadata(staging.with_etl_date(df, "20230101"), "20240131")
    assert stamped.columns == ["k", "v", "ETL_DATE", "INGESTION_TIMESTAMP"]
    assert {r.ETL_DATE for r in stamped.collect()} == {"20240131"}
    assert stamped.select("INGESTION_TIMESTAMP").distinct().count() == 1


def test_stack_versions_goes_by_name(spark):
    a = spark.createDataFrame([("1", "2")], "a string, b string")
    b = spark.createDataFrame([("4", "3")], "b string, a string")
    c = spark.createDataFrame([("5",)], "c string")
    got = staging.stack_versions([a, b, c])
    assert [tuple(r) for r in got.collect()] == [
        ("1", "2", None), ("3", "4", None), (None, None, "5"),
    ]
