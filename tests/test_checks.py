from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import checks
from ledgerloom.operators.mapping import LINK_SCHEMA
from ledgerloom.plans.links import LINK_AUDIT, LINKS, with_key_prefixes

DAY = date(2024, 1, 31)
LOOSE = T.StructType([T.StructField(f.name, f.dataType, True) for f in LINK_SCHEMA.fields])


def link(ar="a", au="u", kind="t"):
    return (ar, "s", au, kind, DAY, DAY, date(9999, 12, 31))


@pytest.fixture
def source(spark):
    return spark.createDataFrame([("Y", "N"), ("Y", "Y")], "ENTITY_CRE_FLG string, DEL_FLG string")


def statuses(report):
    return {r.CHECK_NAME: r.STATUS for r in report.collect()}


@pytest.mark.parametrize("prescreen", [False, True])
@pytest.mark.parametrize(
    "rows, failing",
    [
        ([link(), link("b")], set()),
        ([], {"Row Count"}),
        ([link(), link(kind="other")], {"Duplicate Key"}),
        ([link(ar=None)], {"Null Key"}),
        ([link(ar=None), link(ar=None)], {"Null Key", "Duplicate Key"}),
    ],
)
def test_each_fault_is_found(spark, source, rows, failing, prescreen):
    report = checks.audit_links(
        spark.createDataFrame(rows, LOOSE), source, LINK_AUDIT, prescreen=prescreen
    )
    found = statuses(report)
    assert list(found) == [
        "Row Count", "Duplicate Key", "Null Key", "Hash Checksum", "Schema Validation",
    ]
    assert {n for n, s in found.items() if s != "PASS"} == failing


def test_details_and_timestamp(spark, source):
    report = checks.audit_links(spark.createDataFrame([link()], LOOSE), source, LINK_AUDIT)
    rows = report.collect()
    assert rows[0].DETAILS == "Raw GAM Valid Rows: 1, SOR Rows: 1"
    assert len({r.CHECK_TIMESTAMP for r in rows}) == 1


def test_null_halves_are_not_taken_for_one_key(spark, source):
    """xxhash64 skips nulls, so these two rows share a hash but not a key."""
    target = spark.createDataFrame([link(ar=None, au="x"), link(ar="x", au=None)], LOOSE)
    for prescreen in (False, True):
        found = statuses(checks.audit_links(target, source, LINK_AUDIT, prescreen=prescreen))
        assert (found["Duplicate Key"], found["Null Key"]) == ("PASS", "FAIL")


def test_missing_columns_skip_dependent_checks(spark, source):
    target = spark.createDataFrame([link()], LOOSE).drop("END_DT", "AU_ID")
    report = {r.CHECK_NAME: r for r in checks.audit_links(target, source, LINK_AUDIT).collect()}
    assert report["Row Count"].STATUS == "PASS"
    assert report["Schema Validation"].DETAILS == "Missing Columns: ['AU_ID', 'END_DT']"
    for name in ("Duplicate Key", "Null Key", "Hash Checksum"):
        assert report[name].STATUS == "SKIP"


def test_extra_columns_do_not_fail_the_audit(spark, source):
    target = spark.createDataFrame([link()], LOOSE).withColumn("MORE", F.lit(1))
    assert set(statuses(checks.audit_links(target, source, LINK_AUDIT)).values()) == {"PASS"}


@pytest.mark.parametrize("prescreen", [False, True])
def test_stricter_checks(spark, source, prescreen):
    bare = F.sha2(F.lit("AR|TBAADM.GAM"), 256)
    target = spark.createDataFrame([link(), link("b")], LOOSE)
    collapsed = target.withColumn("AR_ID", F.when(F.col("AR_ID") == "b", bare).otherwise("a"))
    spec = with_key_prefixes(LINK_AUDIT, LINKS)

    def run(df, **options):
        return statuses(checks.audit_links(df, source, spec, prescreen=prescreen, **options))

    assert run(target)["Collapsed Key"] == "PASS"
    assert run(collapsed)["Collapsed Key"] == "FAIL"

    def expecting(n):
        return spark.range(1).select(F.lit(n).alias("n"))

    assert run(target, expected_rows=expecting(2))["Expected Rows"] == "PASS"
    assert run(target, expected_rows=expecting(3))["Expected Rows"] == "FAIL"

    report = checks.audit_links(target, source, LINK_AUDIT).collect()
    checksum = [r.DETAILS for r in report if r.CHECK_NAME == "Hash Checksum"][0].split(": ")[1]
    assert run(target, expected_checksum=checksum)["Expected Checksum"] == "PASS"
    assert run(collapsed, expected_checksum=checksum)["Expected Checksum"] == "FAIL"


def test_failures_can_raise(spark, source):
    good = checks.audit_links(spark.createDataFrame([link()], LOOSE), source, LINK_AUDIT)
    checks.raise_on_failures(good)
    bad = checks.audit_links(spark.createDataFrame([], LOOSE), source, LINK_AUDIT)
    with pytest.raises(checks.ChecksFailed, match="Row Count"):
        checks.raise_on_failures(bad)


def test_schema_report(spark):
    contract = T.StructType(
        [T.StructField("id", T.LongType(), False), T.StructField("day", T.DateType(), True),
         T.StructField("gone", T.StringType(), True)]
    )
    df = spark.createDataFrame(
        [(1, "2024-01-31"), (None, "soon"), (3, None)], "id bigint, day string"
    ).withColumn("extra", F.lit(1))
    got = {r.column_name: (r.status, r.offending_rows) for r in
           checks.schema_report(df, contract).collect()}
    assert got == {
        "id": ("OK", 1), "day": ("TYPE_MISMATCH", 1), "gone": ("MISSING", 0), "extra": ("EXTRA", 0),
    }


def test_null_rates_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a int")
    assert tuple(checks.null_rates(empty, ["a"]).first()) == ("a", 0, 0, None)


def test_snapshot_columns(spark):
    assert checks.count_snapshot(spark.range(3), "2024-01-31").first().asDict() == {
        "row_count": 3, "run_date": "2024-01-31",
    }


def test_types_are_part_of_the_schema_check(spark, source):
    target = spark.createDataFrame([], LINK_AUDIT.contract).withColumn("PPN_DT", F.lit("soon"))
    found = {r.CHECK_NAME: r for r in checks.audit_links(target, source, LINK_AUDIT).collect()}
    schema = found["Schema Validation"]
    assert schema.STATUS == "FAIL" and schema.DETAILS == "Wrong Types: ['PPN_DT is string, not date']"
