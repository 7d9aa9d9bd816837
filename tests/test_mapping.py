import hashlib
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import mapping
from ledgerloom.operators.mapping import (
    KeyRule,
    LinkSpec,
    expected_link_counts,
    map_links,
    null_key_rows,
    select_blocks,
)
from ledgerloom.plans.links import ACCOUNT_TABLE, BILL_TABLE, LINKS

GAM = (
    "ACID string, ENTITY_CRE_FLG string, DEL_FLG string, ACCT_OPN_DATE timestamp, "
    "GL_SUB_HEAD_CODE string, SOL_ID string, ACCT_CRNCY_CODE string, SCHM_TYPE string"
)
FBM = "BILL_ID string, DEL_FLG string, ENTITY_CRE_FLG string"
OPENED = datetime(2020, 1, 2, 13, 30)
RUN = "20240131"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def gam_row(acid="A1", made="Y", gone="N", opened=OPENED, sol="S", scheme="SBA"):
    return (acid, made, gone, opened, "G", sol, "VND", scheme)


@pytest.fixture
def tables(spark):
    frames = {
        ACCOUNT_TABLE: spark.createDataFrame([gam_row(), gam_row("A2", scheme="ODA")], GAM),
        BILL_TABLE: spark.createDataFrame([("B1", "N", "Y"), ("B2", "Y", "Y")], FBM),
    }
    return frames.__getitem__


def only(spark, rows, schema=GAM):
    df = spark.createDataFrame(rows, schema)
    return lambda name: df


def collected(df):
    return sorted(tuple(r) for r in df.collect())


def test_golden_rows(tables):
    def row(system, key, unit, kind, effective):
        return (
            sha(f"AR|TBAADM.{system}{key}"), sha(f"CL|SRC_STMTBAADM.{system}"), sha(unit),
            sha(f"CL|AR_X_AU_TP{kind}"), date(2024, 1, 31), effective, date(9999, 12, 31),
        )

    opened = OPENED.date()
    want = []
    for acid in ("A1", "A2"):
        want += [
            row("GAM", acid, "AU|TBAADM.GSHG.S.VND", "AR_X_GLSH", opened),
            row("GAM", acid, f"AU|TBAADM.GAM{acid}.CLS_BAL", "AR_X_ACT_CLS_BAL", opened),
            row("GAM", acid, f"AU|TBAADM.GAM{acid}.BAL", "AR_X_ACT_BAL", opened),
        ]
    want.append(
        row("GAM", "A2", "AU|TBAADM.GAMA2.USED_PRVN_AMT", "AR_X_ACT_USED_PRVN_AMT", opened)
    )
    want.append(row("FBM", "B1", "AU|TBAADM.FBMB1.BAL", "AR_X_ACT_BAL", date(2024, 1, 31)))
    links = map_links(tables, LINKS, RUN)
    assert links.columns == [
        "AR_ID", "SRC_STM_ID", "AU_ID", "AR_X_AU_RLTNP_TP_ID", "PPN_DT", "EFF_DT", "END_DT",
    ]
    assert collected(links) == sorted(want)
    assert collected(map_links(tables, LINKS, RUN, one_scan=False)) == sorted(want)


def test_invalid_and_unknown_flags_drop_rows(spark):
    rows = [gam_row(), gam_row(made="N"), gam_row(gone="Y"), gam_row(made=None), gam_row(gone=None)]
    assert map_links(only(spark, rows), LINKS, RUN, blocks="7").count() == 1


def test_bank_filter_applies_only_where_the_column_exists(spark):
    rows = [(*gam_row(a), b) for a, b in (("A1", "01"), ("A2", "02"), ("A3", None))]
    banked = only(spark, rows, GAM + ", BANK_ID string")
    assert map_links(banked, LINKS, RUN, blocks="7").count() == 1
    plain = only(spark, [r[:-1] for r in rows])
    assert map_links(plain, LINKS, RUN, blocks="7").count() == 3


def test_run_types(tables):
    def effective(run_type, block):
        links = map_links(tables, LINKS, RUN, run_type, blocks=block)
        return {r.EFF_DT for r in links.collect()}

    assert effective("FULL", "7") == effective("first", "7") == {OPENED.date()}
    assert effective("DELTA", "7") == {date(2024, 1, 31)}
    assert effective("FULL", "8") == {date(2024, 1, 31)}
    with pytest.raises(ValueError, match="HALF"):
        map_links(tables, LINKS, RUN, "HALF")


def test_unreadable_opening_dates_become_null(spark):
    rows = [gam_row(opened=o) for o in ("2020-01-02", "31/12/2020", None, "2020-01-02 10:00:00")]
    text = only(spark, rows, GAM.replace("ACCT_OPN_DATE timestamp", "ACCT_OPN_DATE string"))
    got = [r.EFF_DT for r in map_links(text, LINKS, RUN, blocks="7").collect()]
    assert got == [date(2020, 1, 2), None, None, date(2020, 1, 2)]


def test_block_selection():
    everything = {"1", "2", "3", "7", "8"}
    assert select_blocks(LINKS) == select_blocks(LINKS, " ALL ") == everything
    assert select_blocks(LINKS, "7, 8,") == select_blocks(LINKS, [7, 8]) == {"7", "8"}
    for wrong in ("4", "7,9", "", []):
        with pytest.raises(ValueError):
            select_blocks(LINKS, wrong)


def test_run_date_must_be_a_date(tables):
    for wrong in ("2024-01-31", "20240230", "2024131", ""):
        with pytest.raises(ValueError):
            map_links(tables, LINKS, wrong)


def test_unneeded_sources_are_not_read(tables):
    def reader(name):
        assert name == BILL_TABLE
        return tables(name)

    assert map_links(reader, LINKS, RUN, blocks="8").count() == 1


def test_blocks_add_up_to_all(tables):
    parts = []
    for blocks in ("1", "2,3", "7,8"):
        parts += collected(map_links(tables, LINKS, RUN, blocks=blocks))
    assert sorted(parts) == collected(map_links(tables, LINKS, RUN))


def test_expected_counts(tables):
    counts = {r.BLOCK_ID: r.EXPECTED_ROWS for r in expected_link_counts(tables, LINKS).collect()}
    assert counts == {"1": 2, "2": 2, "3": 1, "7": 2, "8": 1}


def test_null_keys_collapse_or_are_rejected(spark):
    read = only(spark, [gam_row(), gam_row(acid=None), gam_row("A3", sol=None)])
    blocks = ["1", "2", "7"]
    collapsed = map_links(read, LINKS, RUN, blocks=blocks)
    assert collapsed.count() == 9
    assert collapsed.filter("AR_ID IS NULL OR AU_ID IS NULL").count() == 0
    assert collapsed.filter(collapsed.AU_ID == sha("AU|TBAADM.GAM")).count() == 2
    assert collapsed.filter(collapsed.AU_ID == sha("AU|TBAADM.GSH")).count() == 1

    kept = map_links(read, LINKS, RUN, blocks=blocks, null_keys="reject")
    rejected = null_key_rows(read, LINKS, blocks)
    assert kept.count() + rejected.count() == 9
    assert {(r.BLOCK_ID, r.NULL_COLUMNS) for r in rejected.collect()} == {
        ("1", "ACID"), ("2", "ACID"), ("7", "ACID"), ("1", "SOL_ID"),
    }
    with pytest.raises(ValueError):
        map_links(read, LINKS, RUN, null_keys="ignore")


def test_unstable_key_types_are_refused(spark):
    for kind in ("double", "float", "decimal(38,10)"):
        read = only(spark, [], GAM.replace("ACID string", f"ACID {kind}"))
        with pytest.raises(TypeError, match="ACID"):
            map_links(read, LINKS, RUN, blocks="7")
    read = only(spark, [], GAM.replace("ACID string", "ACID decimal(38,10)"))
    assert map_links(read, replace(LINKS, allow_decimal_keys=True), RUN, blocks="7").count() == 0


def test_spec_refuses_prefixes_that_run_into_each_other():
    source = LINKS.sources[0]
    clash = replace(source, arrangement=KeyRule("AU|TBAADM.G", ("ACID",)))
    with pytest.raises(ValueError, match="AU|TBAADM.G"):
        replace(LINKS, sources=(clash,))
    with pytest.raises(ValueError, match="repeat"):
        replace(LINKS, sources=(source, source))


def test_spec_survives_a_mapping_file():
    assert LinkSpec.from_json(LINKS.to_json()) == LINKS


def test_block_ids_keep_their_case():
    spec = replace(
        LINKS,
        sources=tuple(
            replace(s, blocks=tuple(replace(b, block_id=f"B{b.block_id}") for b in s.blocks))
            for s in LINKS.sources
        ),
    )
    assert mapping.select_blocks(spec, "B1, B7") == {"B1", "B7"}
    assert mapping.select_blocks(spec, " ALL ") == set(spec.block_ids())
    with pytest.raises(ValueError, match="b1"):
        mapping.select_blocks(spec, "b1")


def test_keys_that_follow_the_time_zone_are_refused(spark):
    rows = spark.createDataFrame([gam_row()], GAM)
    zoned = rows.withColumn("ACID", F.current_timestamp())
    with pytest.raises(TypeError, match="time zone"):
        mapping.map_links(lambda name: zoned, LINKS, "20240131", blocks="7")
    plain = rows.withColumn("ACID", F.current_timestamp().cast("timestamp_ntz"))
    assert mapping.map_links(lambda name: plain, LINKS, "20240131", blocks="7").count() == 1
