"""Every query against its SQL twin, on whole tables."""

import os

import duckdb
import pytest

from ledgerloom.catalogue import ORACLES, QUERIES
from ledgerloom.catalogue.standins import TABLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(row[i] for i in order) for row in rows]
    return sorted(columns), sorted(shaped, key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLES[name])
    want = _sorted_rows([d[0] for d in result.description], result.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
