"""Queries with an SQL twin, on whole tables."""

import duckdb
import pytest

from ledgerloom.llm.queries import ORACLES, QUERIES
from tests.llm.fixtures import SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in result.fetchall())
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == want


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [
        f"op{i}" for i in range(1, 14)
    ]
