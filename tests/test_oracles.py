"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from check import TABLES, rows_of
from ledgerline.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows_of(names, cursor.fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
