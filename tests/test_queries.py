"""Every named query equals its DuckDB SQL twin (rows, columns and values; order-free)."""

import duckdb
import pytest

import __spark_entry__ as E
from addrflow.plans import queries as Q
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(Q.queries()) == set(Q.oracle_sql())
    assert set(Q.queries()) <= set(E.queries()) and set(Q.oracle_sql()) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query_matches_sql(spark, duck, name):
    df = Q.queries()[name](spark, SF_SMALL)
    res = duck.execute(Q.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    s_hash, _ = digest(df.columns, [tuple(r) for r in df.collect()])
    d_hash, _ = digest(d_cols, res.fetchall())
    assert s_hash == d_hash


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:5] == ["enabled", "record_created", "record_updated", "contact_mobile", "contact_email"]
