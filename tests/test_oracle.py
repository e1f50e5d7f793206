"""Every registered query with oracle SQL, Spark vs DuckDB on sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from gridlens.sources.tables import TABLES

SF = os.environ.get("GRIDLENS_TEST_SF", "/root/testdata/sf0.001")
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "z_score" in df.columns


def test_every_query_has_builder():
    assert set(SQL) <= set(E.queries())
