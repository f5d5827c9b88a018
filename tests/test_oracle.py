"""Every registered query against its DuckDB oracle, on the smallest tables."""
import math

import duckdb
import pytest

import __spark_entry__ as entry
from sheaf import catalog, oracle
from sheaf.sources.tables import TEST_TABLES

from .conftest import SF_SMALL

QUERIES = catalog.QUERIES
ORACLES = {k: v for k, v in oracle.all_sql().items() if k in QUERIES}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.6g}")
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["lang", "token", "tf", "df"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.sql(ORACLES[name])
    assert sorted(sdf.columns) == sorted(res.columns)
    drows = res.fetchall()
    assert len(srows) == len(drows)
    assert _rows(sdf.columns, srows) == _rows(res.columns, drows)
