"""Every registered query against its DuckDB oracle on the sf0.001 tables (the driver
runs the same comparison at sf0.01; tools/oracle_check.py does it locally)."""
from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from tessera.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()
NAMES = sorted(E.queries())


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, bool):
        return (1, float(v))
    if isinstance(v, (int, float)):
        return (1, round(float(v), 6))
    if isinstance(v, (list, tuple)):
        return (2, str([_norm(x) for x in v]))
    return (3, str(v))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = df.collect()
    if name not in ORACLES:
        assert df.columns
        return
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(df.columns)
    a = sorted(tuple(_norm(r[df.columns.index(c)]) for c in order) for r in rows)
    b = sorted(tuple(_norm(r[dcols.index(c)]) for c in order) for r in drows)
    assert a == b


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "rfm_segment" in df.columns
