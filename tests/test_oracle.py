"""Every registered query against its DuckDB oracle on sf0.001 (the driver gate, locally)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as se
from isotherm.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "∅"
    if isinstance(v, float):
        return repr(v)
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


QUERIES = se.queries()
ORACLE = se.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = [f.name for f in df.schema.fields]
    rows = df.collect()
    if name not in ORACLE:
        assert len(cols) == len(set(cols))
        return
    rel = con.execute(ORACLE[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(cols) == sorted(dcols)
    order = sorted(cols)
    s = sorted(tuple(_norm(r[cols.index(c)]) for c in order) for r in rows)
    d = sorted(tuple(_norm(r[dcols.index(c)]) for c in order) for r in drows)
    assert len(s) == len(d)
    assert s == d


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 5
