"""Every query of the library runs on the smallest tables and agrees with its SQL."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


def plain(v):
    if isinstance(v, float):
        return "null" if math.isnan(v) else f"{v:.9g}"
    if v is None or isinstance(v, bool):
        return str(v)
    return str(float(v)) if type(v).__name__ == "Decimal" else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    rows = df.collect()
    assert len(set(df.columns)) == len(df.columns)
    if name in SQL:
        r = duck.execute(SQL[name])
        columns = [c[0] for c in r.description]
        assert sorted(columns) == sorted(df.columns)
        want = sorted(tuple(plain(dict(zip(columns, x))[c]) for c in sorted(columns)) for x in r.fetchall())
        assert sorted(tuple(plain(x[c]) for c in sorted(columns)) for x in rows) == want


def test_sql_is_for_queries():
    assert set(SQL) <= set(QUERIES)
