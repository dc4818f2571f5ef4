"""Every catalog query with an oracle equals DuckDB on sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
ORACLE = E.oracle_sql()
QUERIES = E.queries()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{os.path.join(SF, f)}')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[-1] == "churned"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    exp = sorted(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert got == exp
