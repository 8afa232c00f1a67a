"""Every query with SQL gives the rows of its SQL on the smallest dataset."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from verify import norm

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_sql(spark, con, name):
    rel = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    want = sorted(tuple(norm(v) for _, v in sorted(zip(names, r))) for r in rel.fetchall())
    df = entry.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect()) == want


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
