"""Every registered query against its SQL, and what its plan must not contain."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of

SF = "/root/testdata/sf0.001"
# Those of the subpackage for training data have tests of their own.
QUERIES = {name: q for name, q in entry.queries().items() if q.__module__ == entry.__name__}
ORACLE = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def test_every_query_has_sql():
    assert not QUERIES.keys() - ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert node not in plan
    got, columns = rows_of(df.collect(), df.columns)
    if name in ORACLE:
        result = duck.execute(ORACLE[name])
        want, expected = rows_of(result.fetchall(), [d[0] for d in result.description])
        assert columns == expected
        assert got == want


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:6] == ["doc_id", "pmid", "doi", "title", "journal", "year"]
    assert df.count() > 0
