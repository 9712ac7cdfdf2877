"""Registered queries against their SQL."""

import glob
import os

import duckdb
import pytest

from annolink.llm import queries as llm
from check import rows_of

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", llm.ORACLE)
def test_query(spark, duck, name):
    df = llm.QUERIES[name](spark, SF)
    got, columns = rows_of(df.collect(), df.columns)
    result = duck.execute(llm.ORACLE[name])
    want, expected = rows_of(result.fetchall(), [d[0] for d in result.description])
    assert columns == expected and got == want


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = corpus_pipeline.run(spark, SF)
    rows = left.collect()
    assert set(docs.columns) <= set(left.columns)
    assert 0 < len(rows) < docs.count() and len({r.text for r in rows}) == len(rows)
    assert all(0 < r.taken <= 3 * r["size"] for r in rows)
