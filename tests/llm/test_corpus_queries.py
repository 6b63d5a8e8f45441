"""Every corpus query with SQL against DuckDB on the smallest tables; the others run."""

from glob import glob
from pathlib import Path

import duckdb
import pytest

from flowlens.llm.queries import ORACLES, QUERIES
from tools.check import rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_returns_every_document(spark, name):
    want = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert QUERIES[name](spark, SF_DIR).select("doc_id").distinct().count() == want
