"""Queries of the corpus operators against their SQL on DuckDB."""

import os

import duckdb
import pytest

from skyledger.llm.oracle import ORACLE
from skyledger.llm.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    frame = QUERIES[name](spark, SF)
    result = con.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    rows = result.fetchall()
    assert rows and sorted(map(tuple, frame.select(*columns).collect())) == sorted(rows)
