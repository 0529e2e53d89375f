from __future__ import annotations

import duckdb
import pytest

from marketloom.llm.oracle import SQL
from marketloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(columns).collect()), key=str) == sorted(result.fetchall(), key=str)
