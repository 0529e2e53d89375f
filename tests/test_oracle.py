"""Every query of the catalog against its reference SQL on the small test tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entrypoint
from marketloom.catalog import QUERIES
from oracle.statements import STATEMENTS as ORACLE
from scripts.check import TABLES, _rows


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entrypoint.queries().items()
    assert ORACLE.items() <= entrypoint.oracle_sql().items()


def test_entry(spark):
    frame = entrypoint.entry(spark)
    assert frame.count() > 0 and "total_revenue" in frame.columns


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    got = frame.collect()
    result = duck.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert _rows(frame.columns, got) == _rows(columns, result.fetchall())
