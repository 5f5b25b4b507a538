"""Queries with SQL counterparts against DuckDB."""

import duckdb
import pytest

from tests.test_oracle import SF, TABLES, table
from tracewright.llm import queries


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query(spark, name):
    connection = duckdb.connect()
    for each in TABLES:
        connection.execute(f"CREATE VIEW {each} AS SELECT * FROM '{SF}/{each}.parquet'")
    got = queries.queries()[name](spark, SF).toPandas()
    want = connection.execute(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert table(got) == table(want)


def test_names():
    known = queries.queries()
    assert [n.split("_")[0] for n in known] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.oracle_sql()) <= set(known)
