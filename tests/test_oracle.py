"""Every query against its SQL counterpart in DuckDB."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tracewright import catalog, oracle
from tests.test_plans import plan

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def cell(value):
    if pd.isna(value):
        return None
    if isinstance(value, (str, bool)) or type(value).__name__ == "bool":
        return str(value)
    return float(value)


def table(frame):
    frame = frame[sorted(frame.columns)]
    return sorted([[cell(v) for v in r] for r in frame.itertuples(index=False)], key=repr)


def test_all_queries_have_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, db, name):
    query = catalog.queries()[name](spark, SF)
    text = plan(query)
    # Nothing leaves the JVM and nothing is paired with everything.
    for word in ("Python", "Pandas", "ArrowEval", "CartesianProduct", "BroadcastNestedLoop"):
        assert word not in text
    got = query.toPandas()
    want = db.execute(oracle.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert table(got) == table(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
