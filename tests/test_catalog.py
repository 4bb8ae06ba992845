"""Every query with SQL gives the rows DuckDB gives."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test data")
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def cells(pdf, columns):
    def cell(v):
        if v is None or v is pd.NaT or v != v:
            return ""
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted(tuple(cell(v) for v in row) for row in pdf[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = df.toPandas()
    if name not in ORACLES:
        return
    result = duck.execute(ORACLES[name])
    types = {d[0]: str(d[1]) for d in result.description}
    want = result.df()
    columns = sorted(types)
    assert sorted(got.columns) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert cells(got, columns) == cells(want, columns)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
