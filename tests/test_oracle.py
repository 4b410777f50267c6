"""Every registered query against its SQL twin in DuckDB; the training-data
queries have tests of their own."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {k: q for k, q in contract.queries().items() if k not in contract.LLM_QUERIES}
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    return connection


def rows(names, values):
    """Multiset of rows with columns in name order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in values)


FAMILIES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def duck_type(spark_type):
    if spark_type.startswith("decimal"):
        return spark_type.upper()
    return FAMILIES[spark_type]


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle(spark, duck, key):
    result = QUERIES[key](spark, SF_DIR)
    expected = duck.sql(ORACLES[key])
    types = {n: str(t).upper().replace(" ", "") for n, t in zip(expected.columns, expected.types)}
    assert {n: duck_type(t) for n, t in result.dtypes} == types
    got = rows(result.columns, [tuple(r) for r in result.collect()])
    assert got == rows(expected.columns, expected.fetchall())
    assert got, "a query over the test tables has rows"
