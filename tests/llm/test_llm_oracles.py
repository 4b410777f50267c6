"""The training-data queries that SQL can express, against their twins."""

from pathlib import Path

import duckdb
import pytest

from txrisk.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, key):
    duck = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        duck.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    expected = duck.sql(ORACLES[key])
    columns = sorted(expected.columns)
    result = QUERIES[key](spark, SF_DIR)
    assert sorted(result.columns) == columns
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[key]})").fetchall()
    got = [tuple(r) for r in result.select(*columns).collect()]
    assert sorted(got) == sorted(want) and got
