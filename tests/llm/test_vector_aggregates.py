"""Aggregates over the search's result, which need some of its columns only."""

from pyspark.sql import functions as F

from txrisk.llm.queries import op3_vector_search

SF_DIR = "/root/testdata/sf0.001"


def test_counts_and_sums(spark):
    found = op3_vector_search(spark, SF_DIR)
    rows = found.collect()
    assert found.count() == len(rows) > 0
    assert found.agg(F.sum("score")).first()[0] == sum(r.score for r in rows)
    assert found.groupBy("rank").count().count() == 10
    assert found.select("query_id").distinct().count() == len({r.query_id for r in rows})
