"""Joins on the transaction id against the plain SQL forms, with skew."""

import random

import pytest
from pyspark.sql import functions as F

from txrisk.operators import matching

SCHEMA = "transaction_id STRING, minute INT"


@pytest.fixture(scope="module", params=[1, 2, 3])
def sides(spark, request):
    """A third of both sides has one id; others are missing from a side."""
    rng = random.Random(request.param)

    def side(n, ids):
        return [
            ("hot" if rng.random() < 0.34 else str(rng.randrange(ids)), rng.randrange(3))
            for _ in range(n)
        ]

    t = spark.createDataFrame(side(300, 60), SCHEMA).repartition(4)
    a = spark.createDataFrame(side(200, 120), SCHEMA).repartition(3)
    t.createOrReplaceTempView("t")
    a.createOrReplaceTempView("a")
    return t, a


def same(left, right):
    left, right = left.select(*sorted(left.columns)), right.select(*sorted(right.columns))
    assert sorted(map(tuple, left.collect())) == sorted(map(tuple, right.collect()))


def test_left_join_counts(spark, sides):
    expected = spark.sql(
        """SELECT t.transaction_id, cast(count(a.minute) AS double) AS matched,
                  cast(count(*) AS double) AS joined
           FROM t LEFT JOIN a ON t.transaction_id = a.transaction_id GROUP BY 1"""
    )
    sums = [F.sum(c).alias(c) for c in ("matched", "joined")]
    same(matching.joined_rows(*sides).groupBy("transaction_id").agg(*sums), expected)


def test_mark_join_counts(spark, sides):
    expected = spark.sql(
        """SELECT minute, count(*) AS n, count_if(alerted) AS alerted
           FROM (SELECT minute, transaction_id IN (SELECT transaction_id FROM a) AS alerted FROM t)
           GROUP BY minute"""
    )
    marked = matching.marked(*sides).groupBy("minute").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("alerted").alias("alerted")
    )
    same(marked, expected)


def test_only_alerts_are_counted_before_the_join(sides, plan_of):
    t, a = sides
    plan = plan_of(matching.joined_rows(t, a))
    assert plan.count("partial_count(1)") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert matching.joined_rows(t, a).count() == t.count()


def test_alerts_are_filtered_by_the_period_where_they_are_read(spark, tmp_path, plan_of):
    """Spark's own filter stands below the count of alerts per id."""
    ids = spark.range(20_000).select(F.col("id").cast("string").alias("transaction_id"), "id")
    ids.write.parquet(str(tmp_path / "t"))
    ids.write.parquet(str(tmp_path / "a"))
    t, a = (spark.read.parquet(str(tmp_path / n)) for n in "ta")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
    }
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = matching.joined_rows(t.filter("id < 50"), a)
        assert joined.agg(F.sum("matched")).first()[0] == 50
        plan = plan_of(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)
    # Nodes are described from the scans upwards.
    assert plan.index("might_contain") < plan.index("partial_count(1)")
