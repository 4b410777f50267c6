"""Joins with alerts of all ages on counts stored in buckets of the id."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from txrisk.operators.matching import joined_rows, with_alert_counts
from txrisk.sources.by_id import counts_table, store_counts, stored_counts

ROWS = "transaction_id string, ingest_date date"
DAYS = [date(2024, 3, d) for d in (1, 2, 3)]


@pytest.fixture
def alerts(spark):
    rows = [(f"t{i * i % 23}", DAYS[i % 3]) for i in range(90)]
    return spark.createDataFrame([*rows, ("t1", None), (None, DAYS[0])], ROWS)


@pytest.fixture
def transactions(spark):
    rows = [(f"t{i % 30}", DAYS[i % 3]) for i in range(60)]
    return spark.createDataFrame([*rows, (None, DAYS[2])], ROWS)


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    a, b = a.select(columns), b.select(columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_stored_counts_give_the_same_join(spark, alerts, transactions, tmp_path):
    path = str(tmp_path / "by-id")
    # Days in two steps, the second one twice and with a day done before.
    store_counts(alerts, path, DAYS[0], DAYS[1], buckets=4)
    for _again in range(2):
        store_counts(alerts, path, DAYS[0], DAYS[2], buckets=4)
    counts = counts_table(spark, path, buckets=4)
    closed = alerts.filter(F.col("ingest_date") < DAYS[2]).count()
    assert counts.agg(F.sum("alerts")).first()[0] == closed
    counted = stored_counts(counts, DAYS[2])
    same(counted(transactions, alerts), with_alert_counts(transactions, alerts))
    same(joined_rows(transactions, alerts, counted), joined_rows(transactions, alerts))


def test_nothing_stored_yet(spark, alerts, transactions, tmp_path):
    counts = counts_table(spark, str(tmp_path / "by-id"), buckets=4)
    counted = stored_counts(counts, DAYS[0])
    same(counted(transactions, alerts), with_alert_counts(transactions, alerts))


def test_stored_alerts_are_not_shuffled(spark, alerts, transactions, tmp_path, plan_of):
    """Of closed days only: the one exchange is that of the transactions."""
    path = str(tmp_path / "by-id")
    store_counts(alerts, path, DAYS[0], DAYS[2], buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = counts_table(spark, path, buckets=4).groupBy("transaction_id").agg(F.sum("alerts"))
        plan = plan_of(transactions.join(counts, "transaction_id", "left"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Arguments: hashpartitioning(transaction_id") == 1
    assert "SelectedBucketsCount: 4 out of 4" in plan
