"""Alerts per transaction id and day, stored in buckets of the id.

Alerts of any age can mark a transaction, so reports join with all of them.
Closed days are counted per id once and stored by the hash of the id; a join or
an aggregation on the id then takes the buckets as they are, and only the
transactions of the report's period are shuffled, into the same buckets.
"""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.operators.matching import ID, Counted, alert_counts
from txrisk.operators.recent import DAY

# Fits the largest join: a bucket of all days is one task's share.
BUCKETS = 512


def _name(path: str) -> str:
    return f"alerts_by_id_{hashlib.md5(path.encode()).hexdigest()}"


def counts_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> DataFrame:
    """The stored counts: ``transaction_id``, ``alerts``, ``ingest_date``. The
    session's catalog gets a name for the folder, which need not exist yet. A
    folder keeps the number of buckets it was first written with."""
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {_name(path)} ({ID} STRING, alerts BIGINT, {DAY} DATE)
        USING parquet PARTITIONED BY ({DAY})
        CLUSTERED BY ({ID}) SORTED BY ({ID}) INTO {buckets} BUCKETS
        LOCATION '{path}'"""
    )
    return spark.table(_name(path))


def closed(day: date) -> Column:
    return F.col(DAY) < F.lit(day)


def store_counts(
    alerts: DataFrame, path: str, first: date, closed_before: date, buckets: int = BUCKETS
) -> None:
    """Count the alerts of the days from ``first`` up to ``closed_before``. A
    day is written whole, one file per bucket, and replaces an earlier count of
    it, so the job can be run again after a failure."""
    spark = alerts.sparkSession
    counts_table(spark, path, buckets)
    days = alerts.filter((F.col(DAY) >= F.lit(first)) & closed(closed_before))
    counts = days.groupBy(ID, DAY).agg(F.count(F.lit(1)).alias("alerts"))
    (
        counts.select(ID, "alerts", DAY)
        .repartition(buckets, ID)
        .sortWithinPartitions(DAY, ID)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .insertInto(_name(path))
    )


def stored_counts(counts: DataFrame, closed_before: date) -> Counted:
    """How reports find the alerts of a transaction's id: those of closed days
    from the stored counts, the others from the alerts' rows."""

    def counted(transactions: DataFrame, alerts: DataFrame) -> DataFrame:
        closed_days = counts.filter(closed(closed_before)).groupBy(ID)
        closed_days = closed_days.agg(F.sum("alerts").alias("closed_alerts"))
        open_days = alert_counts(alerts.filter(F.col(DAY).isNull() | ~closed(closed_before)))
        joined = transactions.join(closed_days, ID, "left").join(open_days, ID, "left")
        n = F.coalesce("closed_alerts", F.lit(0)) + F.coalesce("alerts", F.lit(0))
        return joined.withColumn("alerts", n).drop("closed_alerts")

    return counted
