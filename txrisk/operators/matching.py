"""Joins of transactions with alerts on ``transaction_id``.

The id is not unique on either side, and alerts of any age count. Alerts are
therefore counted per id first, partially before the shuffle, and each
transaction meets at most one row of counts; no pairs are formed. Because only
the alert side is aggregated, Spark can put its own runtime filter on the ids of
a short period below that aggregate, where alerts are read, and adaptive
execution can split an id that holds a large share of the transactions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ID = "transaction_id"


def alert_counts(alerts: DataFrame) -> DataFrame:
    """Alerts per transaction id."""
    return alerts.groupBy(ID).agg(F.count(F.lit(1)).alias("alerts"))


def with_alert_counts(transactions: DataFrame, alerts: DataFrame) -> DataFrame:
    """The transactions with ``alerts``, how many their id has, 0 for none."""
    counted = transactions.join(alert_counts(alerts), ID, "left")
    return counted.withColumn("alerts", F.coalesce("alerts", F.lit(0)))


# Transactions and alerts to transactions with ``alerts``, how many their id has.
Counted = Callable[[DataFrame, DataFrame], DataFrame]


def joined_rows(
    transactions: DataFrame, alerts: DataFrame, counted: Counted = with_alert_counts
) -> DataFrame:
    """The left join of the two tables, counted per transaction row.

    ``matched`` and ``joined`` are the numbers of rows the join yields with an
    alert and in all. They are doubles: sums of large counts need not fit an
    integer.
    """
    n = F.col("alerts").cast("double")
    return counted(transactions, alerts).select(
        ID, n.alias("matched"), F.greatest(n, F.lit(1.0)).alias("joined")
    )


def marked(
    transactions: DataFrame, alerts: DataFrame, counted: Counted = with_alert_counts
) -> DataFrame:
    """The transactions with ``alerted``, whether their id has an alert. Several
    alerts for one id do not multiply the rows."""
    return counted(transactions, alerts).withColumn("alerted", F.col("alerts") > 0)
