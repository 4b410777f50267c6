"""Operational reports.

Each function takes the tables it reads and an optional ``as_of`` moment, and
returns a DataFrame; nothing is collected.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.operators.matching import Counted, joined_rows, marked, with_alert_counts
from txrisk.operators.ranking import counts_by, ranked
from txrisk.operators.recent import last_ingest, latest, recent
from txrisk.schemas import TRANSACTIONS, Tables

AsOf = datetime | Column | None

# Report periods and sizes.
RATE_PERIOD = "1 HOUR"
ALERT_PERIOD = "24 HOURS"
MINUTE_PERIOD = "30 MINUTES"
TOP_COUNTRIES = 15
TOP_USERS = 10
ALERT_LOG_ROWS = 200
RECENT_ROWS = 100
PREVIEW_ROWS = 20


def row_count(df: DataFrame, alias: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def count_recent(df: DataFrame, as_of: AsOf = None, alias: str = "n") -> DataFrame:
    return row_count(recent(df, RATE_PERIOD, as_of), alias)


def unacknowledged(alerts: DataFrame) -> DataFrame:
    """Alerts of any age that nobody has acknowledged."""
    return alerts.filter(~F.col("acknowledged"))


def fraud_rate(
    transactions: DataFrame,
    alerts: DataFrame,
    as_of: AsOf = None,
    within: str = RATE_PERIOD,
    counted: Counted = with_alert_counts,
) -> DataFrame:
    """Percentage of joined rows that carry an alert, NULL without rows. A
    transaction with several alerts counts once for each."""
    window = recent(transactions, within, as_of)
    joined = joined_rows(window, alerts, counted)
    rate = 100.0 * F.sum("matched") / F.nullif(F.sum("joined"), F.lit(0.0))
    return joined.agg(F.round(rate, 2).alias("fraud_rate_pct"))


def overview(tables: Tables, as_of: AsOf = None) -> DataFrame:
    """One row of headline figures, each from its own pruned scan."""
    figures = {
        "tx_last_hour": count_recent(tables.transactions, as_of),
        "fraud_last_hour": count_recent(tables.fraud_alerts, as_of),
        "unacked": row_count(unacknowledged(tables.fraud_alerts)),
        "dlq_last_hour": count_recent(tables.dlq_messages, as_of),
        "fraud_rate_pct": fraud_rate(tables.transactions, tables.fraud_alerts, as_of),
    }
    one_row = tables.transactions.sparkSession.range(1)
    return one_row.select(*[df.scalar().alias(name) for name, df in figures.items()])


def alerts_by_reason(alerts: DataFrame, as_of: AsOf = None) -> DataFrame:
    by_reason = counts_by(recent(alerts, ALERT_PERIOD, as_of), "fraud_reason")
    return ranked(by_reason, "n", "fraud_reason")


def alerts_by_country(alerts: DataFrame, as_of: AsOf = None) -> DataFrame:
    by_country = counts_by(recent(alerts, ALERT_PERIOD, as_of), "country")
    return ranked(by_country, "n", "country", TOP_COUNTRIES)


def top_users(alerts: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Users with the most alerts, and the sum of the alerted amounts."""
    by_user = (
        recent(alerts, ALERT_PERIOD, as_of)
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("fraud_count"),
            F.sum("amount").cast("decimal(24,2)").alias("total_amount"),
        )
    )
    return ranked(by_user, "fraud_count", "user_id", TOP_USERS)


def ingest_minute() -> Column:
    return F.date_trunc("minute", "ingested_at")


def activity_per_minute(
    transactions: DataFrame,
    alerts: DataFrame,
    as_of: AsOf = None,
    counted: Counted = with_alert_counts,
) -> DataFrame:
    """Transactions per minute, and how many of them have an alert."""
    window = recent(transactions, MINUTE_PERIOD, as_of)
    return (
        marked(window, alerts, counted)
        .groupBy(ingest_minute().alias("minute"))
        .agg(F.count(F.lit(1)).alias("total"), F.count_if("alerted").alias("fraud"))
        .orderBy("minute")
    )


def ingest_rate(transactions: DataFrame, as_of: AsOf = None) -> DataFrame:
    return (
        recent(transactions, MINUTE_PERIOD, as_of)
        .groupBy(ingest_minute().alias("minute"))
        .agg(F.count(F.lit(1)).alias("ticks"))
        .orderBy("minute")
    )


def alert_log(alerts: DataFrame) -> DataFrame:
    return latest(alerts, ALERT_LOG_ROWS, "transaction_id", "id").select(
        "id", "transaction_id", "user_id", "amount", "currency", "merchant",
        "country", "card_type", "fraud_reason", "ingested_at", "acknowledged",
    )


def recent_transactions(transactions: DataFrame) -> DataFrame:
    return latest(transactions, RECENT_ROWS, "transaction_id").select(
        "transaction_id", "user_id", "amount", "currency", "merchant",
        "country", "card_type", "timestamp", "ingested_at",
    )


def raw_preview(transactions: DataFrame) -> DataFrame:
    """Every contract column of the latest transactions."""
    return latest(transactions, PREVIEW_ROWS, "transaction_id").select(*TRANSACTIONS.columns)


def pipeline_totals(tables: Tables) -> DataFrame:
    """One row: rows per table and the time of the last ingest."""
    figures = {
        "transactions": row_count(tables.transactions),
        "fraud_alerts": row_count(tables.fraud_alerts),
        "dlq_messages": row_count(tables.dlq_messages),
        "last": last_ingest(tables.transactions),
    }
    one_row = tables.transactions.sparkSession.range(1)
    return one_row.select(*[df.scalar().alias(name) for name, df in figures.items()])
