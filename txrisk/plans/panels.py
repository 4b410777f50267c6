"""Second-stage shaping of report results for display."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.display import (
    dollars,
    or_zero,
    percent_text,
    second_text,
    signed_rule,
    to_number,
)
from txrisk.operators.ranking import ranked, volume_by

TOP_VOLUMES = 10


def headline_cards(overview: DataFrame) -> DataFrame:
    """Overview figures with missing ones as zero, the rate as text."""
    counts = ["tx_last_hour", "fraud_last_hour", "unacked", "dlq_last_hour"]
    return overview.select(
        *[or_zero(c).alias(c) for c in counts],
        percent_text("fraud_rate_pct").alias("fraud_rate"),
    )


def pipeline_cards(totals: DataFrame) -> DataFrame:
    counts = ["transactions", "fraud_alerts", "dlq_messages"]
    return totals.select(
        *[or_zero(c).alias(c) for c in counts],
        second_text("last").alias("last_ingestion"),
    )


def with_status(alert_log: DataFrame, status: str = "All") -> DataFrame:
    """Alerts of one status among those the log already holds."""
    acknowledged = F.col("acknowledged")
    wanted = {"All": F.lit(True), "Unacknowledged": ~acknowledged, "Acknowledged": acknowledged}
    return alert_log.filter(wanted[status])


def alert_table(alert_log: DataFrame) -> DataFrame:
    """Log rows as shown: the signed rule takes the place of the reason."""
    return alert_log.select(
        "id", "transaction_id", "user_id", to_number("amount").alias("amount"),
        "currency", "merchant", "country", "card_type",
        signed_rule().alias("rule"), "ingested_at", "acknowledged",
    )


def with_amount_text(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", dollars())


def volume_by_country(recent_transactions: DataFrame) -> DataFrame:
    return ranked(volume_by(recent_transactions, "country"), "amount", "country", TOP_VOLUMES)


def volume_by_merchant(recent_transactions: DataFrame) -> DataFrame:
    return ranked(volume_by(recent_transactions, "merchant"), "amount", "merchant")
