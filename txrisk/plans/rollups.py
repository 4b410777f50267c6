"""Reports from what the stream keeps per batch and minute.

They give what the reports of the same name give, without reading history. Whole
minutes of a period are added up from ``minutes``; only its first minute, which
the period may cut, is counted from stored rows. Totals and the place of the
newest rows come from ``batches``. All arguments should be of one ``snapshot``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions.parse import utc_day
from txrisk.operators.ranking import ranked
from txrisk.operators.recent import DAY, as_of_column
from txrisk.plans.reports import (
    ALERT_PERIOD,
    MINUTE_PERIOD,
    RATE_PERIOD,
    TOP_COUNTRIES,
    AsOf,
    ingest_minute,
)
from txrisk.schemas import DLQ_MESSAGES, FRAUD_ALERTS, TABLES, TRANSACTIONS, Tables


def from_minutes(
    minutes: DataFrame, rows: DataFrame, table: str, within: str, as_of: AsOf, *keys: str
) -> DataFrame:
    """Rows of ``table`` ingested in the period, counted by ``keys`` as ``n``."""
    since = as_of_column(as_of) - F.expr(f"INTERVAL {within}")
    minute = F.date_trunc("minute", since)
    whole = F.when(minute == since, minute).otherwise(minute + F.expr("INTERVAL 1 MINUTE"))
    days = F.col(DAY) >= utc_day(since)
    closed = minutes.filter((F.col("table_name") == table) & (F.col("minute") >= whole) & days)
    time = F.col("ingested_at")
    cut = rows.filter((time >= since) & (time < whole) & days & (F.col(DAY) <= utc_day(whole)))
    cut = cut.withColumns({"minute": ingest_minute(), "n": F.lit(1).cast("bigint")})
    columns = [*keys, "n"]
    both = closed.select(*columns).unionByName(cut.select(*columns))
    return both.groupBy(*keys).agg(F.sum("n").alias("n"))


def count_recent(
    minutes: DataFrame, rows: DataFrame, table: str, as_of: AsOf = None, alias: str = "n"
) -> DataFrame:
    found = from_minutes(minutes, rows, table, RATE_PERIOD, as_of)
    return found.select(F.coalesce("n", F.lit(0)).alias(alias))


def recent_counts(minutes: DataFrame, tables: Tables, as_of: AsOf = None) -> DataFrame:
    """One row: what each table got in the last hour."""
    names = {
        "tx_last_hour": (TRANSACTIONS.name, tables.transactions),
        "fraud_last_hour": (FRAUD_ALERTS.name, tables.fraud_alerts),
        "dlq_last_hour": (DLQ_MESSAGES.name, tables.dlq_messages),
    }
    counts = [
        count_recent(minutes, rows, table, as_of, alias) for alias, (table, rows) in names.items()
    ]
    return reduce(DataFrame.crossJoin, counts)


def alerts_by_reason(minutes: DataFrame, alerts: DataFrame, as_of: AsOf = None) -> DataFrame:
    found = from_minutes(
        minutes, alerts, FRAUD_ALERTS.name, ALERT_PERIOD, as_of, "fraud_reason"
    )
    return ranked(found, "n", "fraud_reason")


def alerts_by_country(minutes: DataFrame, alerts: DataFrame, as_of: AsOf = None) -> DataFrame:
    found = from_minutes(minutes, alerts, FRAUD_ALERTS.name, ALERT_PERIOD, as_of, "country")
    return ranked(found, "n", "country", TOP_COUNTRIES)


def ingest_rate(minutes: DataFrame, transactions: DataFrame, as_of: AsOf = None) -> DataFrame:
    found = from_minutes(
        minutes, transactions, TRANSACTIONS.name, MINUTE_PERIOD, as_of, "minute"
    )
    return found.withColumnRenamed("n", "ticks").orderBy("minute")


def pipeline_totals(batches: DataFrame) -> DataFrame:
    """One row: rows per table, and the time of the last ingest of transactions.
    Totals are running, so the newest records are enough."""
    newest = batches.filter(F.col("batch_id") == batches.agg(F.max("batch_id")).scalar())
    totals = [
        F.coalesce(F.max(F.when(F.col("table_name") == name, F.col("total_rows"))), F.lit(0))
        .alias(name)
        for name in TABLES
    ]
    facts = batches.filter(F.col("table_name") == TRANSACTIONS.name)
    day = facts.filter(F.col("last_ingest").isNotNull()).agg(F.max(DAY)).scalar()
    last = facts.filter(F.col(DAY) == day).agg(F.max("last_ingest")).scalar()
    return newest.agg(*totals, F.first(last).alias("last"))


def newest_time(batches: DataFrame, table: str, n: int) -> Column:
    """A time from which on the table has ``n`` rows, or its first one.

    Batches that begin at that time or later hold that many rows, so the ``n``
    newest are not older. The window runs over one record per batch of the
    newest days that hold enough of them, and those days over one row each.
    """
    records = batches.filter((F.col("table_name") == table) & F.col("first_ingest").isNotNull())
    begun = records.withColumn("day", utc_day("first_ingest"))
    newest_first = Window.orderBy(F.col("day").desc())
    per_day = begun.groupBy("day").agg(F.sum("rows").alias("rows"))
    newer = per_day.select("day", (F.sum("rows").over(newest_first) - F.col("rows")).alias("newer"))
    first_day = newer.filter(F.col("newer") < n).agg(F.min("day")).scalar()
    order = Window.orderBy(F.col("first_ingest").desc())
    order = order.rowsBetween(Window.unboundedPreceding, -1)
    newer_rows = F.coalesce(F.sum(F.col("rows") - F.col("untimed")).over(order), F.lit(0))
    reached = begun.filter(F.col("day") >= first_day).select(
        "first_ingest", newer_rows.alias("newer")
    )
    return reached.filter(F.col("newer") < n).agg(F.min("first_ingest")).scalar()


def latest(
    rows: DataFrame, batches: DataFrame, table: str, n: int, *tie_breakers: str
) -> DataFrame:
    """The ``n`` rows ingested last, rows without a time first. Only batches
    that reach the time from which on there are ``n`` rows are read."""
    begin = newest_time(batches, table, n)
    records = batches.filter(F.col("table_name") == table)
    timed = F.col("last_ingest") >= begin
    wanted = records.filter(timed | (F.col("untimed") > 0))
    time = F.col("ingested_at")
    found = rows.filter(F.col("batch_id") >= wanted.agg(F.min("batch_id")).scalar())
    found = found.filter(time.isNull() | (time >= begin))
    return found.orderBy(time.desc_nulls_first(), *tie_breakers).limit(n)
