"""Time-limited and latest-N access to the stored tables.

A stored table is partitioned by ``ingest_date``. Both functions add the date
condition that follows from the one on ``ingested_at``, so that Spark prunes
directories; a table without that column is filtered on ``ingested_at`` alone.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions.parse import utc_day

DAY = "ingest_date"


def as_of_column(as_of: datetime | Column | None) -> Column:
    """Moment a report refers to, the current time by default."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of) if isinstance(as_of, datetime) else as_of


def recent(df: DataFrame, within: str, as_of: datetime | Column | None = None) -> DataFrame:
    """Rows ingested no earlier than ``within`` (such as ``1 HOUR``) before
    ``as_of``. There is no upper bound."""
    since = as_of_column(as_of) - F.expr(f"INTERVAL {within}")
    condition = F.col("ingested_at") >= since
    if DAY in df.columns:
        condition = condition & (F.col(DAY) >= utc_day(since))
    return df.filter(condition)


def last_ingest(df: DataFrame) -> DataFrame:
    """One row: the newest ``ingested_at``, NULL for an empty table."""
    if DAY in df.columns:
        df = df.filter(F.col(DAY) == df.agg(F.max(DAY)).scalar())
    return df.agg(F.max("ingested_at").alias("last"))


def newest_days(df: DataFrame, n: int) -> Column:
    """First of the newest days that together hold ``n`` rows.

    Counting rows per partition directory reads no column. The running total is
    taken over one row per day, which grows with the calendar only.
    """
    newest_first = Window.orderBy(F.col(DAY).desc())
    newer = F.sum("rows").over(newest_first) - F.col("rows")
    return (
        df.filter(F.col(DAY).isNotNull())
        .groupBy(DAY)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(DAY, newer.alias("newer"))
        .filter(F.col("newer") < n)
        .agg(F.min(DAY))
        .scalar()
    )


def latest(df: DataFrame, n: int, *tie_breakers: str) -> DataFrame:
    """The ``n`` rows ingested last, rows without a time first.

    Only the time is read from the newest days to find where the ``n`` rows
    begin; the other columns are read from there on.
    """
    if DAY in df.columns:
        df = df.filter(F.col(DAY).isNull() | (F.col(DAY) >= newest_days(df, n)))
    time = F.col("ingested_at")
    newest = df.select(time).orderBy(time.desc_nulls_first()).limit(n)
    begin = newest.agg(F.min(time)).scalar()
    rows = df.filter(time.isNull() | (time >= begin))
    return rows.orderBy(time.desc_nulls_first(), *tie_breakers).limit(n)
