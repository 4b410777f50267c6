"""Grouped counts and sums in a repeatable order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def counts_by(df: DataFrame, key: str, alias: str = "n") -> DataFrame:
    """Rows per key; NULL is a key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(alias))


def ranked(df: DataFrame, by: str, tie_breaker: str, n: int | None = None) -> DataFrame:
    """Largest ``by`` first, cut to ``n`` rows if given."""
    df = df.orderBy(F.col(by).desc_nulls_last(), tie_breaker)
    return df if n is None else df.limit(n)


def volume_by(df: DataFrame, key: str) -> DataFrame:
    """Summed amount per key. Rows without a key are left out, and a key whose
    amounts are all missing sums to 0. Summing decimals keeps the result
    independent of the row order."""
    total = F.coalesce(F.sum(F.col("amount").cast("decimal(14,2)")), F.lit(0))
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(total.cast("double").alias("amount"))
    )


def with_share(df: DataFrame, value: str, alias: str = "pct") -> DataFrame:
    """Each row's percentage of the column's total. ``df`` is a report: its rows
    are groups, few enough for one window, and it runs once."""
    total = F.sum(value).over(Window.partitionBy())
    share = 100 * F.col(value).cast("double") / total.cast("double")
    return df.withColumn(alias, F.round(share, 4))
