"""The three stored tables, as files or in a database."""

from __future__ import annotations

from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.schemas import LAYOUT, TABLES, Table, Tables


def create_table(spark: SparkSession, root: str, table: Table) -> None:
    """Create the table's directory unless it is there."""
    empty = spark.createDataFrame([], table.stored)
    empty.write.mode("ignore").partitionBy(*LAYOUT).parquet(f"{root}/{table.name}")


def create_tables(spark: SparkSession, root: str) -> None:
    for table in TABLES.values():
        create_table(spark, root, table)


def read_table(
    spark: SparkSession,
    root: str,
    table: Table,
    archive: str | None = None,
    closed_before: date | None = None,
) -> DataFrame:
    """One stored table, with its declared schema.

    With ``archive``, days before ``closed_before``, which must be given, come
    from the compacted copy and the others, rows without a day among them, from
    ``root``; both conditions prune directories.
    """
    if archive is not None and closed_before is None:
        raise ValueError("closed_before says which days the archive holds")
    live = spark.read.schema(table.stored).parquet(f"{root}/{table.name}")
    if archive is None:
        return live
    closed = spark.read.schema(table.stored).parquet(f"{archive}/{table.name}")
    boundary = F.lit(closed_before)
    day = F.col("ingest_date")
    return live.filter(day.isNull() | (day >= boundary)).unionByName(closed.filter(day < boundary))


def read_tables(
    spark: SparkSession, root: str, archive: str | None = None, closed_before: date | None = None
) -> Tables:
    return Tables(
        **{
            name: read_table(spark, root, table, archive, closed_before)
            for name, table in TABLES.items()
        }
    )


def compact(
    spark: SparkSession, root: str, archive: str, first: date, closed_before: date
) -> None:
    """Copy the days from ``first`` up to ``closed_before`` into the archive as
    files of even size, sorted by ingest time so that periods skip row groups.
    A day is written whole and replaces an earlier copy of it, so the job can
    be run again after a failure."""
    days = (F.col("ingest_date") >= F.lit(first)) & (F.col("ingest_date") < F.lit(closed_before))
    for table in TABLES.values():
        rows = read_table(spark, root, table).filter(days)
        (
            rows.hint("rebalance", "ingest_date")
            .sortWithinPartitions("ingest_date", "ingested_at")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("ingest_date")
            .parquet(f"{archive}/{table.name}")
        )


def register(tables: Tables) -> None:
    """Make the tables visible to SQL under their names."""
    for name, df in tables._asdict().items():
        df.createOrReplaceTempView(name)


def run_query(spark: SparkSession, sql: str, params: dict[str, Any] | None = None) -> DataFrame:
    """A SQL statement with named parameters (``:name``). Errors are raised."""
    return spark.sql(sql, args=params)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    bounds: tuple[str, int, int] | None = None,
    partitions: int = 16,
) -> DataFrame:
    """A table kept in a database. ``bounds`` names a numeric column and the
    range it is read in, so that the scan is spread over ``partitions`` tasks;
    rows outside the range are read by the first and last task."""
    if bounds is None:
        return spark.read.jdbc(url, table, properties=properties)
    column, lower, upper = bounds
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties,
    )
