"""Which batches are complete, what they hold, and counts per minute.

The tables of a batch are written one after the other, so a reader could see
facts without their alerts. A batch therefore ends with a record in ``batches``,
and readers ask for the rows of recorded batches only. The record also says how
many rows each table got, all in all and in this batch, and their first and last
ingest time. Before the tables, ``minutes`` gets the batch's counts per minute,
which add up over batches.

All of it is written under the batch's own directories: a batch that is written
again replaces what it left, and becomes visible when its record does.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions.parse import utc_day
from txrisk.functions.rules import DEFAULT_RULES, Rule, fraud_reason
from txrisk.operators.routing import belongs
from txrisk.schemas import (
    BATCHES,
    DLQ_MESSAGES,
    FRAUD_ALERTS,
    LAYOUT,
    MINUTES,
    TABLES,
    TRANSACTIONS,
    Table,
    Tables,
)
from txrisk.sources.tables import create_table, read_table, read_tables
from txrisk.streaming.sinks import write_tasks

# Table name to rows, untimed, first and last (microseconds, None without rows).
Sizes = dict[str, dict[str, int | None]]


def observed_sizes(metrics: dict[str, int | None]) -> Sizes:
    """Observed figures (``routing.size_metrics``) by table."""
    sizes: Sizes = {name: {} for name in TABLES}
    for key, value in metrics.items():
        name, figure = key.split(".")
        sizes[name][figure] = value
    return sizes


def minute_counts(parsed: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Rows per table and minute; alerts also per reason and country. Counts are
    combined in the tasks that hold the rows."""
    nothing = F.lit(None).cast("string")
    labels = {
        TRANSACTIONS.name: (nothing, nothing),
        FRAUD_ALERTS.name: (fraud_reason(rules), F.col("country")),
        DLQ_MESSAGES.name: (nothing, nothing),
    }
    kinds = [
        F.when(
            condition,
            F.struct(
                F.lit(name).alias("table_name"),
                labels[name][0].alias("fraud_reason"),
                labels[name][1].alias("country"),
            ),
        )
        for name, condition in belongs(rules).items()
    ]
    rows = parsed.select(
        F.date_trunc("minute", "ingested_at").alias("minute"),
        F.inline(F.array_compact(F.array(*kinds))),
    )
    keys = ["table_name", "minute", "fraud_reason", "country"]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _write(
    rows: DataFrame, root: str, table: Table, day: str, batch_id: int, tasks: int = 1
) -> None:
    layout = {"ingest_date": utc_day(day), "batch_id": F.lit(batch_id).cast("bigint")}
    (
        rows.withColumns(layout)
        .select(*table.stored.fieldNames())
        .coalesce(tasks)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LAYOUT)
        .parquet(f"{root}/{table.name}")
    )


@dataclass
class Ledger:
    """Records of the batches under ``root``."""

    spark: SparkSession
    root: str
    _last: tuple[int, dict[str, int]] | None = field(default=None, repr=False)

    def create(self) -> None:
        for table in (BATCHES, MINUTES):
            create_table(self.spark, self.root, table)

    def count(self, batch: DataFrame, batch_id: int, rules: Sequence[Rule]) -> Sizes:
        """Store the batch's counts per minute, and add them up by table. Unlike
        observed counts, sums do not grow when a lost task is run again."""
        counts = minute_counts(batch, rules).persist()
        try:
            untimed = F.when(F.col("minute").isNull(), F.col("n")).otherwise(0)
            sums = counts.groupBy("table_name").agg(
                F.sum("n").alias("rows"),
                F.sum(untimed).alias("untimed"),
                F.count(F.lit(1)).alias("counts"),
            )
            found = sums.collect()
            stored = sum(r.counts for r in found)
            tasks = write_tasks(stored, stored)
            _write(counts, self.root, MINUTES, "minute", batch_id, tasks)
            return {r.table_name: {"rows": r.rows, "untimed": r.untimed} for r in found}
        finally:
            counts.unpersist()

    def totals_before(self, batch_id: int) -> dict[str, int]:
        """Rows per table of all recorded batches below ``batch_id``."""
        if self._last is not None and self._last[0] == batch_id - 1:
            return self._last[1]
        earlier = read_table(self.spark, self.root, BATCHES).filter(F.col("batch_id") < batch_id)
        newest = earlier.groupBy("table_name").agg(F.max_by("total_rows", "batch_id").alias("n"))
        return {r.table_name: r.n for r in newest.collect()}

    def commit(self, batch_id: int, sizes: Sizes) -> None:
        """Record a batch whose tables are written. One without rows leaves no
        record, and nothing of it is there to be seen."""
        if not any(figures["rows"] for figures in sizes.values()):
            return
        before = self.totals_before(batch_id)
        totals = {name: before.get(name, 0) + f["rows"] for name, f in sizes.items()}
        rows = [
            (name, f["rows"], totals[name], f["untimed"], f["first"], f["last"])
            for name, f in sizes.items()
        ]
        # One directory for the batch, so that its record appears at once.
        newest = max((f["last"] for f in sizes.values() if f["last"] is not None), default=None)
        schema = (
            "table_name string, rows bigint, total_rows bigint, untimed bigint,"
            " first bigint, last bigint"
        )
        records = self.spark.createDataFrame(rows, schema).select(
            "table_name", "rows", "total_rows", "untimed",
            F.timestamp_micros("first").alias("first_ingest"),
            F.timestamp_micros("last").alias("last_ingest"),
            F.timestamp_micros(F.lit(newest).cast("bigint")).alias("newest"),
        )
        _write(records, self.root, BATCHES, "newest", batch_id)
        self._last = (batch_id, totals)


def last_batch(batches: DataFrame) -> int:
    """Newest recorded batch, -1 without any. Batch ids are directory names, so
    no file is read."""
    newest = batches.agg(F.max("batch_id")).first()[0]
    return -1 if newest is None else newest


def snapshot(spark: SparkSession, root: str) -> tuple[Tables, DataFrame, DataFrame]:
    """The three tables, ``batches`` and ``minutes`` as of the newest recorded
    batch. The number is fixed here: later batches, and those under way, are not
    seen, however often the tables are read."""
    batches = read_table(spark, root, BATCHES)
    complete = F.col("batch_id") <= last_batch(batches)
    tables = [df.filter(complete) for df in read_tables(spark, root)]
    minutes = read_table(spark, root, MINUTES)
    return Tables(*tables), batches.filter(complete), minutes.filter(complete)
