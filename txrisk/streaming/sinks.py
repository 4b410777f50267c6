"""Per-batch writers. Writing the same batch again changes nothing."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.operators.routing import sent_columns, stored_rows
from txrisk.schemas import LAYOUT, POSITION, Table

# Takes the rows, the table, the batch id and the number of tasks to write with.
Sink = Callable[[DataFrame, Table, int, int], None]

# Rows a task should write, about half a second's work, and how many times as
# many it may have to look at to find them.
ROWS_PER_TASK = 50_000
LOOK_THROUGH = 40


def write_tasks(rows: int, batch_rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Tasks to write some of a batch's rows with. Fewer tasks give fewer files;
    the second bound keeps a rare kind of row from being searched for by one
    task in the whole of a large batch."""
    return max(1, ceil(rows / rows_per_task), ceil(batch_rows / (rows_per_task * LOOK_THROUGH)))


def parquet_sink(root: str) -> Sink:
    """Files under ``root``, one directory per day and batch.

    A batch overwrites its own directories only, so a batch that is retried
    after a failure replaces what the first try left. A small batch that many
    tasks hold is merged into few files without a shuffle.
    """

    def write(rows: DataFrame, table: Table, batch_id: int, tasks: int) -> None:
        (
            stored_rows(rows, table, batch_id)
            .coalesce(tasks)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*LAYOUT)
            .parquet(f"{root}/{table.name}")
        )

    return write


def without_stored(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows whose message position is not among the stored ones."""
    return rows.join(stored.select(*POSITION), POSITION, "left_anti")


def replay_predicates(batch_id: int, partitions: int) -> list[str]:
    """WHERE clauses that read one batch back in ``partitions`` slices."""
    return [
        f"batch_id = {batch_id} AND MOD(kafka_offset, {partitions}) = {i}"
        for i in range(partitions)
    ]


def jdbc_sink(
    url: str, properties: dict[str, str], connections: int = 16, replay_safe: bool = True
) -> Sink:
    """Append to database tables by column name; columns that are not sent take
    the table's defaults. At most ``connections`` tasks write at a time.

    Appending alone repeats the rows of a batch that is retried. With
    ``replay_safe`` the tables must also have ``kafka_partition``,
    ``kafka_offset`` and ``batch_id``: a batch that may be a retry then skips
    what is stored already. That is the first one after a start, one after a
    write that failed, and one whose id is not above the last that was written.
    A unique key on the message position turns a repeated insert by a retried
    task into an error, and the restart that follows completes the batch.
    """
    written: dict[str, int] = {}

    def write(rows: DataFrame, table: Table, batch_id: int, tasks: int) -> None:
        if not replay_safe:
            batch = sent_columns(rows, table)
        else:
            batch = sent_columns(rows, table, *POSITION)
            batch = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            # Forgotten until this write is known to be good.
            last = written.pop(table.name, None)
            if last is None or batch_id <= last:
                predicates = replay_predicates(batch_id, connections)
                stored = batch.sparkSession.read.jdbc(
                    url, table.name, predicates=predicates, properties=properties
                )
                batch = without_stored(batch, stored)
        batch.write.option("numPartitions", min(tasks, connections)).jdbc(
            url, table.name, mode="append", properties=properties
        )
        written[table.name] = batch_id

    return write
