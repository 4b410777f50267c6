"""Messages to tables, as one streaming query.

A single query reads and parses each message once and gives it one ingest time
for all tables. In exchange a failing sink stops all three; since the sinks
accept a repeated batch, the restart is safe.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from txrisk.functions.parse import transactions
from txrisk.functions.rules import DEFAULT_RULES, Rule
from txrisk.operators.repeats import once
from txrisk.operators.routing import checked, size_metrics, split
from txrisk.schemas import DLQ_MESSAGES, TABLES, TRANSACTIONS
from txrisk.streaming.ledger import Ledger, Sizes, observed_sizes
from txrisk.streaming.sinks import ROWS_PER_TASK, Sink, write_tasks

log = logging.getLogger(__name__)

TRIGGER = "5 seconds"

Report = Callable[[int, Sizes], None]


def log_sizes(batch_id: int, sizes: Sizes) -> None:
    for name, figures in sizes.items():
        log.info("batch %d: %d rows to %s", batch_id, figures["rows"], name)


def batch_writer(
    sink: Sink,
    tables: Sequence[str] = tuple(TABLES),
    rules: Sequence[Rule] = DEFAULT_RULES,
    rows_per_task: int = ROWS_PER_TASK,
    ledger: Ledger | None = None,
    report: Report = log_sizes,
) -> Callable[[DataFrame, int], None]:
    """Body of the query: split a batch and write the named tables in order.

    The batch is held while it is written, so its messages are read and parsed
    once, and its sizes are observed in that pass: while its counts per minute
    are stored, or, without a ``ledger``, while it is brought into memory. A
    table without rows is left alone. ``report`` is told the sizes before the
    tables are written. The ledger's record ends the batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        batch = batch.observe(seen, *size_metrics(rules)).persist()
        try:
            if ledger is not None:
                counted = ledger.count(batch, batch_id, rules)
                if not counted:
                    return
            else:
                batch.write.format("noop").mode("overwrite").save()
            sizes = observed_sizes(seen.get)
            report(batch_id, sizes)
            rows = {name: sizes[name]["rows"] for name in TABLES}
            batch_rows = rows[TRANSACTIONS.name] + rows[DLQ_MESSAGES.name]
            parts = split(batch, rules)
            for name in tables:
                if rows[name]:
                    tasks = write_tasks(rows[name], batch_rows, rows_per_task)
                    sink(checked(parts[name], TABLES[name]), TABLES[name], batch_id, tasks)
            if ledger is not None:
                none = {"rows": 0, "untimed": 0}
                exact = {n: {**sizes[n], **none, **counted.get(n, {})} for n in tables}
                ledger.commit(batch_id, exact)
        finally:
            batch.unpersist()

    return write


def start(
    raw: DataFrame,
    sink: Sink,
    checkpoint: str,
    *,
    tables: Sequence[str] = tuple(TABLES),
    rules: Sequence[Rule] = DEFAULT_RULES,
    rows_per_task: int = ROWS_PER_TASK,
    stamp: Column | None = None,
    available_now: bool = False,
    interval: str = TRIGGER,
    guard: str | None = None,
    ledger: Ledger | None = None,
    report: Report = log_sizes,
) -> StreamingQuery:
    """Start the query on an envelope stream.

    ``available_now`` processes what is there and ends, instead of polling
    every ``interval``; a longer one gives fewer, larger files. ``stamp``
    replaces the ingest time. With ``guard``, such as ``10 minutes``, a message
    that the stream delivers again within that time is left out. A ``ledger``
    under the root of the tables makes batches visible as a whole.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    rows = transactions(raw, stamp)
    if guard is not None:
        rows = once(rows, guard)
    write = batch_writer(sink, tables, rules, rows_per_task, ledger, report)
    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run(spark: SparkSession, query: StreamingQuery) -> None:
    """Wait until any query of the session ends, then stop this one. The error
    of a failed query is raised."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        query.stop()
