"""Report figures kept up to date by streaming queries.

Polling recounts stored rows at every look; these queries count each message
once and keep what is open in state that a watermark bounds. Each takes parsed
rows of a stream (``parse.transactions``, ``routing.facts`` and ``alerts``) with
``ingested_at`` as event time. Rows older than the watermark are dropped; with
the default ingest time, the clock, there are none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from txrisk.operators.matching import ID
from txrisk.operators.repeats import TIME, once
from txrisk.streaming.job import TRIGGER
from txrisk.streaming.sinks import write_tasks

MINUTE = "1 minute"
# How far rows may lag behind the newest one.
LATENESS = "2 minutes"
# Seconds between a transaction and an alert that marks it, either way.
WITHIN = 300


def windowed_rate(facts: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Transactions per minute (``minute``, ``ticks``). Counts are combined
    before they meet, so a minute's rows never come to one task; state holds the
    open minutes only."""
    return (
        facts.withWatermark(TIME, lateness)
        .groupBy(F.window(TIME, MINUTE))
        .agg(F.count(F.lit(1)).alias("ticks"))
        .select(F.col("window.start").alias("minute"), "ticks")
    )


def live_activity(facts: DataFrame, alerts: DataFrame, within: int = WITHIN) -> DataFrame:
    """Transactions per minute, and how many have an alert (``minute``,
    ``total``, ``fraud``), from a stream of each.

    An alert marks the transactions of its id that are at most ``within``
    seconds older or newer. Of several alerts for an id the first counts: the
    watermark trails by twice that time, so while a second one can reach a
    transaction of the first, the first is still known. A minute is given when
    no alert can reach it any more.
    """
    lateness = f"{2 * within} seconds"
    marks = once(alerts.select(F.col(ID).alias("alert_id"), TIME), lateness, ["alert_id"])
    marks = marks.withColumnRenamed(TIME, "alerted_at")
    reach = F.expr(f"INTERVAL {within} SECONDS")
    meets = (
        (F.col(ID) == F.col("alert_id"))
        & (F.col("alerted_at") >= F.col(TIME) - reach)
        & (F.col("alerted_at") <= F.col(TIME) + reach)
    )
    joined = facts.select(ID, TIME).withWatermark(TIME, lateness).join(marks, meets, "left_outer")
    return (
        joined.groupBy(F.window(TIME, MINUTE))
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(F.col("alert_id").isNotNull()).alias("fraud"),
        )
        .select(F.col("window.start").alias("minute"), "total", "fraud")
    )


def start_minutes(
    figures: DataFrame,
    path: str,
    checkpoint: str,
    *,
    mode: str = "update",
    available_now: bool = False,
    interval: str = TRIGGER,
) -> StreamingQuery:
    """Keep per-minute figures in files under ``path``. A batch holds the
    minutes it changed (``update``) or closed (``append``, which joins need) and
    replaces its own directory if it is written again.

    The batch is held before its few files are written: merged at once, all
    partitions of the state would be worked through, and held, by one task."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            n = rows.count()
            files = rows.coalesce(write_tasks(n, n))
            files.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        figures.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_minutes(
    spark: SparkSession, path: str, schema: StructType, since: Column | None = None
) -> DataFrame:
    """The newest figures of every minute, or of those from ``since`` on."""
    stored = StructType(schema.fields).add("batch_id", "long")
    rows = spark.read.schema(stored).parquet(path)
    if since is not None:
        rows = rows.filter(F.col("minute") >= since)
    values = [c for c in schema.names if c != "minute"]
    newest = F.max_by(F.struct(*values), "batch_id").alias("newest")
    return rows.groupBy("minute").agg(newest).select("minute", "newest.*")
