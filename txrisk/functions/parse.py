"""Message bytes to typed transaction columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.schemas import MESSAGE


def envelope(raw: DataFrame) -> DataFrame:
    """Where each message came from, and its body as text."""
    return raw.select(
        F.col("offset").alias("kafka_offset"),
        F.col("partition").alias("kafka_partition"),
        F.col("value").cast("string").alias("body"),
    )


def message_struct(body: str | Column = "body") -> Column:
    """Body text as a struct. Broken text gives a struct of NULLs (or a NULL
    struct), a field of the wrong type gives a NULL field; neither raises."""
    return F.from_json(body, MESSAGE)


def event_time(text: str | Column = "timestamp") -> Column:
    """ISO-8601 text to timestamp, NULL for anything else, ANSI mode or not."""
    return F.try_to_timestamp(text)


def transactions(raw: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Envelope rows to one flat row per message.

    ``stamp`` is the ingest time, by default the current time, which Spark
    holds constant within a query or micro-batch. It may refer to the parsed
    columns.

    The struct is expanded by ``inline`` and not by ``tx.*``: Spark moves
    filters below a projection and would then parse the body once for every
    field a filter mentions. It does not move them below a generator.
    """
    return (
        envelope(raw)
        .select("kafka_offset", "kafka_partition", F.inline(F.array(message_struct())))
        .withColumn("timestamp", event_time())
        .withColumn("ingested_at", F.current_timestamp() if stamp is None else stamp)
    )


def row_id() -> Column:
    """Repeatable row identity from the message position: unique without a
    global sequence, and the same when a batch is written again."""
    partition = F.col("kafka_partition").cast("bigint")
    return F.shiftleft(partition, 48) + F.col("kafka_offset")


def utc_day(time: str | Column) -> Column:
    """Day of a timestamp in UTC, whatever the session time zone: writers and
    readers of a table agree on the partition of a row."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(time) / 86_400).cast("int"))
