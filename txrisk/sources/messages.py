"""Streaming message sources. All of them yield the same envelope columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from txrisk.schemas import ENVELOPE


def kafka_options(servers: str, topic: str, **more: str) -> dict[str, str]:
    """Options of the topic source. A first start begins at the newest offset,
    later ones at the checkpoint; offsets the broker no longer has are skipped.

    ``more`` takes any source option, for example ``maxOffsetsPerTrigger``, or
    ``minPartitions`` to split a topic partition that is much fuller than the
    others over several tasks.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        **more,
    }


def topic_stream(spark: SparkSession, servers: str, topic: str, **more: str) -> DataFrame:
    """Messages of a topic; needs the Spark Kafka connector on the class path."""
    options = kafka_options(servers, topic, **more)
    return spark.readStream.format("kafka").options(**options).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: str | StructType = ENVELOPE,
    fmt: str = "parquet",
    **more: str,
) -> DataFrame:
    """Messages from files that arrive in a directory."""
    return spark.readStream.schema(schema).format(fmt).options(**more).load(path)
