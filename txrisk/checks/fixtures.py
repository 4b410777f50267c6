"""Payment messages and tables derived from the whole ``events`` test table."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.operators.routing import (
    alerts,
    facts,
    has_ids,
    rejects,
    sent_columns,
    with_defaults,
)
from txrisk.schemas import MESSAGE, POSITION, TABLES, Tables
from txrisk.session import scratch_dir
from txrisk.sources.messages import file_stream

EVENTS_DDL = (
    "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)

# What message fields are taken from. Rules speak of four of the countries and
# of one type of card.
CURRENCIES = ["NOK", "PLN", "CAD", "EUR", "AUD"]
MERCHANTS = [f"shop {k}" for k in range(10)]
COUNTRIES = ["AT", "CA", "IE", "KE", "MX", "NL", "PT", "CN", "SE", "NG", "RU", "UA"]
CARD_TYPES = ["debit", "credit", "amex", "prepaid"]

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def pick(values: list[str], number: str) -> str:
    """SQL for the list item a number selects."""
    items = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({items}), cast({number} % {len(values)} + 1 AS int))"


def parsed_events(events: DataFrame) -> DataFrame:
    """Events as parsed messages; every 33rd one lacks its user id. Amounts are
    whole or half units, so no rounding mode can change them."""
    k = "cast(get_json_object(props, '$.k') AS int)"
    return events.selectExpr(
        "cast(event_id % 3 AS int) AS kafka_partition",
        "event_id AS kafka_offset",
        "cast(event_id AS string) AS transaction_id",
        "CASE WHEN event_id % 33 <> 0 THEN concat('user_', user_id) END AS user_id",
        "rint(value * 100) / 2 AS amount",
        f"{pick(CURRENCIES, 'event_id')} AS currency",
        f"{pick(MERCHANTS, 'event_id')} AS merchant",
        f"{pick(COUNTRIES, 'user_id')} AS country",
        f"{pick(CARD_TYPES, 'event_id')} AS card_type",
        "lpad(cast(event_id % 10000 AS string), 4, '0') AS card_last4",
        f"concat(if({k} = 85, '185.', '10.'), event_id % 255, '.0.1') AS ip_address",
        f"{k} < 4 AS velocity_flag",
        "ts AS timestamp",
        "ts AS ingested_at",
    )


def raw_events(events: DataFrame) -> DataFrame:
    """Events as JSON messages in their envelope."""
    body = F.to_json(F.struct(*MESSAGE.names), {"timestampFormat": ISO_MICROS})
    return parsed_events(events).select(
        F.col("transaction_id").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.lit("transactions").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("ingested_at").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


class Fixture:
    """The test tables as the library sees them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def events(self) -> DataFrame:
        return self.spark.read.schema(EVENTS_DDL).parquet(f"{self.sf_dir}/events.parquet")

    @cached_property
    def event_stream(self) -> DataFrame:
        return file_stream(
            self.spark, self.sf_dir, EVENTS_DDL, pathGlobFilter="events.parquet"
        )

    @cached_property
    def parsed(self) -> DataFrame:
        return parsed_events(self.events)

    @cached_property
    def raw(self) -> DataFrame:
        return raw_events(self.events)

    @cached_property
    def raw_stream(self) -> DataFrame:
        return raw_events(self.event_stream)

    @cached_property
    def valid(self) -> DataFrame:
        return self.parsed.filter(has_ids())

    def table(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows as a database table returns them."""
        table = TABLES[name]
        sent = sent_columns(rows, table, *POSITION)
        return with_defaults(sent, table).select(*table.columns)

    @cached_property
    def transactions(self) -> DataFrame:
        return self.table("transactions", facts(self.parsed))

    @cached_property
    def alerts(self) -> DataFrame:
        """Some alerts are acknowledged, and some appear twice so that a join
        with them fans out."""
        copies = F.expr("explode(array_repeat(0, if(kafka_offset % 50 = 0, 2, 1)))")
        rows = alerts(self.parsed).withColumn("copy", copies)
        table = self.table("fraud_alerts", rows)
        return table.withColumn("acknowledged", F.col("transaction_id").cast("bigint") % 5 == 0)

    @cached_property
    def rejects(self) -> DataFrame:
        return self.table("dlq_messages", rejects(self.parsed))

    @property
    def tables(self) -> Tables:
        return Tables(self.transactions, self.alerts, self.rejects)

    @cached_property
    def as_of(self) -> Column:
        """Newest ingest time, so that relative periods give fixed results."""
        return self.transactions.agg(F.max("ingested_at")).scalar()

    @cached_property
    def moment(self) -> Column:
        """``as_of`` as a literal, for streams."""
        newest = self.transactions.agg(F.max("ingested_at").cast("string")).first()[0]
        return F.lit(newest).cast("timestamp")

    def scratch(self, label: str) -> str:
        return scratch_dir(self.spark, label)
