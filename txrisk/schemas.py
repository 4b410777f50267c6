"""Declared contracts: the message body, its envelope and the three tables."""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def schema(*required: str, **types: str) -> StructType:
    """Struct of the given columns, NOT NULL where required."""
    struct = StructType()
    for name, kind in types.items():
        struct.add(name, kind, nullable=name not in required)
    return struct


# Field names and types of the message and of the stored tables.
MESSAGE = schema(
    transaction_id="string",
    user_id="string",
    amount="double",
    currency="string",
    merchant="string",
    country="string",
    card_type="string",
    card_last4="string",
    ip_address="string",
    velocity_flag="boolean",
    timestamp="string",
)

ENVELOPE = schema(
    key="binary",
    value="binary",
    topic="string",
    partition="integer",
    offset="long",
    timestamp="timestamp",
    timestampType="integer",
)

# Columns the stored files carry beyond a table's contract. The first two say
# which message a row came from, the last two are the partition directories.
POSITION = ["kafka_partition", "kafka_offset"]
LAYOUT = ["ingest_date", "batch_id"]
STORAGE = schema(
    kafka_partition="integer", kafka_offset="long", ingest_date="date", batch_id="long"
)


@dataclass(frozen=True)
class Table:
    """A table contract. ``defaults`` are the columns a writer leaves out and
    the table fills in."""

    name: str
    contract: StructType
    defaults: tuple[str, ...] = ("id",)
    extra: tuple[str, ...] = (*POSITION, *LAYOUT)

    @property
    def columns(self) -> list[str]:
        return self.contract.fieldNames()

    @property
    def sent(self) -> list[str]:
        """Columns a writer sends, in order."""
        return [c for c in self.columns if c not in self.defaults]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.contract if not f.nullable]

    @property
    def stored(self) -> StructType:
        """Contract plus the columns above, as kept in files."""
        extra = [f for f in STORAGE if f.name in self.extra and f.name not in self.columns]
        return StructType(self.contract.fields + extra)


TRANSACTIONS = Table(
    "transactions",
    schema(
        "id",
        "transaction_id",
        "user_id",
        id="long",
        transaction_id="string",
        user_id="string",
        amount="decimal(14,2)",
        currency="string",
        merchant="string",
        country="string",
        card_type="string",
        card_last4="string",
        ip_address="string",
        velocity_flag="boolean",
        timestamp="timestamp",
        ingested_at="timestamp",
    ),
)

FRAUD_ALERTS = Table(
    "fraud_alerts",
    schema(
        "id",
        "transaction_id",
        "fraud_reason",
        id="long",
        transaction_id="string",
        user_id="string",
        amount="decimal(14,2)",
        currency="string",
        merchant="string",
        country="string",
        card_type="string",
        card_last4="string",
        ip_address="string",
        fraud_reason="string",
        timestamp="timestamp",
        ingested_at="timestamp",
        acknowledged="boolean",
        notes="string",
    ),
    defaults=("id", "acknowledged", "notes"),
)

DLQ_MESSAGES = Table(
    "dlq_messages",
    schema(
        "id",
        id="long",
        kafka_offset="long",
        kafka_partition="integer",
        error_type="string",
        ingested_at="timestamp",
    ),
)

TABLES = {t.name: t for t in (TRANSACTIONS, FRAUD_ALERTS, DLQ_MESSAGES)}

# What the stream keeps beside the tables: one row per batch and table when the
# batch is complete, and counts per minute that can be added up over batches.
BATCHES = Table(
    "batches",
    schema(
        "table_name",
        "rows",
        "total_rows",
        table_name="string",
        rows="long",
        total_rows="long",
        untimed="long",
        first_ingest="timestamp",
        last_ingest="timestamp",
    ),
    defaults=(),
    extra=tuple(LAYOUT),
)

MINUTES = Table(
    "minutes",
    schema(
        "table_name",
        "n",
        table_name="string",
        minute="timestamp",
        fraud_reason="string",
        country="string",
        n="long",
    ),
    defaults=(),
    extra=tuple(LAYOUT),
)


class Tables(NamedTuple):
    """The rows of the three tables."""

    transactions: DataFrame
    fraud_alerts: DataFrame
    dlq_messages: DataFrame
