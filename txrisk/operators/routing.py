"""Split parsed messages into facts, alerts and rejects.

Every step is a narrow projection or filter, so scoring never shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions.parse import row_id, utc_day
from txrisk.functions.rules import DEFAULT_RULES, Rule, fraud_reason
from txrisk.schemas import DLQ_MESSAGES, FRAUD_ALERTS, POSITION, TRANSACTIONS, Table

SCHEMA_VIOLATION = "SCHEMA_VIOLATION"


def has_ids() -> Column:
    """Both ids are present; empty text counts as present."""
    return F.col("transaction_id").isNotNull() & F.col("user_id").isNotNull()


def lacks_ids() -> Column:
    return F.col("transaction_id").isNull() | F.col("user_id").isNull()


def violates(table: Table) -> Column:
    """A column the table declares NOT NULL, and a writer sends, is NULL."""
    required = [c for c in table.required if c in table.sent]
    return reduce(or_, [F.col(c).isNull() for c in required], F.lit(False))


def stored_amount() -> Column:
    """Amount as stored. One that the stored type has no form for, not a number
    or too large, becomes NULL; its row stays, and so does its alert."""
    return F.col("amount").try_cast("decimal(14,2)")


def error_type() -> Column:
    """Why a message is rejected, NULL for one that is kept."""
    return F.when(lacks_ids(), F.lit(SCHEMA_VIOLATION))


def facts(parsed: DataFrame) -> DataFrame:
    """All valid messages, alerted or not."""
    return parsed.filter(has_ids())


def scored(parsed: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Facts with the label of the first rule that holds. The rules see the
    amount as sent, before rounding to the stored type."""
    return facts(parsed).withColumn("fraud_reason", fraud_reason(rules))


def alerts(parsed: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    return scored(parsed, rules).filter(F.col("fraud_reason").isNotNull())


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("error_type", error_type()).filter(F.col("error_type").isNotNull())


def sent_columns(rows: DataFrame, table: Table, *extra: str) -> DataFrame:
    """The columns a writer sends to ``table``, the amount in its stored type."""
    if "amount" in table.sent:
        rows = rows.withColumn("amount", stored_amount())
    return rows.select(*table.sent, *[c for c in extra if c not in table.sent])


def with_defaults(rows: DataFrame, table: Table) -> DataFrame:
    """Fill in what a database would: the row id and the alert defaults."""
    values = {
        "id": row_id(),
        "acknowledged": F.lit(False),
        "notes": F.lit(None).cast("string"),
    }
    return rows.withColumns({c: values[c] for c in table.defaults})


def stored_rows(rows: DataFrame, table: Table, batch_id: int) -> DataFrame:
    """Rows in the table's stored layout."""
    rows = sent_columns(rows, table, *POSITION)
    rows = with_defaults(rows, table)
    rows = rows.withColumns(
        {
            "ingest_date": utc_day("ingested_at"),
            "batch_id": F.lit(batch_id).cast("bigint"),
        }
    )
    return rows.select(*table.stored.fieldNames())


def split(parsed: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> dict[str, DataFrame]:
    """Table name to the rows that belong in it."""
    return {
        TRANSACTIONS.name: facts(parsed),
        FRAUD_ALERTS.name: alerts(parsed, rules),
        DLQ_MESSAGES.name: rejects(parsed),
    }


def belongs(rules: Sequence[Rule] = DEFAULT_RULES) -> dict[str, Column]:
    """Table name to the condition on parsed rows under which they belong in it."""
    return {
        TRANSACTIONS.name: has_ids(),
        FRAUD_ALERTS.name: has_ids() & fraud_reason(rules).isNotNull(),
        DLQ_MESSAGES.name: error_type().isNotNull(),
    }


def sizes(parsed: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> dict[str, int]:
    """Table name to the number of rows that belong in it, in one job."""
    counts = [F.count_if(condition).alias(name) for name, condition in belongs(rules).items()]
    return parsed.agg(*counts).first().asDict()


def size_metrics(rules: Sequence[Rule] = DEFAULT_RULES) -> list[Column]:
    """Figures of a batch to observe while it is read: per table the rows
    (``table.rows``), those without an ingest time, and the first and last
    ingest time in microseconds."""
    time = F.col("ingested_at")
    metrics = []
    for name, condition in belongs(rules).items():
        micros = F.when(condition, F.unix_micros(time))
        metrics += [
            F.count_if(condition).alias(f"{name}.rows"),
            F.count_if(condition & time.isNull()).alias(f"{name}.untimed"),
            F.min(micros).alias(f"{name}.first"),
            F.max(micros).alias(f"{name}.last"),
        ]
    return metrics


def checked(rows: DataFrame, table: Table) -> DataFrame:
    """The rows, failing at the first that lacks a column the table declares
    NOT NULL and a writer sends. Parquet keeps no such declaration, so it is
    enforced in the plan that writes, whatever sink runs it."""
    required = [c for c in table.required if c in table.sent]
    values = {
        c: F.when(
            F.col(c).isNull(), F.raise_error(F.lit(f"{table.name}.{c} must not be NULL"))
        ).otherwise(F.col(c))
        for c in required
    }
    return rows.withColumns(values)
