"""Formats applied to report results."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# The sign shown before each rule label, and the one for others.
RULE_SIGNS = {
    "HIGH_AMOUNT": "🔴",
    "HIGH_RISK_COUNTRY": "🟡",
    "SUSPICIOUS_IP": "🔵",
    "AMEX_LARGE": "🟠",
    "VELOCITY_FRAUD": "🟣",
}
OTHER_SIGN = "⚪"


def signed_rule(label: str | Column = "fraud_reason") -> Column:
    """Label with its sign in front."""
    label = F.col(label) if isinstance(label, str) else label
    signs = F.create_map(*map(F.lit, chain.from_iterable(RULE_SIGNS.items())))
    return F.concat_ws(" ", F.coalesce(F.try_element_at(signs, label), F.lit(OTHER_SIGN)), label)


def to_number(value: str | Column) -> Column:
    """Number, or NULL where the value is not one."""
    return (F.col(value) if isinstance(value, str) else value).try_cast("double")


def or_zero(value: str | Column) -> Column:
    return F.coalesce(value, F.lit(0))


def percent_text(value: str | Column) -> Column:
    return F.format_string("%.2f%%", or_zero(value).cast("double"))


def dollars(value: str | Column = "amount") -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value.isNotNull(), F.format_string("$%.2f", value.cast("double")))


def second_text(value: str | Column) -> Column:
    """Timestamp to the second, a dash for NULL."""
    return F.coalesce(F.date_format(value, "yyyy-MM-dd HH:mm:ss"), F.lit("—"))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Every decimal column as double, the others unchanged."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )
