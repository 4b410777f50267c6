"""SQL text of the fixture views, shared by the SQL twins of the queries."""

from __future__ import annotations

from txrisk.checks.fixtures import CARD_TYPES, COUNTRIES, CURRENCIES, MERCHANTS


def _pick(values: list[str], number: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"[{items}][1 + {number} % {len(values)}]"


VIEWS = f"""
WITH keyed AS (
    SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
), parsed AS (
    SELECT CAST(event_id % 3 AS INTEGER) AS kafka_partition,
           event_id AS kafka_offset,
           CAST(event_id AS VARCHAR) AS transaction_id,
           CASE WHEN event_id % 33 <> 0 THEN 'user_' || user_id END AS user_id,
           CAST(value * 50 AS DECIMAL(14,2)) AS amount,
           {_pick(CURRENCIES, "event_id")} AS currency,
           {_pick(MERCHANTS, "event_id")} AS merchant,
           {_pick(COUNTRIES, "user_id")} AS country,
           {_pick(CARD_TYPES, "event_id")} AS card_type,
           lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0') AS card_last4,
           CASE WHEN k = 85 THEN '185.' ELSE '10.' END
               || (event_id % 255) || '.0.1' AS ip_address,
           k < 4 AS velocity_flag,
           ts AS "timestamp",
           ts AS ingested_at,
           (CAST(event_id % 3 AS BIGINT) << 48) + event_id AS id
    FROM keyed
), transactions AS (
    SELECT * FROM parsed WHERE transaction_id IS NOT NULL AND user_id IS NOT NULL
), dlq_messages AS (
    SELECT id, kafka_offset, kafka_partition,
           'SCHEMA_VIOLATION' AS error_type, ingested_at
    FROM parsed WHERE transaction_id IS NULL OR user_id IS NULL
), scored AS (
    SELECT *, CASE
        WHEN amount > 9000 THEN 'HIGH_AMOUNT'
        WHEN country IN ('NG', 'CN', 'RU', 'UA') AND amount > 500 THEN 'HIGH_RISK_COUNTRY'
        WHEN ip_address LIKE '185.%' THEN 'SUSPICIOUS_IP'
        WHEN card_type = 'amex' AND amount > 5000 THEN 'AMEX_LARGE'
        WHEN velocity_flag THEN 'VELOCITY_FRAUD'
    END AS fraud_reason
    FROM transactions
), flagged AS (
    SELECT * FROM scored WHERE fraud_reason IS NOT NULL
), fraud_alerts AS (
    SELECT *, kafka_offset % 5 = 0 AS acknowledged, CAST(NULL AS VARCHAR) AS notes
    FROM (SELECT * FROM flagged
          UNION ALL SELECT * FROM flagged WHERE kafka_offset % 50 = 0) AS copies
), streamed_alerts AS (
    SELECT *, false AS acknowledged FROM flagged
), moment AS (
    SELECT max(ingested_at) AS as_of FROM transactions
), alert_log AS (
    SELECT * FROM fraud_alerts
    ORDER BY ingested_at DESC NULLS FIRST, transaction_id, id LIMIT 200
), recent_transactions AS (
    SELECT * FROM transactions
    ORDER BY ingested_at DESC NULLS FIRST, transaction_id LIMIT 100
)
"""


def since(interval: str) -> str:
    """Condition on ``ingested_at`` for a period that ends at the fixture's moment."""
    return f"ingested_at >= (SELECT as_of FROM moment) - INTERVAL '{interval}'"
