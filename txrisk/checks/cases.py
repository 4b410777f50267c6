"""One case per operator: a DataFrame over the fixture and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.checks.fixtures import ISO_MICROS, Fixture
from txrisk.checks.oracle import VIEWS, since
from txrisk.functions import display, parse, rules
from txrisk.operators import matching, ranking, recent, routing
from txrisk.operators.repeats import once
from txrisk.plans import panels, reports, rollups
from txrisk.schemas import (
    DLQ_MESSAGES,
    ENVELOPE,
    FRAUD_ALERTS,
    MESSAGE,
    POSITION,
    TABLES,
    TRANSACTIONS,
    Table,
    Tables,
)
from txrisk.sources import by_id
from txrisk.sources.messages import file_stream
from txrisk.sources.tables import create_tables, read_table, read_tables, register, run_query
from txrisk.streaming.job import batch_writer, start
from txrisk.streaming.live import live_activity, read_minutes, start_minutes, windowed_rate
from txrisk.streaming.ledger import Ledger, Sizes, snapshot
from txrisk.streaming.sinks import parquet_sink

Build = Callable[[Fixture], DataFrame]
CASES: dict[str, tuple[Build, str | None]] = {}


def case(key: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query. The SQL may use the views of ``VIEWS``."""

    def add(build: Build) -> Build:
        CASES[key] = (build, sql and VIEWS + sql)
        return build

    return add


def naive_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, the type of the test tables."""
    times = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def query(build: Build) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return naive_times(build(Fixture(spark, sf_dir)))

    return run


def quoted(columns: list[str]) -> str:
    return ", ".join(f'"{c}"' for c in columns)


def streamed(f: Fixture, *names: str) -> str:
    """Run the message stream to its end; the folder of the written tables.
    The ingest time is the message's own, so that results can be compared."""
    root = f.scratch("tables")
    create_tables(f.spark, root)
    start(
        f.raw_stream,
        parquet_sink(root),
        f.scratch("checkpoint"),
        tables=names or tuple(TABLES),
        stamp=F.col("timestamp"),
        available_now=True,
    ).awaitTermination()
    return root


def recorded(f: Fixture) -> str:
    """As ``streamed``, with the records of its batches."""
    root = f.scratch("tables")
    create_tables(f.spark, root)
    ledger = Ledger(f.spark, root)
    ledger.create()
    start(
        f.raw_stream, parquet_sink(root), f.scratch("checkpoint"),
        stamp=F.col("timestamp"), available_now=True, ledger=ledger,
    ).awaitTermination()
    return root


def in_two_batches(f: Fixture, first: DataFrame, second: DataFrame) -> DataFrame:
    """A stream of messages whose first batch is ``first`` and whose second is
    ``second``. Each is written by as many tasks as read it; a batch takes as
    many files as the first has, and the oldest come first."""
    path = f.scratch("messages")
    first.write.parquet(path)
    files = len(f.spark.read.schema(ENVELOPE).parquet(path).inputFiles())
    second.write.mode("append").parquet(path)
    return file_stream(f.spark, path, ENVELOPE, maxFilesPerTrigger=str(files))


SCORED = ["transaction_id", "fraud_reason"]

# --- sources ---------------------------------------------------------------


@case(
    "src_01_stream_source",
    "SELECT kafka_partition, kafka_offset, transaction_id, user_id FROM parsed",
)
def _(f: Fixture) -> DataFrame:
    target = f.scratch("messages")
    columns = [*POSITION, "transaction_id", "user_id"]
    (
        parse.transactions(f.raw_stream)
        .select(*columns)
        .writeStream.format("parquet")
        .option("checkpointLocation", f.scratch("checkpoint"))
        .trigger(availableNow=True)
        .start(target)
        .awaitTermination()
    )
    return f.spark.read.schema(f.parsed.select(*columns).schema).parquet(target)


@case(
    "src_02_envelope",
    "SELECT kafka_offset, kafka_partition, transaction_id AS body_id FROM parsed",
)
def _(f: Fixture) -> DataFrame:
    return parse.envelope(f.raw).select(
        "kafka_offset", "kafka_partition",
        F.get_json_object("body", "$.transaction_id").alias("body_id"),
    )


@case("src_03_scan_transactions", f"SELECT {quoted(TRANSACTIONS.columns)} FROM transactions")
def _(f: Fixture) -> DataFrame:
    return f.transactions


@case("src_03_scan_fraud_alerts", f"SELECT {quoted(FRAUD_ALERTS.columns)} FROM fraud_alerts")
def _(f: Fixture) -> DataFrame:
    return f.alerts


@case("src_03_scan_dlq_messages", f"SELECT {quoted(DLQ_MESSAGES.columns)} FROM dlq_messages")
def _(f: Fixture) -> DataFrame:
    return f.rejects


@case(
    "src_04_parameterised_query",
    """SELECT country, count(*) AS n FROM transactions
       WHERE ingested_at >= TIMESTAMP '2024-01-15 00:00:00' AND amount > 500
       GROUP BY country""",
)
def _(f: Fixture) -> DataFrame:
    register(f.tables)
    return run_query(
        f.spark,
        """SELECT country, count(*) AS n FROM transactions
           WHERE ingested_at >= to_timestamp(:since) AND amount > :amount
           GROUP BY country""",
        {"since": "2024-01-15 00:00:00", "amount": 500},
    )


@case(
    "src_05_contract_violations",
    """SELECT kafka_partition, kafka_offset, transaction_id IS NULL AS no_transaction,
              user_id IS NULL AS no_user
       FROM parsed WHERE transaction_id IS NULL OR user_id IS NULL""",
)
def _(f: Fixture) -> DataFrame:
    return f.parsed.filter(routing.violates(TRANSACTIONS)).select(
        *POSITION,
        F.col("transaction_id").isNull().alias("no_transaction"),
        F.col("user_id").isNull().alias("no_user"),
    )


# --- sinks -----------------------------------------------------------------

FACTS_SQL = f"SELECT {quoted(TRANSACTIONS.sent)} FROM transactions"
ALERTS_SQL = f"SELECT {quoted(FRAUD_ALERTS.sent)} FROM flagged"
REJECTS_SQL = f"SELECT {quoted(DLQ_MESSAGES.sent)} FROM dlq_messages"
ROWS_SQL = """
    SELECT 'transactions' AS table_name, count(*) AS n FROM transactions
    UNION ALL SELECT 'fraud_alerts', count(*) FROM flagged
    UNION ALL SELECT 'dlq_messages', count(*) FROM dlq_messages"""


def rows_per_table(f: Fixture, root: str) -> DataFrame:
    counts = [
        reports.row_count(read_table(f.spark, root, table)).select(
            F.lit(name).alias("table_name"), "n"
        )
        for name, table in TABLES.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@case("snk_01_batch_writer", ROWS_SQL)
def _(f: Fixture) -> DataFrame:
    """The writer on a bounded batch, outside a stream."""
    root = f.scratch("tables")
    batch_writer(parquet_sink(root))(parse.transactions(f.raw, F.col("timestamp")), 0)
    return rows_per_table(f, root)


@case("snk_02_transactions_sink", FACTS_SQL)
def _(f: Fixture) -> DataFrame:
    root = streamed(f, "transactions")
    return read_table(f.spark, root, TRANSACTIONS).select(*TRANSACTIONS.sent)


@case("snk_03_alerts_sink", ALERTS_SQL)
def _(f: Fixture) -> DataFrame:
    root = streamed(f, "fraud_alerts")
    return read_table(f.spark, root, FRAUD_ALERTS).select(*FRAUD_ALERTS.sent)


@case("snk_04_dlq_sink", REJECTS_SQL)
def _(f: Fixture) -> DataFrame:
    root = streamed(f, "dlq_messages")
    return read_table(f.spark, root, DLQ_MESSAGES).select(*DLQ_MESSAGES.sent)


@case("snk_06_amount_coercion", "SELECT kafka_offset, amount FROM parsed")
def _(f: Fixture) -> DataFrame:
    return f.parsed.select("kafka_offset", routing.stored_amount().alias("amount"))


@case(
    "snk_07_alert_defaults",
    """SELECT id, transaction_id, false AS acknowledged, CAST(NULL AS VARCHAR) AS notes
       FROM flagged""",
)
def _(f: Fixture) -> DataFrame:
    rows = routing.with_defaults(routing.alerts(f.parsed), FRAUD_ALERTS)
    return rows.select("id", "transaction_id", "acknowledged", "notes")


@case("snk_08_row_id", "SELECT id, kafka_partition, kafka_offset FROM parsed")
def _(f: Fixture) -> DataFrame:
    return f.parsed.select(parse.row_id().alias("id"), *POSITION)


# --- projections -----------------------------------------------------------


@case("prj_01_bytes_to_text", "SELECT kafka_offset, transaction_id AS key_text FROM parsed")
def _(f: Fixture) -> DataFrame:
    return f.raw.select(
        F.col("offset").alias("kafka_offset"), F.col("key").cast("string").alias("key_text")
    )


@case("prj_02_json_to_struct", f"SELECT kafka_offset, {quoted(MESSAGE.names[:-1])} FROM parsed")
def _(f: Fixture) -> DataFrame:
    tx = parse.message_struct()
    fields = [
        F.col("tx.amount").cast("decimal(14,2)").alias(c) if c == "amount" else F.col(f"tx.{c}")
        for c in MESSAGE.names[:-1]
    ]
    return parse.envelope(f.raw).withColumn("tx", tx).select("kafka_offset", *fields)


@case("prj_03_struct_expansion", f"SELECT kafka_offset, {quoted(MESSAGE.names)} FROM parsed")
def _(f: Fixture) -> DataFrame:
    parsed = parse.transactions(f.raw)
    return parsed.withColumn("amount", routing.stored_amount()).select("kafka_offset", *MESSAGE.names)


@case(
    "prj_04_event_time",
    """SELECT event_id, ts AS parsed_time, TRY_CAST(event_type AS TIMESTAMP) AS bad_time
       FROM events""",
)
def _(f: Fixture) -> DataFrame:
    text = F.date_format("ts", ISO_MICROS)
    return f.events.select(
        "event_id",
        parse.event_time(text).alias("parsed_time"),
        parse.event_time("event_type").alias("bad_time"),
    )


@case("prj_05_ingest_stamp", "SELECT kafka_offset, ingested_at FROM parsed")
def _(f: Fixture) -> DataFrame:
    return parse.transactions(f.raw, F.col("timestamp")).select("kafka_offset", "ingested_at")


@case("prj_06_transaction_columns", FACTS_SQL)
def _(f: Fixture) -> DataFrame:
    return routing.sent_columns(routing.facts(f.parsed), TRANSACTIONS)


@case("prj_06_alert_columns", ALERTS_SQL)
def _(f: Fixture) -> DataFrame:
    return routing.sent_columns(routing.alerts(f.parsed), FRAUD_ALERTS)


@case("prj_07_first_match_label", "SELECT transaction_id, fraud_reason FROM scored")
def _(f: Fixture) -> DataFrame:
    return routing.scored(f.parsed).select(*SCORED)


@case("prj_08_constant_column", REJECTS_SQL)
def _(f: Fixture) -> DataFrame:
    return routing.sent_columns(routing.rejects(f.parsed), DLQ_MESSAGES)


ALERT_LOG = ["id", "transaction_id", "user_id", "amount", "currency", "merchant",
             "country", "card_type", "fraud_reason", "ingested_at", "acknowledged"]
RECENT = ["transaction_id", "user_id", "amount", "currency", "merchant",
          "country", "card_type", "timestamp", "ingested_at"]


@case("prj_09_alert_log", f"SELECT {quoted(ALERT_LOG)} FROM alert_log")
def _(f: Fixture) -> DataFrame:
    return reports.alert_log(f.alerts)


@case("prj_10_recent_transactions", f"SELECT {quoted(RECENT)} FROM recent_transactions")
def _(f: Fixture) -> DataFrame:
    return reports.recent_transactions(f.transactions)


@case(
    "prj_11_raw_preview",
    f"""SELECT {quoted(TRANSACTIONS.columns)} FROM transactions
        ORDER BY ingested_at DESC NULLS FIRST, transaction_id LIMIT 20""",
)
def _(f: Fixture) -> DataFrame:
    return reports.raw_preview(f.transactions)


SIGNED_SQL = """CASE {0}
    WHEN 'HIGH_AMOUNT' THEN '🔴' WHEN 'HIGH_RISK_COUNTRY' THEN '🟡'
    WHEN 'SUSPICIOUS_IP' THEN '🔵' WHEN 'AMEX_LARGE' THEN '🟠'
    WHEN 'VELOCITY_FRAUD' THEN '🟣' ELSE '⚪' END || ' ' || {0}"""


@case(
    "prj_12_signed_rule",
    f"""SELECT transaction_id, {SIGNED_SQL.format("fraud_reason")} AS rule,
               {SIGNED_SQL.format("merchant")} AS other FROM flagged""",
)
def _(f: Fixture) -> DataFrame:
    return routing.alerts(f.parsed).select(
        "transaction_id",
        display.signed_rule().alias("rule"),
        display.signed_rule("merchant").alias("other"),
    )


@case(
    "prj_13_alert_table",
    f"""SELECT id, transaction_id, user_id, CAST(amount AS DOUBLE) AS amount, currency,
               merchant, country, card_type, {SIGNED_SQL.format("fraud_reason")} AS rule,
               ingested_at, acknowledged FROM alert_log""",
)
def _(f: Fixture) -> DataFrame:
    return panels.alert_table(reports.alert_log(f.alerts))


@case(
    "prj_14_decimals_to_double",
    """SELECT fraud_reason, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total,
              CAST(max(amount) AS DOUBLE) AS largest FROM fraud_alerts GROUP BY fraud_reason""",
)
def _(f: Fixture) -> DataFrame:
    grouped = f.alerts.groupBy("fraud_reason").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("amount").alias("total"),
        F.max("amount").alias("largest"),
    )
    return display.decimals_to_double(grouped)


@case(
    "prj_15_to_number",
    """SELECT transaction_id, TRY_CAST(card_last4 AS DOUBLE) AS card_number,
              TRY_CAST(ip_address AS DOUBLE) AS address_number,
              TRY_CAST(amount AS DOUBLE) AS amount FROM transactions""",
)
def _(f: Fixture) -> DataFrame:
    return f.transactions.select(
        "transaction_id",
        display.to_number("card_last4").alias("card_number"),
        display.to_number("ip_address").alias("address_number"),
        display.to_number("amount").alias("amount"),
    )


RATE_SQL = """(
    SELECT CASE WHEN count(*) > 0
                THEN CAST(round(count(a.transaction_id) * 100.0 / count(*), 2) AS DOUBLE) END
    FROM (SELECT * FROM transactions WHERE {0}) AS recent
    LEFT JOIN fraud_alerts AS a ON a.transaction_id = recent.transaction_id)"""
HOUR = since("1 hour")
FIGURES_SQL = f"""
    (SELECT count(CASE WHEN {HOUR} THEN 1 END) AS tx_last_hour FROM transactions) AS t
    JOIN (SELECT count(CASE WHEN {HOUR} THEN 1 END) AS fraud_last_hour,
                 count(CASE WHEN NOT acknowledged THEN 1 END) AS unacked
          FROM fraud_alerts) AS a ON true
    JOIN (SELECT count(CASE WHEN {HOUR} THEN 1 END) AS dlq_last_hour
          FROM dlq_messages) AS d ON true"""
HOUR_RATE_SQL = RATE_SQL.format(HOUR)
OVERVIEW_SQL = f"SELECT *, {HOUR_RATE_SQL} AS fraud_rate_pct FROM {FIGURES_SQL}"
DAY_RATE_SQL = RATE_SQL.format(since("24 hours"))


@case(
    "prj_16_null_to_zero",
    """SELECT kafka_offset,
              coalesce(CASE WHEN user_id IS NOT NULL THEN kafka_offset END, 0) AS accepted
       FROM parsed""",
)
def _(f: Fixture) -> DataFrame:
    accepted = F.when(F.col("user_id").isNotNull(), F.col("kafka_offset"))
    return f.parsed.select("kafka_offset", display.or_zero(accepted).alias("accepted"))


@case(
    "prj_16_headline_cards",
    f"""SELECT *, printf('%.2f%%', coalesce({HOUR_RATE_SQL}, 0.0)) AS fraud_rate
        FROM {FIGURES_SQL}""",
)
def _(f: Fixture) -> DataFrame:
    return panels.headline_cards(reports.overview(f.tables, f.as_of))


@case(
    "prj_17_percent_text",
    "SELECT kafka_offset, printf('%.2f%%', CAST(amount AS DOUBLE)) AS pct FROM parsed",
)
def _(f: Fixture) -> DataFrame:
    return f.parsed.select("kafka_offset", display.percent_text("amount").alias("pct"))


@case(
    "prj_18_second_text",
    """SELECT kafka_offset,
              strftime(ingested_at, '%Y-%m-%d %H:%M:%S') AS ingested,
              CASE WHEN user_id IS NULL THEN '—'
                   ELSE strftime(ingested_at, '%Y-%m-%d %H:%M:%S') END AS accepted
       FROM parsed""",
)
def _(f: Fixture) -> DataFrame:
    accepted = F.when(F.col("user_id").isNotNull(), F.col("ingested_at"))
    return f.parsed.select(
        "kafka_offset",
        display.second_text("ingested_at").alias("ingested"),
        display.second_text(accepted).alias("accepted"),
    )


@case(
    "prj_19_dollars",
    "SELECT transaction_id, printf('$%.2f', CAST(amount AS DOUBLE)) AS amount FROM transactions",
)
def _(f: Fixture) -> DataFrame:
    return panels.with_amount_text(f.transactions).select("transaction_id", "amount")


# --- filters ---------------------------------------------------------------


@case("flt_01_valid", "SELECT kafka_offset, user_id FROM transactions")
def _(f: Fixture) -> DataFrame:
    return f.parsed.filter(routing.has_ids()).select("kafka_offset", "user_id")


@case("flt_02_invalid", "SELECT kafka_offset FROM dlq_messages")
def _(f: Fixture) -> DataFrame:
    return f.parsed.filter(routing.lacks_ids()).select("kafka_offset")


RULE_SQL = {
    "HIGH_AMOUNT": "amount > 9000",
    "HIGH_RISK_COUNTRY": "country IN ('NG', 'CN', 'RU', 'UA') AND amount > 500",
    "SUSPICIOUS_IP": "starts_with(ip_address, '185.')",
    "AMEX_LARGE": "card_type = 'amex' AND amount > 5000",
    "VELOCITY_FRAUD": "velocity_flag = true",
}


def rule_case(number: int, rule: rules.Rule) -> None:
    label = rule[0]

    @case(
        f"flt_{number:02d}_{label.lower()}",
        f"SELECT transaction_id FROM transactions WHERE {RULE_SQL[label]}",
    )
    def _(f: Fixture) -> DataFrame:
        return f.valid.filter(rules.predicate(rule)).select("transaction_id")


for _number, _rule in enumerate(rules.DEFAULT_RULES, start=3):
    rule_case(_number, _rule)

ANY_RULE_SQL = " OR ".join(f"({condition})" for condition in RULE_SQL.values())


@case("flt_08_any_rule", f"SELECT transaction_id FROM transactions WHERE {ANY_RULE_SQL}")
def _(f: Fixture) -> DataFrame:
    return f.valid.filter(rules.any_rule()).select("transaction_id")


@case("flt_09_no_rule", f"SELECT transaction_id FROM transactions WHERE NOT ({ANY_RULE_SQL})")
def _(f: Fixture) -> DataFrame:
    return f.valid.filter(rules.no_rule()).select("transaction_id")


def recent_case(slug: str, within: str) -> None:
    @case(
        f"flt_10_last_{slug}",
        f"SELECT transaction_id, ingested_at FROM transactions WHERE {since(within.lower())}",
    )
    def _(f: Fixture) -> DataFrame:
        rows = recent.recent(f.transactions, within, f.as_of)
        return rows.select("transaction_id", "ingested_at")


recent_case("hour", reports.RATE_PERIOD)
recent_case("24_hours", reports.ALERT_PERIOD)
recent_case("30_minutes", reports.MINUTE_PERIOD)


@case(
    "flt_11_unacknowledged",
    "SELECT id, transaction_id FROM fraud_alerts WHERE acknowledged = false",
)
def _(f: Fixture) -> DataFrame:
    return reports.unacknowledged(f.alerts).select("id", "transaction_id")


def status_case(status: str, condition: str) -> None:
    @case(
        f"flt_12_status_{status.lower()}",
        f"SELECT {quoted(ALERT_LOG)} FROM alert_log WHERE {condition}",
    )
    def _(f: Fixture) -> DataFrame:
        return panels.with_status(reports.alert_log(f.alerts), status)


status_case("All", "true")
status_case("Unacknowledged", "acknowledged = false")
status_case("Acknowledged", "acknowledged = true")


@case(
    "flt_13_membership",
    """SELECT count(*) AS total, count(CASE WHEN marked THEN 1 END) AS alerted
       FROM (SELECT transaction_id IN (SELECT transaction_id FROM fraud_alerts) AS marked
             FROM transactions) AS t""",
)
def _(f: Fixture) -> DataFrame:
    marked = matching.marked(f.transactions, f.alerts)
    return marked.agg(F.count(F.lit(1)).alias("total"), F.count_if("alerted").alias("alerted"))


# --- joins and subqueries --------------------------------------------------


@case(
    "jon_01_left_join_counts",
    """SELECT t.transaction_id, CAST(count(a.transaction_id) AS DOUBLE) AS matched,
              CAST(count(*) AS DOUBLE) AS joined
       FROM transactions AS t
       LEFT JOIN fraud_alerts AS a ON a.transaction_id = t.transaction_id
       GROUP BY t.transaction_id""",
)
def _(f: Fixture) -> DataFrame:
    joined = matching.joined_rows(f.transactions, f.alerts)
    sums = [F.sum(c).alias(c) for c in ("matched", "joined")]
    return joined.groupBy("transaction_id").agg(*sums)


@case(
    "jon_02_mark_join_counts",
    """SELECT transaction_id, count(*) AS "rows",
              transaction_id IN (SELECT transaction_id FROM fraud_alerts) AS alerted
       FROM transactions GROUP BY transaction_id""",
)
def _(f: Fixture) -> DataFrame:
    marked = matching.marked(f.transactions, f.alerts)
    return marked.groupBy("transaction_id", "alerted").agg(F.count(F.lit(1)).alias("rows"))


@case("sub_01_scalar_subqueries", OVERVIEW_SQL)
def _(f: Fixture) -> DataFrame:
    return reports.overview(f.tables, f.as_of)


# --- aggregations ----------------------------------------------------------


@case("agg_01_tx_last_hour", f"SELECT count(*) AS n FROM transactions WHERE {since('1 hour')}")
def _(f: Fixture) -> DataFrame:
    return reports.count_recent(f.transactions, f.as_of)


@case("agg_02_alerts_last_hour", f"SELECT count(*) AS n FROM fraud_alerts WHERE {since('1 hour')}")
def _(f: Fixture) -> DataFrame:
    return reports.count_recent(f.alerts, f.as_of)


@case("agg_03_unacknowledged", "SELECT count(*) AS n FROM fraud_alerts WHERE acknowledged = false")
def _(f: Fixture) -> DataFrame:
    return reports.row_count(reports.unacknowledged(f.alerts))


@case("agg_04_dlq_last_hour", f"SELECT count(*) AS n FROM dlq_messages WHERE {since('1 hour')}")
def _(f: Fixture) -> DataFrame:
    return reports.count_recent(f.rejects, f.as_of)


@case("agg_05_fraud_rate", f"SELECT {HOUR_RATE_SQL} AS fraud_rate_pct")
def _(f: Fixture) -> DataFrame:
    return reports.fraud_rate(f.transactions, f.alerts, f.as_of)


@case("agg_05_fraud_rate_24_hours", f"SELECT {DAY_RATE_SQL} AS fraud_rate_pct")
def _(f: Fixture) -> DataFrame:
    return reports.fraud_rate(f.transactions, f.alerts, f.as_of, reports.ALERT_PERIOD)


@case("agg_06_overview", OVERVIEW_SQL)
def _(f: Fixture) -> DataFrame:
    return reports.overview(f.tables, f.as_of)


BY_REASON_SQL = f"""SELECT fraud_reason, count(*) AS n FROM fraud_alerts
    WHERE {since("24 hours")} GROUP BY fraud_reason"""


@case("agg_07_alerts_by_reason", BY_REASON_SQL + " ORDER BY n DESC, fraud_reason")
def _(f: Fixture) -> DataFrame:
    return reports.alerts_by_reason(f.alerts, f.as_of)


@case(
    "agg_08_alerts_by_country",
    f"""SELECT country, count(*) AS n FROM fraud_alerts WHERE {since("24 hours")}
        GROUP BY country ORDER BY n DESC, country LIMIT 15""",
)
def _(f: Fixture) -> DataFrame:
    return reports.alerts_by_country(f.alerts, f.as_of)


ACTIVITY_SQL = f"""
    SELECT minute, count(*) AS total,
           count(CASE WHEN alerted THEN 1 END) AS fraud
    FROM (SELECT date_trunc('minute', ingested_at) AS minute,
                 transaction_id IN (SELECT transaction_id FROM fraud_alerts) AS alerted
          FROM transactions WHERE {since("30 minutes")}) AS marked
    GROUP BY minute ORDER BY minute"""


@case("agg_09_activity_per_minute", ACTIVITY_SQL)
def _(f: Fixture) -> DataFrame:
    return reports.activity_per_minute(f.transactions, f.alerts, f.as_of)


@case(
    "agg_10_top_users",
    f"""SELECT user_id, count(*) AS fraud_count,
               CAST(sum(amount) AS DECIMAL(24,2)) AS total_amount
        FROM fraud_alerts WHERE {since("24 hours")}
        GROUP BY user_id ORDER BY fraud_count DESC, user_id LIMIT 10""",
)
def _(f: Fixture) -> DataFrame:
    return reports.top_users(f.alerts, f.as_of)


@case(
    "agg_11_totals",
    """SELECT * FROM (SELECT count(*) AS transactions, max(ingested_at) AS last
                      FROM transactions) AS t
       JOIN (SELECT count(*) AS fraud_alerts FROM fraud_alerts) AS a ON true
       JOIN (SELECT count(*) AS dlq_messages FROM dlq_messages) AS d ON true""",
)
def _(f: Fixture) -> DataFrame:
    return reports.pipeline_totals(f.tables)


@case("agg_12_last_ingest", "SELECT max(ingested_at) AS last FROM transactions")
def _(f: Fixture) -> DataFrame:
    return recent.last_ingest(f.transactions)


@case(
    "agg_13_ingest_rate",
    f"""SELECT date_trunc('minute', ingested_at) AS minute, count(*) AS ticks
        FROM transactions WHERE {since("30 minutes")} GROUP BY 1 ORDER BY 1""",
)
def _(f: Fixture) -> DataFrame:
    return reports.ingest_rate(f.transactions, f.as_of)


VOLUME_SQL = """SELECT {0}, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS amount
    FROM recent_transactions WHERE {0} IS NOT NULL GROUP BY {0}"""


@case(
    "agg_14_volume_by_country",
    VOLUME_SQL.format("country") + " ORDER BY amount DESC, country LIMIT 10",
)
def _(f: Fixture) -> DataFrame:
    return panels.volume_by_country(reports.recent_transactions(f.transactions))


@case("agg_15_volume_by_merchant", VOLUME_SQL.format("merchant"))
def _(f: Fixture) -> DataFrame:
    return panels.volume_by_merchant(reports.recent_transactions(f.transactions))


@case(
    "agg_16_rows_per_batch",
    f"SELECT table_name, CAST(0 AS BIGINT) AS batch_id, n FROM ({ROWS_SQL}) AS counted",
)
def _(f: Fixture) -> DataFrame:
    """The sizes that each batch reports, as observed while it is read."""
    told: list[tuple[str, int, int]] = []

    def report(batch_id: int, sizes: Sizes) -> None:
        told.extend((name, batch_id, figures["rows"]) for name, figures in sizes.items())

    root = f.scratch("tables")
    start(
        f.raw_stream, parquet_sink(root), f.scratch("checkpoint"),
        stamp=F.col("timestamp"), available_now=True, report=report,
    ).awaitTermination()
    return f.spark.createDataFrame(told, "table_name string, batch_id bigint, n bigint")


@case(
    "agg_16_recorded_rows",
    f"SELECT table_name, CAST(0 AS BIGINT) AS batch_id, n, n AS total FROM ({ROWS_SQL}) AS counted",
)
def _(f: Fixture) -> DataFrame:
    """The sizes that the batches' records keep."""
    _, batches, _ = snapshot(f.spark, recorded(f))
    return batches.select(
        "table_name", "batch_id", F.col("rows").alias("n"), F.col("total_rows").alias("total")
    )


@case(
    "agg_17_reason_share",
    f"""SELECT fraud_reason, n,
               round(CAST(100 * n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE), 4) AS pct
        FROM ({BY_REASON_SQL}) AS grouped""",
)
def _(f: Fixture) -> DataFrame:
    return ranking.with_share(reports.alerts_by_reason(f.alerts, f.as_of), "n")


@case(
    "agg_17_merchant_share",
    f"""SELECT merchant, amount, round(100 * amount / sum(amount) OVER (), 4) AS pct
        FROM ({VOLUME_SQL.format("merchant")}) AS grouped""",
)
def _(f: Fixture) -> DataFrame:
    volumes = panels.volume_by_merchant(reports.recent_transactions(f.transactions))
    return ranking.with_share(volumes, "amount")


# --- sorts, limits, set invariants -----------------------------------------


@case(
    "top_01_sort_by_count",
    "SELECT merchant, count(*) AS n FROM fraud_alerts GROUP BY merchant ORDER BY n DESC",
)
def _(f: Fixture) -> DataFrame:
    return ranking.ranked(ranking.counts_by(f.alerts, "merchant"), "n", "merchant")


@case(
    "top_02_top_groups",
    """SELECT user_id, count(*) AS n FROM fraud_alerts GROUP BY user_id
       ORDER BY n DESC, user_id LIMIT 10""",
)
def _(f: Fixture) -> DataFrame:
    return ranking.ranked(ranking.counts_by(f.alerts, "user_id"), "n", "user_id", 10)


def latest_case(source: str, n: int) -> None:
    @case(
        f"top_03_latest_{n}",
        f"""SELECT transaction_id, ingested_at FROM {source}
            ORDER BY ingested_at DESC NULLS FIRST, transaction_id LIMIT {n}""",
    )
    def _(f: Fixture) -> DataFrame:
        rows = recent.latest(getattr(f.tables, source), n, "transaction_id")
        return rows.select("transaction_id", "ingested_at")


latest_case("fraud_alerts", reports.ALERT_LOG_ROWS)
latest_case("transactions", reports.RECENT_ROWS)
latest_case("transactions", reports.PREVIEW_ROWS)


@case(
    "top_04_sort_by_minute",
    """SELECT date_trunc('minute', ingested_at) AS minute, count(*) AS n
       FROM transactions GROUP BY 1 ORDER BY 1""",
)
def _(f: Fixture) -> DataFrame:
    per_minute = f.transactions.groupBy(reports.ingest_minute().alias("minute"))
    return per_minute.agg(F.count(F.lit(1)).alias("n")).orderBy("minute")


@case(
    "top_05_top_sums",
    """SELECT merchant, CAST(sum(amount) AS DOUBLE) AS amount FROM transactions
       WHERE merchant IS NOT NULL GROUP BY merchant ORDER BY 2 DESC, 1 LIMIT 10""",
)
def _(f: Fixture) -> DataFrame:
    volumes = ranking.volume_by(f.transactions, "merchant")
    return ranking.ranked(volumes, "amount", "merchant", panels.TOP_VOLUMES)


@case(
    "set_01_split_is_complete",
    """SELECT count(*) AS messages,
              count(*) FILTER (WHERE user_id IS NOT NULL) AS valid,
              count(*) FILTER (WHERE user_id IS NULL) AS invalid,
              CAST(0 AS BIGINT) AS "both", CAST(0 AS BIGINT) AS neither
       FROM parsed""",
)
def _(f: Fixture) -> DataFrame:
    valid, invalid = routing.has_ids(), routing.lacks_ids()
    return f.parsed.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(valid).alias("valid"),
        F.count_if(invalid).alias("invalid"),
        F.count_if(valid & invalid).alias("both"),
        F.count_if(~(valid | invalid)).alias("neither"),
    )


# --- streaming -------------------------------------------------------------


@case("str_01_triggered_stream", ROWS_SQL)
def _(f: Fixture) -> DataFrame:
    """The processing-time trigger; all that is there goes into the tables."""
    root = f.scratch("tables")
    create_tables(f.spark, root)
    running = start(
        f.raw_stream, parquet_sink(root), f.scratch("checkpoint"), stamp=F.col("timestamp")
    )
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return rows_per_table(f, root)


@case("str_02_checkpoint_resume", ROWS_SQL)
def _(f: Fixture) -> DataFrame:
    """A second start from the same checkpoint adds nothing."""
    root, checkpoint = f.scratch("tables"), f.scratch("checkpoint")
    for _attempt in range(2):
        start(
            f.raw_stream, parquet_sink(root), checkpoint,
            stamp=F.col("timestamp"), available_now=True,
        ).awaitTermination()
    return rows_per_table(f, root)


@case(
    "str_03_fan_out",
    """SELECT t.kafka_partition, t.kafka_offset, t.transaction_id, fraud_reason,
              CAST(NULL AS VARCHAR) AS error_type FROM scored t
       UNION ALL
       SELECT kafka_partition, kafka_offset, NULL, NULL, error_type FROM dlq_messages""",
)
def _(f: Fixture) -> DataFrame:
    """The three streamed tables put together again, message by message."""
    root = streamed(f)
    facts, alerts, rejects = (read_table(f.spark, root, t) for t in TABLES.values())
    scored = facts.select(*POSITION, "transaction_id").join(
        alerts.select(*POSITION, "fraud_reason"), POSITION, "left"
    )
    return scored.unionByName(rejects.select(*POSITION, "error_type"), allowMissingColumns=True)


def replay_case(name: str, sql: str) -> None:
    @case(f"str_05_replay_{name}", sql)
    def _(f: Fixture) -> DataFrame:
        """The first try writes one table and fails; the restart completes it."""
        root, checkpoint = f.scratch("tables"), f.scratch("checkpoint")
        write = parquet_sink(root)

        def failing(rows: DataFrame, table: Table, batch_id: int, tasks: int) -> None:
            if table is not TRANSACTIONS:
                raise RuntimeError("sink is down")
            write(rows, table, batch_id, tasks)

        for sink in (failing, write):
            stream = start(
                f.raw_stream, sink, checkpoint, stamp=F.col("timestamp"), available_now=True
            )
            try:
                stream.awaitTermination()
            except Exception:
                if sink is write:
                    raise
        table = TABLES[name]
        return read_table(f.spark, root, table).select(*table.sent)


replay_case("transactions", FACTS_SQL)
replay_case("fraud_alerts", ALERTS_SQL)
replay_case("dlq_messages", REJECTS_SQL)


@case(
    "str_06_reports_on_streamed_tables",
    OVERVIEW_SQL.replace("fraud_alerts", "streamed_alerts"),
)
def _(f: Fixture) -> DataFrame:
    """The overview on stored tables, where the periods prune directories."""
    tables = read_tables(f.spark, streamed(f))
    return reports.overview(tables, recent.last_ingest(tables.transactions).scalar())


@case(
    "str_07_latest_on_streamed_tables",
    f"""SELECT {quoted(RECENT)} FROM recent_transactions""",
)
def _(f: Fixture) -> DataFrame:
    """Latest rows of a stored table, where the newest days are enough."""
    root = streamed(f, "transactions")
    return reports.recent_transactions(read_table(f.spark, root, TRANSACTIONS))


@case(
    "str_08_half_a_batch_is_not_seen",
    """SELECT table_name, CAST(0 AS BIGINT) AS batch_id, count(*) AS n FROM (
           SELECT 'transactions' AS table_name, kafka_offset FROM transactions
           UNION ALL SELECT 'fraud_alerts', kafka_offset FROM flagged
           UNION ALL SELECT 'dlq_messages', kafka_offset FROM dlq_messages) AS r
       WHERE kafka_offset % 2 = 0 GROUP BY table_name""",
)
def _(f: Fixture) -> DataFrame:
    """Messages with an odd offset come second, and their batch fails after its
    facts are written: the snapshot holds the first batch."""
    root = f.scratch("tables")
    create_tables(f.spark, root)
    ledger = Ledger(f.spark, root)
    ledger.create()
    halves = [f.raw.filter(F.col("offset") % 2 == odd) for odd in (0, 1)]
    write = parquet_sink(root)

    def failing(rows: DataFrame, table: Table, batch_id: int, tasks: int) -> None:
        if batch_id == 1 and table is not TRANSACTIONS:
            raise RuntimeError("sink is down")
        write(rows, table, batch_id, tasks)

    stream = start(
        in_two_batches(f, *halves), failing, f.scratch("checkpoint"),
        stamp=F.col("timestamp"), available_now=True, ledger=ledger,
    )
    try:
        stream.awaitTermination()
    except Exception as error:
        if "sink is down" not in str(error):
            raise
    tables, _, _ = snapshot(f.spark, root)
    counts = [
        df.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n")).withColumn("table_name", F.lit(t))
        for t, df in tables._asdict().items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# --- reports from the records of the stream ---------------------------------


def rollup_case(key: str, sql: str) -> Callable[[Build], Build]:
    """A report on the records of a stored stream, whose alerts have no copies."""
    return case(key, sql.replace("FROM fraud_alerts", "FROM flagged"))


def last_moment(tables: Tables) -> Column:
    return recent.last_ingest(tables.transactions).scalar()


@rollup_case(
    "agg_01_counts_from_minutes",
    f"""SELECT
        (SELECT count(*) FROM transactions WHERE {since("1 hour")}) AS tx_last_hour,
        (SELECT count(*) FROM fraud_alerts WHERE {since("1 hour")}) AS fraud_last_hour,
        (SELECT count(*) FROM dlq_messages WHERE {since("1 hour")}) AS dlq_last_hour""",
)
def _(f: Fixture) -> DataFrame:
    tables, _, minutes = snapshot(f.spark, recorded(f))
    return rollups.recent_counts(minutes, tables, last_moment(tables))


@rollup_case("agg_07_reasons_from_minutes", BY_REASON_SQL)
def _(f: Fixture) -> DataFrame:
    tables, _, minutes = snapshot(f.spark, recorded(f))
    return rollups.alerts_by_reason(minutes, tables.fraud_alerts, last_moment(tables))


@rollup_case(
    "agg_08_countries_from_minutes",
    f"""SELECT country, count(*) AS n FROM fraud_alerts WHERE {since("24 hours")}
        GROUP BY country ORDER BY n DESC, country LIMIT 15""",
)
def _(f: Fixture) -> DataFrame:
    tables, _, minutes = snapshot(f.spark, recorded(f))
    return rollups.alerts_by_country(minutes, tables.fraud_alerts, last_moment(tables))


@rollup_case(
    "agg_11_totals_from_records",
    """SELECT * FROM (SELECT count(*) AS transactions, max(ingested_at) AS last
                      FROM transactions) AS t
       JOIN (SELECT count(*) AS fraud_alerts FROM flagged) AS a ON true
       JOIN (SELECT count(*) AS dlq_messages FROM dlq_messages) AS d ON true""",
)
def _(f: Fixture) -> DataFrame:
    _, batches, _ = snapshot(f.spark, recorded(f))
    return rollups.pipeline_totals(batches)


@rollup_case(
    "agg_13_rate_from_minutes",
    f"""SELECT date_trunc('minute', ingested_at) AS minute, count(*) AS ticks
        FROM transactions WHERE {since("30 minutes")} GROUP BY 1 ORDER BY 1""",
)
def _(f: Fixture) -> DataFrame:
    tables, _, minutes = snapshot(f.spark, recorded(f))
    return rollups.ingest_rate(minutes, tables.transactions, last_moment(tables))


def by_id_case(key: str, sql: str, report: Callable[..., DataFrame]) -> None:
    @rollup_case(key, sql)
    def _(f: Fixture) -> DataFrame:
        """All days but the newest are counted per id in buckets."""
        tables = read_tables(f.spark, streamed(f))
        moment = recent.last_ingest(tables.transactions)
        day = moment.select(F.to_date("last")).first()[0]
        path = f.scratch("alerts-by-id")
        by_id.store_counts(tables.fraud_alerts, path, date(1970, 1, 1), day, buckets=8)
        counts = by_id.counts_table(f.spark, path, buckets=8)
        counted = by_id.stored_counts(counts, day)
        return report(
            tables.transactions, tables.fraud_alerts, moment.scalar(), counted=counted
        )


by_id_case("agg_09_activity_by_stored_counts", ACTIVITY_SQL, reports.activity_per_minute)
by_id_case(
    "agg_05_fraud_rate_by_stored_counts",
    f"SELECT {DAY_RATE_SQL} AS fraud_rate_pct",
    partial(reports.fraud_rate, within=reports.ALERT_PERIOD),
)


@case("top_03_latest_from_records", f"SELECT {quoted(RECENT)} FROM recent_transactions")
def _(f: Fixture) -> DataFrame:
    tables, batches, _ = snapshot(f.spark, recorded(f))
    newest = rollups.latest(
        tables.transactions, batches, TRANSACTIONS.name, reports.RECENT_ROWS, "transaction_id"
    )
    return newest.select(*RECENT)


# --- live reports ----------------------------------------------------------


def parsed_stream(f: Fixture, raw: DataFrame | None = None) -> DataFrame:
    """The message stream parsed, with the messages' own time as ingest time."""
    return parse.transactions(f.raw_stream if raw is None else raw, F.col("timestamp"))


def live_minutes(f: Fixture, figures: DataFrame, mode: str = "update") -> DataFrame:
    path = f.scratch("minutes")
    start_minutes(
        figures, path, f.scratch("checkpoint"), mode=mode, available_now=True
    ).awaitTermination()
    return read_minutes(f.spark, path, figures.schema)


@case(
    "ext_01_live_ingest_rate",
    f"""SELECT date_trunc('minute', ingested_at) AS minute, count(*) AS ticks
        FROM transactions WHERE {since("30 minutes")} GROUP BY 1""",
)
def _(f: Fixture) -> DataFrame:
    """AGG-13 as a stream. The period is that of the fixture's moment; on the
    clock, every row that arrives is within it."""
    facts = routing.facts(parsed_stream(f))
    return live_minutes(f, windowed_rate(reports.recent(facts, reports.MINUTE_PERIOD, f.moment)))


@case(
    "ext_01_live_minutes",
    """SELECT date_trunc('minute', ingested_at) AS minute, count(*) AS ticks
       FROM transactions GROUP BY 1""",
)
def _(f: Fixture) -> DataFrame:
    return live_minutes(f, windowed_rate(routing.facts(parsed_stream(f))))


def delivered_twice(f: Fixture) -> DataFrame:
    """A stream that delivers every message in two batches."""
    return in_two_batches(f, f.raw, f.raw)


# Longer than the test tables' period.
ALL_TIME = "1000 days"


@case(
    "ext_02_duplicate_guard",
    "SELECT kafka_partition, kafka_offset, transaction_id, user_id FROM parsed",
)
def _(f: Fixture) -> DataFrame:
    target = f.scratch("messages")
    columns = [*POSITION, "transaction_id", "user_id"]
    rows = once(parsed_stream(f, delivered_twice(f)), ALL_TIME).select(*columns)
    (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", f.scratch("checkpoint"))
        .trigger(availableNow=True)
        .start(target)
        .awaitTermination()
    )
    return f.spark.read.schema(rows.schema).parquet(target)


@case("ext_02_guarded_tables", ROWS_SQL)
def _(f: Fixture) -> DataFrame:
    """The whole job, with the guard, on the stream that repeats itself."""
    root = f.scratch("tables")
    start(
        delivered_twice(f), parquet_sink(root), f.scratch("checkpoint"),
        stamp=F.col("timestamp"), available_now=True, guard=ALL_TIME,
    ).awaitTermination()
    return rows_per_table(f, root)


@case("ext_03_live_activity", ACTIVITY_SQL)
def _(f: Fixture) -> DataFrame:
    """AGG-9 from a stream of facts and one of alerts, some of them repeated.
    One more row a day later in each closes the last minutes."""
    columns = ["transaction_id", "ingested_at"]
    later = F.col("ingested_at") + F.expr("INTERVAL 1 DAY")
    streams = []
    for rows in (f.transactions, f.alerts):
        rows, path = rows.select(*columns), f.scratch("rows")
        rows.coalesce(1).write.parquet(path)
        last = rows.orderBy(F.desc("ingested_at")).limit(1).withColumn("ingested_at", later)
        last.write.mode("append").parquet(path)
        streams.append(file_stream(f.spark, path, rows.schema, maxFilesPerTrigger="1"))
    facts, alerts = streams
    facts = reports.recent(facts, reports.MINUTE_PERIOD, f.moment)
    return live_minutes(f, live_activity(facts, alerts), "append")


# --- flagship --------------------------------------------------------------


@case(
    "flagship_alerts_by_reason",
    """SELECT fraud_reason, count(*) AS n FROM fraud_alerts GROUP BY fraud_reason
       ORDER BY n DESC, fraud_reason""",
)
def flagship(f: Fixture) -> DataFrame:
    """Validate and score all messages, count the alerts per reason."""
    return ranking.ranked(ranking.counts_by(f.alerts, "fraud_reason"), "n", "fraud_reason")
