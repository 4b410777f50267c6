"""Batches become visible as a whole, and reports from their records."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from txrisk.checks.fixtures import Fixture
from txrisk.functions import parse
from txrisk.operators import recent, routing
from txrisk.plans import reports, rollups
from txrisk.schemas import BATCHES, FRAUD_ALERTS, MINUTES, TABLES, TRANSACTIONS, Tables
from txrisk.sources.messages import file_stream
from txrisk.sources.tables import create_tables, read_table, read_tables
from txrisk.streaming.job import batch_writer, start
from txrisk.streaming.ledger import Ledger, last_batch, snapshot
from txrisk.streaming.sinks import parquet_sink

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def root(spark, tmp_path):
    path = str(tmp_path / "tables")
    create_tables(spark, path)
    Ledger(spark, path).create()
    return path


def parsed(spark):
    return parse.transactions(Fixture(spark, SF_DIR).raw, F.col("timestamp"))


def part(spark, k, of=4):
    """The messages of one of several periods, one after the other."""
    rows = parsed(spark).withColumn(
        "nth", F.expr(f"ntile({of}) OVER (ORDER BY ingested_at, kafka_offset)")
    )
    return rows.filter(F.col("nth") == k + 1).drop("nth")


def fill(spark, root, parts=4):
    write = batch_writer(parquet_sink(root), ledger=Ledger(spark, root))
    for k in range(parts):
        write(part(spark, k, parts), k)


def sizes(tables):
    return [df.count() for df in tables]


def test_records_say_what_the_batches_hold(spark, root):
    fill(spark, root)
    records = read_table(spark, root, BATCHES).orderBy("batch_id").collect()
    assert len(records) == 4 * len(TABLES)
    for name, table in TABLES.items():
        stored = read_table(spark, root, table)
        total = 0
        for r in (r for r in records if r.table_name == name):
            rows = stored.filter(F.col("batch_id") == r.batch_id)
            times = rows.agg(F.min("ingested_at"), F.max("ingested_at")).first()
            total += rows.count()
            assert (r.rows, r.total_rows, r.untimed) == (rows.count(), total, 0)
            assert (r.first_ingest, r.last_ingest) == tuple(times)


def test_minutes_add_up_to_the_tables(spark, root):
    fill(spark, root)
    minutes = read_table(spark, root, MINUTES)
    for name, table in TABLES.items():
        keys = [reports.ingest_minute().alias("minute")]
        keys += ["fraud_reason", "country"] if table is FRAUD_ALERTS else []
        want = read_table(spark, root, table).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        got = minutes.filter(F.col("table_name") == name).groupBy(*want.columns[:-1])
        got = got.agg(F.sum("n").alias("n"))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize(
    "fail_in, after_write", [("transactions", True), ("fraud_alerts", False)]
)
def test_a_failure_between_tables_is_not_seen(spark, root, fail_in, after_write):
    fill(spark, root, 2)
    before = sizes(snapshot(spark, root)[0])
    write = parquet_sink(root)

    def failing(rows, table, batch_id, tasks):
        if table.name == fail_in and not after_write:
            raise RuntimeError("sink is down")
        write(rows, table, batch_id, tasks)
        if table.name == fail_in:
            raise RuntimeError("connection lost")

    extra = parsed(spark).withColumn("kafka_offset", F.col("kafka_offset") + 1_000_000)
    with pytest.raises(RuntimeError):
        batch_writer(failing, ledger=Ledger(spark, root))(extra, 2)
    tables, batches, minutes = snapshot(spark, root)
    assert sizes(tables) == before
    assert last_batch(read_table(spark, root, BATCHES)) == 1
    totals = minutes.groupBy("table_name").agg(F.sum("n").alias("n")).collect()
    assert [dict(totals)[name] for name in TABLES] == before
    # The batch is tried again and seen as a whole, once.
    for _again in range(2):
        batch_writer(write, ledger=Ledger(spark, root))(extra, 2)
    assert sizes(snapshot(spark, root)[0]) == [2 * n for n in before]
    assert sizes(tables) == before, "an older snapshot stays as it was"
    assert rollups.pipeline_totals(snapshot(spark, root)[1]).first()[:3] == tuple(
        2 * n for n in before
    )


def test_a_restarted_stream_goes_on_counting(spark, root, tmp_path):
    source = str(tmp_path / "source")
    raw = Fixture(spark, SF_DIR).raw
    write = parquet_sink(root)

    def failing(rows, table, batch_id, tasks):
        write(rows, table, batch_id, tasks)
        if batch_id == 1 and table is TRANSACTIONS:
            raise RuntimeError("lost")

    def go(sink):
        start(
            file_stream(spark, source), sink, str(tmp_path / "cp"),
            stamp=F.col("timestamp"), available_now=True, ledger=Ledger(spark, root),
        ).awaitTermination()

    for half, sink in ((0, failing), (1, failing), (None, write)):
        if half is not None:
            raw.filter(F.col("offset") % 2 == half).coalesce(1).write.mode("append").parquet(source)
        if half == 1:
            with pytest.raises(StreamingQueryException):
                go(sink)
            assert last_batch(read_table(spark, root, BATCHES)) == 0
        else:
            go(sink)
    totals = rollups.pipeline_totals(snapshot(spark, root)[1]).first()
    assert list(totals)[:3] == sizes(read_tables(spark, root)) == [969, 298, 31]


def test_an_empty_batch_leaves_no_record(spark, root):
    write = batch_writer(parquet_sink(root), ledger=Ledger(spark, root))
    write(parsed(spark).filter("kafka_offset < 0"), 0)
    assert last_batch(read_table(spark, root, BATCHES)) == -1
    tables, batches, minutes = snapshot(spark, root)
    assert sizes(tables) == [0, 0, 0]
    assert rollups.pipeline_totals(batches).first() == (0, 0, 0, None)
    write(parsed(spark), 1)
    assert last_batch(read_table(spark, root, BATCHES)) == 1


@pytest.mark.parametrize("earlier", ["7 SECONDS", "3 DAYS"])
def test_reports_from_minutes_equal_reports_from_rows(spark, root, earlier):
    fill(spark, root)
    tables, batches, minutes = snapshot(spark, root)
    newest = tables.transactions.agg(F.max("ingested_at").cast("string")).first()[0]
    as_of = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {earlier}")
    pairs = [
        (rollups.alerts_by_reason(minutes, tables.fraud_alerts, as_of),
         reports.alerts_by_reason(tables.fraud_alerts, as_of)),
        (rollups.alerts_by_country(minutes, tables.fraud_alerts, as_of),
         reports.alerts_by_country(tables.fraud_alerts, as_of)),
        (rollups.ingest_rate(minutes, tables.transactions, as_of),
         reports.ingest_rate(tables.transactions, as_of)),
        (rollups.pipeline_totals(batches), reports.pipeline_totals(tables)),
        (rollups.recent_counts(minutes, tables, as_of), reports.overview(tables, as_of)
         .select("tx_last_hour", "fraud_last_hour", "dlq_last_hour")),
    ]
    for got, want in pairs:
        assert got.columns == want.columns
        assert got.collect() == want.collect()


def test_periods_on_whole_minutes(spark, root):
    fill(spark, root)
    tables, _, minutes = snapshot(spark, root)
    as_of = F.date_trunc("minute", tables.transactions.agg(F.max("ingested_at")).scalar())
    got = rollups.ingest_rate(minutes, tables.transactions, as_of)
    assert got.collect() == reports.ingest_rate(tables.transactions, as_of).collect()


def spoil(root, table, batches):
    """Make the files of some batches unreadable."""
    for folder, _, names in os.walk(f"{root}/{table.name}"):
        if any(folder.endswith(f"batch_id={b}") for b in batches):
            for name in names:
                if name.endswith(".parquet"):
                    with open(f"{folder}/{name}", "wb") as file:
                        file.write(b"spoiled")
                elif name.endswith(".crc"):
                    os.remove(f"{folder}/{name}")


@pytest.mark.parametrize("n", [1, 200])
def test_latest_reads_the_newest_batches_only(spark, root, n):
    fill(spark, root, 8)
    tables, batches, _ = snapshot(spark, root)
    want = recent.latest(tables.transactions, n, "transaction_id").collect()
    needed = -(-n // 115)
    spoil(root, TRANSACTIONS, range(8 - needed - 1))
    got = rollups.latest(tables.transactions, batches, "transactions", n, "transaction_id")
    assert got.collect() == want and len(want) == n


def test_latest_when_batches_overlap_and_times_are_missing(spark, root):
    """Batches whose periods overlap, rows without a time, fewer rows than asked."""
    write = batch_writer(parquet_sink(root), ledger=Ledger(spark, root))
    rows = parsed(spark).withColumn(
        "ingested_at", F.when(F.col("kafka_offset") % 97 > 0, F.col("ingested_at"))
    )
    for k in range(3):
        write(rows.filter(F.col("kafka_offset") % 3 == k), k)
    tables, batches, minutes = snapshot(spark, root)
    for n in (5, 5000):
        got = rollups.latest(tables.transactions, batches, "transactions", n, "transaction_id")
        want = recent.latest(tables.transactions, n, "transaction_id")
        assert got.collect() == want.collect()
    assert rollups.pipeline_totals(batches).first()[:3] == (969, 298, 31)


def test_a_row_against_the_contract_reaches_no_sink(spark):
    """Whatever the sink does with its rows."""
    rows = parsed(spark).limit(20).withColumn("kafka_offset", F.lit(None).cast("bigint"))
    written = []

    def sink(rows, table, batch_id, tasks):
        written.append(rows.collect())

    broken = routing.checked(rows.withColumn("user_id", F.lit(None).cast("string")), TRANSACTIONS)
    with pytest.raises(Exception, match="transactions.user_id must not be NULL"):
        broken.collect()
    batch_writer(sink, ["transactions"])(rows, 0)
    assert len(written) == 1 and routing.checked(parsed(spark), TRANSACTIONS).count() > 0


def test_observed_sizes_are_reported(spark):
    told = []
    batch_writer(lambda *_: None, report=lambda b, s: told.append((b, s)))(parsed(spark), 7)
    [(batch_id, got)] = told
    assert batch_id == 7
    assert {n: f["rows"] for n, f in got.items()} == routing.sizes(parsed(spark))
    assert Tables(*got.values()).dlq_messages["untimed"] == 0


def test_many_minutes_are_written_by_several_tasks(spark, root):
    """60,000 different minutes are more than one task should write."""
    minutes = F.timestamp_seconds(F.col("kafka_offset") * 60)
    rows = parsed(spark).limit(1).drop("kafka_offset").crossJoin(
        spark.range(60_000).toDF("kafka_offset")
    )
    rows = rows.withColumns({"ingested_at": minutes, "user_id": F.lit("user_1")})
    rows = rows.withColumn("amount", F.lit(10_000.0))
    told = Ledger(spark, root).count(rows, 0, [("LARGE", "amount > 9000")])
    assert {name: figures["rows"] for name, figures in told.items()} == {
        "transactions": 60_000, "fraud_alerts": 60_000
    }
    stored = read_table(spark, root, MINUTES)
    assert stored.agg(F.sum("n"), F.count("n")).first() == (120_000, 120_000)
    a_day = stored.filter("ingest_date = DATE'1970-01-02'")
    assert len(a_day.inputFiles()) > 1
