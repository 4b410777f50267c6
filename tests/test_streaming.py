"""The streaming job on files: same tables as in batch, restarts included."""

import logging
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from txrisk.checks.fixtures import Fixture
from txrisk.functions import parse
from txrisk.operators import routing
from txrisk.schemas import FRAUD_ALERTS, LAYOUT, TABLES, TRANSACTIONS
from txrisk.sources.messages import file_stream
from txrisk.sources.tables import (
    compact,
    create_tables,
    read_table,
    read_tables,
    register,
    run_query,
)
from txrisk.streaming.job import batch_writer, run, start, write_tasks
from txrisk.streaming.sinks import parquet_sink

SF_DIR = "/root/testdata/sf0.001"
FILES = 4


def stamp():
    """A fixed ingest time on one of three days, by offset."""
    day = F.col("kafka_offset") % 3
    return F.timestamp_seconds(F.lit(1_700_000_000) + day * 86_400 + F.col("kafka_offset"))


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("source") / "messages")
    Fixture(spark, SF_DIR).raw.repartition(FILES).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def expected(spark):
    parsed = parse.transactions(Fixture(spark, SF_DIR).raw, stamp())
    return {
        name: routing.stored_rows(rows, TABLES[name], 0).drop(*LAYOUT).cache()
        for name, rows in routing.split(parsed).items()
    }


def messages(spark, source, per_batch="2"):
    return file_stream(spark, source, maxFilesPerTrigger=per_batch)


def check(spark, root, expected):
    for name, rows in expected.items():
        stored = read_table(spark, root, TABLES[name]).drop(*LAYOUT)
        assert stored.count() == rows.count() > 0
        assert stored.exceptAll(rows).isEmpty()


def files(root, table):
    return [f for _, _, fs in os.walk(f"{root}/{table.name}") for f in fs if f.endswith(".parquet")]


def test_stream_equals_batch(spark, source, expected, tmp_path):
    root = str(tmp_path / "tables")
    start(
        messages(spark, source), parquet_sink(root), str(tmp_path / "cp"),
        stamp=stamp(), available_now=True,
    ).awaitTermination()
    check(spark, root, expected)
    batches = read_table(spark, root, TRANSACTIONS).select("batch_id").distinct()
    assert sorted(r[0] for r in batches.collect()) == [0, 1]


@pytest.mark.parametrize(
    "fail_in, after_write",
    [
        ("transactions", True),
        ("fraud_alerts", False),
        ("fraud_alerts", True),
        ("dlq_messages", True),
    ],
)
def test_restart_after_a_failed_batch(spark, source, expected, tmp_path, fail_in, after_write):
    root, checkpoint = str(tmp_path / "tables"), str(tmp_path / "cp")
    write = parquet_sink(root)

    def failing(rows, table, batch_id, tasks):
        broken = batch_id == 1 and table.name == fail_in
        if broken and not after_write:
            raise RuntimeError("sink is down")
        write(rows, table, batch_id, tasks)
        if broken:
            raise RuntimeError("connection lost")

    def go(sink):
        start(
            messages(spark, source), sink, checkpoint, stamp=stamp(), available_now=True
        ).awaitTermination()

    with pytest.raises(StreamingQueryException):
        go(failing)
    go(write)
    check(spark, root, expected)


def test_all_tables_of_a_batch_share_one_ingest_time(spark, source, tmp_path):
    root = str(tmp_path / "tables")
    create_tables(spark, root)
    start(
        messages(spark, source), parquet_sink(root), str(tmp_path / "cp"), available_now=True
    ).awaitTermination()
    tables = read_tables(spark, root)
    times = {
        name: {tuple(r) for r in df.select("batch_id", "ingested_at").distinct().collect()}
        for name, df in tables._asdict().items()
    }
    assert times["transactions"] == times["fraud_alerts"] == times["dlq_messages"]
    assert len(times["transactions"]) == 2


@pytest.mark.parametrize("rows_per_task, n", [(50_000, 1), (200, 2), (10, 4)])
def test_files_per_batch(spark, source, tmp_path, rows_per_task, n):
    """298 alerts in four tasks give as many files as their number asks for, and
    no more than there are tasks."""
    root = str(tmp_path / "tables")
    with_cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        start(
            messages(spark, source, "4"), parquet_sink(root), str(tmp_path / "cp"),
            rows_per_task=rows_per_task, available_now=True,
        ).awaitTermination()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", with_cost)
    assert len(files(root, FRAUD_ALERTS)) == n


def test_write_tasks():
    assert write_tasks(21_000, 21_500) == 1
    assert write_tasks(2_000_000, 2_000_000) == 40
    assert write_tasks(50_001, 60_000) == 2
    # three rejects among half a billion messages
    assert write_tasks(3, 500_000_000) == 250


def test_writing_does_not_shuffle(spark, plan_of):
    parsed = parse.transactions(Fixture(spark, SF_DIR).raw).persist()

    def sink(rows, table, batch_id, tasks):
        plans.append(plan_of(routing.stored_rows(rows, table, batch_id).coalesce(1)))

    plans = []
    batch_writer(sink)(parsed, 0)
    assert len(plans) == 3
    assert not any("Exchange" in plan for plan in plans)


def test_rows_are_logged_per_batch(spark, source, tmp_path, caplog):
    caplog.set_level(logging.INFO, "txrisk.streaming.job")
    start(
        messages(spark, source, "4"), parquet_sink(str(tmp_path / "t")), str(tmp_path / "cp"),
        stamp=stamp(), available_now=True,
    ).awaitTermination()
    assert "batch 0: 969 rows to transactions" in caplog.text
    assert "batch 0: 31 rows to dlq_messages" in caplog.text


def test_run_raises_when_the_query_fails(spark, source, tmp_path):
    def failing(rows, table, batch_id, tasks):
        raise RuntimeError("sink is down")

    spark.streams.resetTerminated()
    query = start(messages(spark, source), failing, str(tmp_path / "cp"))
    with pytest.raises(StreamingQueryException):
        run(spark, query)
    assert not query.isActive
    spark.streams.resetTerminated()


def test_run_returns_and_stops_when_another_query_ends(spark, source, tmp_path):
    spark.streams.resetTerminated()
    query = start(messages(spark, source), parquet_sink(str(tmp_path / "t")), str(tmp_path / "cp"))
    other = messages(spark, source).writeStream.format("noop")
    other = other.option("checkpointLocation", str(tmp_path / "other")).start()
    other.processAllAvailable()
    other.stop()
    run(spark, query)
    assert not query.isActive
    spark.streams.resetTerminated()


def test_create_keeps_what_is_there(spark, source, expected, tmp_path):
    root = str(tmp_path / "tables")
    create_tables(spark, root)
    assert all(df.isEmpty() for df in read_tables(spark, root))
    for name, rows in expected.items():
        parsed_rows = rows.withColumn("ingest_date", F.to_date("ingested_at"))
        parsed_rows.withColumn("batch_id", F.lit(0)).write.mode("append").partitionBy(
            *LAYOUT
        ).parquet(f"{root}/{name}")
    create_tables(spark, root)
    check(spark, root, expected)


def test_compacted_days(spark, source, expected, tmp_path):
    root, archive = str(tmp_path / "tables"), str(tmp_path / "archive")
    start(
        messages(spark, source), parquet_sink(root), str(tmp_path / "cp"),
        stamp=stamp(), available_now=True,
    ).awaitTermination()
    days = [r[0] for r in read_table(spark, root, TRANSACTIONS).select("ingest_date").distinct()
            .orderBy("ingest_date").collect()]
    closed_before = days[2]
    for _repeated in range(2):
        compact(spark, root, archive, days[0], closed_before)
    assert len(files(archive, TRANSACTIONS)) == 2
    for name, rows in expected.items():
        whole = read_table(spark, root, TABLES[name], archive, closed_before).drop(*LAYOUT)
        assert whole.count() == rows.count()
        assert whole.exceptAll(rows).isEmpty()


def test_sql_on_registered_tables(spark, source, expected, tmp_path):
    root = str(tmp_path / "tables")
    start(
        messages(spark, source), parquet_sink(root), str(tmp_path / "cp"),
        stamp=stamp(), available_now=True,
    ).awaitTermination()
    register(read_tables(spark, root))
    got = run_query(
        spark, "SELECT count(*) AS n FROM fraud_alerts WHERE amount > :least", {"least": 9000}
    )
    assert got.first().n == expected["fraud_alerts"].filter("amount > 9000").count()
    with pytest.raises(Exception, match="no_such_column"):
        run_query(spark, "SELECT no_such_column FROM fraud_alerts")


NOTHING = {
    "transactions": "user_id IS NULL",
    "fraud_alerts": "amount < 1 AND NOT velocity_flag",
    "dlq_messages": "user_id IS NOT NULL",
}


@pytest.mark.parametrize("name", TABLES)
def test_batch_without_rows_for_a_table(spark, tmp_path, name):
    parsed = parse.transactions(Fixture(spark, SF_DIR).raw, stamp()).filter(NOTHING[name])
    root = str(tmp_path / "tables")
    create_tables(spark, root)
    batch_writer(parquet_sink(root))(parsed.repartition(3), 0)
    stored, parts = read_tables(spark, root)._asdict(), routing.split(parsed)
    assert stored[name].isEmpty()
    assert {n: df.count() for n, df in stored.items()} == routing.sizes(parsed)
    assert {n: df.count() for n, df in parts.items()} == routing.sizes(parsed)


def test_empty_batch(spark, tmp_path):
    root = str(tmp_path / "tables")
    create_tables(spark, root)
    parsed = parse.transactions(Fixture(spark, SF_DIR).raw, stamp())
    for nothing in (parsed.limit(0), parsed.filter("kafka_offset < 0").persist()):
        batch_writer(parquet_sink(root))(nothing, 0)
    assert all(df.isEmpty() for df in read_tables(spark, root))


def test_stream_without_rejects(spark, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "tables")
    Fixture(spark, SF_DIR).raw.filter("offset % 33 <> 0").repartition(2).write.parquet(source)
    create_tables(spark, root)
    start(
        messages(spark, source), parquet_sink(root), str(tmp_path / "cp"), available_now=True
    ).awaitTermination()
    assert [df.count() for df in read_tables(spark, root)][::2] == [969, 0]
