"""Source options and job arguments."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from txrisk import __main__ as job
from txrisk.__main__ import arguments
from txrisk.checks.fixtures import Fixture
from txrisk.schemas import ENVELOPE, LAYOUT, TRANSACTIONS
from txrisk.session import scratch_dir
from txrisk.sources.messages import file_stream, kafka_options
from txrisk.sources.tables import read_table, read_tables


def test_topic_options():
    assert kafka_options("b:9092", "payments", minPartitions="64") == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "payments",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "minPartitions": "64",
    }


def test_file_stream_has_the_envelope_of_a_topic(spark, tmp_path):
    stream = file_stream(spark, str(tmp_path))
    assert stream.isStreaming
    assert stream.columns == ENVELOPE.names


def test_arguments():
    args = arguments(
        ["--servers", "b:9092", "--root", "/data", "--checkpoint", "/cp",
         "--source-option", "maxOffsetsPerTrigger=1000"]
    )
    assert (args.topic, args.root) == ("transactions", "/data")
    assert args.source_option == ["maxOffsetsPerTrigger=1000"]
    assert (args.interval, args.plain_append) == ("5 seconds", False)


def test_one_target_is_required():
    with pytest.raises(SystemExit):
        arguments(["--servers", "b:9092", "--checkpoint", "/cp"])
    with pytest.raises(SystemExit):
        arguments(["--servers", "b", "--checkpoint", "/cp", "--root", "/r", "--jdbc-url", "jdbc:x"])


def test_scratch_folder_is_under_the_shared_one(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert first != second


def test_job(spark, tmp_path, monkeypatch):
    """The whole job, with files in place of the topic."""
    source, root = str(tmp_path / "messages"), str(tmp_path / "tables")
    Fixture(spark, "/root/testdata/sf0.001").raw.write.parquet(source)
    asked = {}

    def topic(session, servers, name, **options):
        asked.update(servers=servers, name=name, **options)
        return file_stream(session, source)

    def run(session, query):
        query.processAllAvailable()
        query.stop()

    monkeypatch.setattr(job, "topic_stream", topic)
    monkeypatch.setattr(job, "run", run)
    job.main(
        ["--servers", "b:9092", "--root", root, "--checkpoint", str(tmp_path / "cp"),
         "--source-option", "minPartitions=8"]
    )
    assert asked == {"servers": "b:9092", "name": "transactions", "minPartitions": "8"}
    assert [df.count() for df in read_tables(spark, root)] == [969, 298, 31]


def test_archive_needs_its_boundary_and_keeps_rows_without_a_day(spark, tmp_path):
    root, archive = str(tmp_path / "live"), str(tmp_path / "archive")
    day = date(2024, 5, 1)
    empty = spark.createDataFrame([], TRANSACTIONS.stored)
    values = [("old", day), ("new", date(2024, 5, 3)), ("none", None)]
    rows = spark.createDataFrame(values, "transaction_id STRING, ingest_date DATE")
    rows = rows.withColumn("batch_id", F.lit(0).cast("bigint"))
    full = empty.unionByName(rows, allowMissingColumns=True)
    full.write.partitionBy(*LAYOUT).parquet(f"{root}/{TRANSACTIONS.name}")
    full.filter("transaction_id = 'old'").write.partitionBy("ingest_date").parquet(
        f"{archive}/{TRANSACTIONS.name}"
    )
    with pytest.raises(ValueError, match="closed_before"):
        read_table(spark, root, TRANSACTIONS, archive)
    whole = read_table(spark, root, TRANSACTIONS, archive, date(2024, 5, 2))
    assert sorted(r[0] for r in whole.select("transaction_id").collect()) == ["new", "none", "old"]
