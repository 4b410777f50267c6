"""The database sink and source with the two JDBC calls replaced: what they are
asked to do, not a database."""

import pytest
from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F

from txrisk.checks.fixtures import Fixture
from txrisk.operators import routing
from txrisk.schemas import DLQ_MESSAGES, FRAUD_ALERTS, POSITION, TRANSACTIONS
from txrisk.sources.database import create_script, create_statement
from txrisk.sources.tables import read_jdbc
from txrisk.streaming import sinks

URL, PROPERTIES = "jdbc:test:tables", {"user": "u"}


@pytest.fixture
def parts(spark):
    return routing.split(Fixture(spark, "/root/testdata/sf0.001").parsed)


@pytest.fixture
def written(monkeypatch):
    calls = []
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: calls.append((k, v)) or self)

    def jdbc(self, url, table, mode=None, properties=None):
        self._df.collect()
        calls.append((url, table, mode, properties, self._df))

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    return calls


@pytest.fixture
def stored(monkeypatch):
    """Rows a read finds, by table, and the reads that were made."""
    rows: dict[str, DataFrame] = {}
    reads = []

    def jdbc(self, url, table, predicates=None, properties=None, **_):
        reads.append((table, predicates))
        return rows[table]

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    return rows, reads


def test_plain_append_sends_the_contract_columns(parts, written):
    write = sinks.jdbc_sink(URL, PROPERTIES, connections=4, replay_safe=False)
    for table in (TRANSACTIONS, FRAUD_ALERTS, DLQ_MESSAGES):
        written.clear()
        write(parts[table.name], table, 3, 9)
        option, (url, name, mode, properties, df) = written
        assert option == ("numPartitions", 4)
        assert (url, name, mode, properties) == (URL, table.name, "append", PROPERTIES)
        assert df.columns == table.sent
        if "amount" in df.columns:
            assert dict(df.dtypes)["amount"] == "decimal(14,2)"


def test_first_batch_skips_stored_rows_and_later_ones_do_not_look(parts, written, stored):
    rows, reads = stored
    batch = parts["fraud_alerts"]
    done = batch.filter(F.col("kafka_offset") % 2 == 0)
    rows["fraud_alerts"] = done.select(*POSITION)
    write = sinks.jdbc_sink(URL, PROPERTIES, connections=2)
    write(batch, FRAUD_ALERTS, 5, 1)
    assert reads == [
        ("fraud_alerts", [
            "batch_id = 5 AND MOD(kafka_offset, 2) = 0",
            "batch_id = 5 AND MOD(kafka_offset, 2) = 1",
        ])
    ]
    df = written[-1][-1]
    assert set(df.columns) == {*FRAUD_ALERTS.sent, *POSITION, "batch_id"}
    assert df.count() == batch.count() - done.count()
    assert df.filter("kafka_offset % 2 = 0 OR batch_id <> 5").isEmpty()
    write(batch, FRAUD_ALERTS, 6, 1)
    assert len(reads) == 1
    assert written[-1][-1].count() == batch.count()


def test_a_failed_write_is_checked_again(parts, written, stored, monkeypatch):
    rows, reads = stored
    batch = parts["dlq_messages"]
    rows["dlq_messages"] = batch.select(*POSITION).limit(0)
    write = sinks.jdbc_sink(URL, PROPERTIES)

    def broken(self, *args, **kwargs):
        raise RuntimeError("connection lost")

    with monkeypatch.context() as patch:
        patch.setattr(DataFrameWriter, "jdbc", broken)
        with pytest.raises(RuntimeError):
            write(batch, DLQ_MESSAGES, 0, 1)
    write(batch, DLQ_MESSAGES, 0, 1)
    assert len(reads) == 2


def test_a_later_batch_that_fails_is_checked_again(parts, written, stored, monkeypatch):
    rows, reads = stored
    batch = parts["dlq_messages"]
    rows["dlq_messages"] = batch.select(*POSITION).limit(0)
    write = sinks.jdbc_sink(URL, PROPERTIES)
    write(batch, DLQ_MESSAGES, 0, 1)
    assert len(reads) == 1

    def broken_after(self, *args, **kwargs):
        raise RuntimeError("connection lost after the rows were sent")

    with monkeypatch.context() as patch:
        patch.setattr(DataFrameWriter, "jdbc", broken_after)
        with pytest.raises(RuntimeError):
            write(batch, DLQ_MESSAGES, 1, 1)
    rows["dlq_messages"] = batch.select(*POSITION)
    write(batch, DLQ_MESSAGES, 1, 1)
    assert len(reads) == 2
    assert written[-1][-1].isEmpty()
    write(batch, DLQ_MESSAGES, 1, 1)
    assert len(reads) == 3


def test_bounded_read(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(
        DataFrameReader, "jdbc", lambda self, url, table, **kw: seen.update(kw, table=table)
    )
    read_jdbc(spark, URL, "transactions", PROPERTIES, ("id", 0, 900), 9)
    assert seen == {
        "table": "transactions", "column": "id", "lowerBound": 0, "upperBound": 900,
        "numPartitions": 9, "properties": PROPERTIES,
    }


def test_batch_that_is_stored_already(parts, written, stored):
    rows, _ = stored
    batch = parts["fraud_alerts"].repartition(3)
    rows["fraud_alerts"] = batch.select(*POSITION)
    sinks.jdbc_sink(URL, PROPERTIES)(batch, FRAUD_ALERTS, 0, 1)
    assert written[-1][-1].isEmpty()


@pytest.mark.parametrize("table", [TRANSACTIONS, FRAUD_ALERTS, DLQ_MESSAGES])
def test_database_tables_follow_the_contract(table):
    plain = create_statement(table, replay_safe=False)
    assert plain.startswith(f"CREATE TABLE IF NOT EXISTS {table.name} (")
    names = [line.split()[0].strip('"') for line in plain.split("\n")[1:-1]]
    assert names == table.columns
    for name in set(table.required) - {"id"}:
        assert f'"{name}" TEXT NOT NULL' in plain
    safe = create_statement(table)
    for name in (*POSITION, "batch_id"):
        assert safe.count(f'"{name}" ') == 1
    assert "UNIQUE (kafka_partition, kafka_offset)" in safe and "UNIQUE" not in plain


def test_database_types_and_defaults():
    script = create_script()
    assert script.count("CREATE TABLE IF NOT EXISTS") == 3
    assert '"amount" NUMERIC(14,2)' in script
    assert '"acknowledged" BOOLEAN DEFAULT FALSE' in script
    assert script.count('"ingested_at" TIMESTAMPTZ DEFAULT now()') == 3
