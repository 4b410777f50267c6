"""Streams that come in two batches: written by the tasks that read the events."""

import shutil

import pytest

from txrisk.checks.cases import CASES
from txrisk.checks.fixtures import Fixture

SF_DIR = "/root/testdata/sf0.001"
PARTS = 4


@pytest.fixture
def in_parts(spark, tmp_path):
    """The events in four files, and the folders that a query asks for."""
    for k in range(PARTS):
        (tmp_path / "events.parquet").mkdir(exist_ok=True)
        shutil.copy(f"{SF_DIR}/events.parquet", tmp_path / f"events.parquet/part-{k}.parquet")

    class Placed(Fixture):
        places = {}

        def scratch(self, label):
            self.places[label] = super().scratch(label)
            return self.places[label]

    return Placed(spark, str(tmp_path))


def files_of(fixture, label):
    return len(fixture.spark.read.parquet(fixture.places[label]).inputFiles())


def test_a_half_is_one_batch_of_several_files(spark, in_parts):
    build = CASES["str_08_half_a_batch_is_not_seen"][0]
    got = {tuple(r) for r in build(in_parts).select("table_name", "batch_id", "n").collect()}
    once = {
        tuple(r)
        for r in build(Fixture(spark, SF_DIR)).select("table_name", "batch_id", "n").collect()
    }
    assert got == {(name, batch, PARTS * n) for name, batch, n in once}
    assert {batch for _, batch, _ in got} == {0}
    assert files_of(in_parts, "messages") == 2 * PARTS


def test_a_delivery_is_one_batch_of_several_files(spark, in_parts):
    """The four files hold the same messages, and each is delivered twice."""
    build = CASES["ext_02_guarded_tables"][0]
    got = {r.table_name: r.n for r in build(in_parts).collect()}
    valid = in_parts.valid.select("kafka_offset").distinct().count()
    whole = in_parts.parsed.select("kafka_offset").distinct().count()
    assert (got["transactions"], got["dlq_messages"]) == (valid, whole - valid)
    assert files_of(in_parts, "messages") == 2 * PARTS
