"""Live figures on file streams: late rows, restarts, repeated messages, state."""

from datetime import datetime, timedelta

import pytest

from txrisk.operators.repeats import once
from txrisk.schemas import schema
from txrisk.sources.messages import file_stream
from txrisk.streaming.live import live_activity, read_minutes, start_minutes, windowed_rate

START = datetime(2024, 5, 1, 12, 0)
ROWS = "transaction_id string, kafka_partition int, kafka_offset bigint, ingested_at timestamp"
RATE = schema(minute="timestamp", ticks="long")
ACTIVITY = schema(minute="timestamp", total="long", fraud="long")


def at(minute, second=0):
    return START + timedelta(minutes=minute, seconds=second)


def put(spark, path, *rows):
    """One more file with (id, minute, second) rows; the id tells the offset."""
    full = [(f"t{i}", 0, i, at(m, s)) for i, m, s in rows]
    spark.createDataFrame(full, ROWS).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return file_stream(spark, path, ROWS, maxFilesPerTrigger="1", latestFirst="false")


@pytest.fixture
def place(tmp_path):
    return lambda name: str(tmp_path / name)


def run_rate(spark, place, lateness="2 minutes"):
    query = start_minutes(
        windowed_rate(stream(spark, place("in")), lateness), place("out"), place("cp"),
        available_now=True,
    )
    query.awaitTermination()
    minutes = read_minutes(spark, place("out"), RATE).orderBy("minute").collect()
    return query, [((m - START).seconds // 60, n) for m, n in minutes]


def test_rate_adds_up_over_a_restart_within_a_minute(spark, place):
    put(spark, place("in"), (1, 0, 5), (2, 0, 50), (3, 1, 10))
    assert run_rate(spark, place)[1] == [(0, 2), (1, 1)]
    put(spark, place("in"), (4, 1, 59), (5, 2, 0))
    assert run_rate(spark, place)[1] == [(0, 2), (1, 2), (2, 1)]
    # Nothing new: nothing changes.
    assert run_rate(spark, place)[1] == [(0, 2), (1, 2), (2, 1)]


def test_rate_takes_late_rows_up_to_the_watermark(spark, place):
    put(spark, place("in"), (1, 0, 0), (2, 30, 0))
    run_rate(spark, place)
    put(spark, place("in"), (3, 29, 0), (4, 5, 0))
    query, minutes = run_rate(spark, place)
    assert minutes == [(0, 1), (29, 1), (30, 1)]
    dropped = [s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators]
    assert sum(dropped) == 1


def test_rate_of_an_empty_stream(spark, place):
    put(spark, place("in"))
    assert run_rate(spark, place)[1] == []


def test_state_is_worked_on_by_a_task_per_partition(spark, place):
    """The stateful step keeps its partitions, and few figures give one file."""
    put(spark, place("in"), *[(i, i, 0) for i in range(100)])
    query, minutes = run_rate(spark, place)
    assert minutes == [(i, 1) for i in range(100)]
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(str(query.runId))]
    stages = [tracker.getStageInfo(s) for job in jobs for s in job.stageIds]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(s.numTasks for s in stages if s) == partitions > 1
    written = spark.read.parquet(f"{place('out')}/batch_id=0").inputFiles()
    assert len(written) == 1


def run_once(spark, place, within):
    query = (
        once(stream(spark, place("in")), within)
        .writeStream.format("parquet")
        .option("checkpointLocation", place("cp"))
        .trigger(availableNow=True)
        .start(place("out"))
    )
    query.awaitTermination()
    rows = spark.read.schema(ROWS).parquet(place("out"))
    return query, sorted(r.kafka_offset for r in rows.collect())


def test_messages_delivered_twice_come_once(spark, place):
    first = [(i, 0, i) for i in range(20)]
    put(spark, place("in"), *first, *first[:5])
    assert run_once(spark, place, "10 minutes")[1] == list(range(20))
    put(spark, place("in"), *first[10:], (20, 1, 0), (20, 1, 0))
    assert run_once(spark, place, "10 minutes")[1] == list(range(21))


def test_known_messages_expire(spark, place):
    put(spark, place("in"), *[(i, 0, i) for i in range(20)])
    run_once(spark, place, "10 minutes")
    put(spark, place("in"), (50, 60, 0))
    query, _ = run_once(spark, place, "10 minutes")
    kept = [s.numRowsTotal for p in query.recentProgress for s in p.stateOperators]
    assert kept[-1] == 1, "the keys of the first minute are gone"
    put(spark, place("in"), (3, 0, 3), (50, 60, 0))
    query, offsets = run_once(spark, place, "10 minutes")
    assert offsets == [*range(20), 50], "an expired copy is late"


def run_activity(spark, place, within=300):
    facts, alerts = stream(spark, place("facts")), stream(spark, place("alerts"))
    start_minutes(
        live_activity(facts, alerts, within), place("out"), place("cp"),
        mode="append", available_now=True,
    ).awaitTermination()
    minutes = read_minutes(spark, place("out"), ACTIVITY).orderBy("minute").collect()
    return [((m - START).seconds // 60, total, fraud) for m, total, fraud in minutes]


def test_activity_with_late_repeated_and_missing_alerts(spark, place):
    put(spark, place("facts"), (1, 0, 0), (2, 0, 30), (3, 0, 40), (1, 0, 59), (4, 1, 0), (5, 1, 1))
    # Id 1 has two alerts and two transactions; the alert of id 5 is too late.
    put(spark, place("alerts"), (1, 0, 0), (1, 0, 2), (5, 7, 0))
    assert run_activity(spark, place) == [], "no minute is closed"
    put(spark, place("alerts"), (3, 4, 0), (1, 5, 58))
    put(spark, place("facts"), (6, 3, 0))
    assert run_activity(spark, place) == []
    # The clock goes on in both streams.
    put(spark, place("facts"), (90, 60, 0))
    put(spark, place("alerts"), (91, 60, 0))
    assert run_activity(spark, place) == [(0, 4, 3), (1, 2, 0), (3, 1, 0)]
