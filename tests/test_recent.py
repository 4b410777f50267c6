"""Time limits and latest rows on stored tables, against brute force."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from txrisk.functions.parse import utc_day
from txrisk.operators import recent

START = datetime(2024, 3, 1)


def stored(spark, path, rows):
    df = spark.createDataFrame(rows, "transaction_id STRING, ingested_at TIMESTAMP, pad STRING")
    df = df.withColumn("ingest_date", F.to_date("ingested_at"))
    df.write.partitionBy("ingest_date").parquet(path)
    return spark.read.parquet(path)


def random_rows(seed, n, days, missing=0):
    rng = random.Random(seed)
    rows = [
        (f"t{i:04d}", START + timedelta(minutes=rng.randrange(days * 24 * 6) * 10), "x" * 20)
        for i in range(n)
    ]
    return rows + [(f"z{i}", None, "x") for i in range(missing)]


def newest(rows, n):
    order = sorted(rows, key=lambda r: r[0])
    order.sort(key=lambda r: r[1] or datetime.max, reverse=True)
    return [r[0] for r in order[:n]]


@pytest.mark.parametrize(
    "n, days, missing, limit",
    [(200, 10, 0, 20), (200, 10, 0, 90), (200, 10, 0, 500), (60, 30, 3, 10), (60, 30, 12, 10),
     (5, 2, 0, 100), (0, 1, 0, 10)],
)
def test_latest(spark, tmp_path, n, days, missing, limit):
    rows = random_rows(n + days, n, days, missing)
    df = stored(spark, str(tmp_path / "t"), rows) if rows else None
    if df is None:
        df = spark.createDataFrame([], "transaction_id STRING, ingested_at TIMESTAMP")
    for table in (df, df.drop("ingest_date")):
        got = [r.transaction_id for r in recent.latest(table, limit, "transaction_id").collect()]
        assert got == newest(rows, limit)


def test_latest_prunes_days_and_reads_the_time_first(spark, tmp_path, plan_of):
    df = stored(spark, str(tmp_path / "t"), random_rows(1, 300, 10))
    result = recent.latest(df, 10, "transaction_id")
    result.collect()
    plan = plan_of(result)
    assert "TakeOrderedAndProject" in plan
    assert "ingest_date" in plan.split("PartitionFilters:", 1)[1].split("\n", 1)[0]
    assert "ReadSchema: struct<ingested_at:timestamp>" in plan
    assert "ReadSchema: struct<>" in plan


@pytest.mark.parametrize("within, span", [
    ("1 HOUR", timedelta(hours=1)), ("24 HOURS", timedelta(hours=24)),
    ("30 MINUTES", timedelta(minutes=30)),
])
def test_recent_includes_the_boundary_and_later_rows(spark, tmp_path, within, span):
    rows = random_rows(5, 400, 6)
    df = stored(spark, str(tmp_path / "t"), rows)
    as_of = START + timedelta(days=4)
    got = {r.transaction_id for r in recent.recent(df, within, as_of).collect()}
    assert got == {r[0] for r in rows if r[1] >= as_of - span}


@pytest.mark.parametrize("writer, reader", [
    ("UTC", "UTC"), ("Etc/GMT+12", "Pacific/Kiritimati"), ("Pacific/Kiritimati", "Etc/GMT+12"),
    ("America/Los_Angeles", "Asia/Tokyo"),
])
def test_days_do_not_depend_on_the_time_zone(spark, tmp_path, writer, reader):
    """A row per hour, written and read in sessions of different zones."""
    path, start, hours = str(tmp_path / "t"), 1_709_200_000, 72
    times = F.timestamp_seconds(start + F.col("id") * 3600)
    try:
        spark.conf.set("spark.sql.session.timeZone", writer)
        rows = spark.range(-hours, hours).select("id", times.alias("ingested_at"))
        day = utc_day("ingested_at")
        rows.withColumn("ingest_date", day).write.partitionBy("ingest_date").parquet(path)
        spark.conf.set("spark.sql.session.timeZone", reader)
        stored = spark.read.parquet(path)
        for hour in range(-hours, hours, 5):
            as_of = F.timestamp_seconds(F.lit(start + hour * 3600))
            expected = min(2 * hours, hours - hour + 1)
            assert recent.recent(stored, "1 HOUR", as_of).count() == expected
        assert [r.id for r in recent.latest(stored, 30, "id").collect()] == list(
            range(hours - 1, hours - 31, -1)
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_day_before_the_epoch(spark):
    days = spark.sql("SELECT timestamp_micros(-1) AS a, timestamp_micros(0) AS b").select(
        utc_day("a").cast("string"), utc_day("b").cast("string")
    )
    assert tuple(days.first()) == ("1969-12-31", "1970-01-01")


def test_recent_prunes_days(spark, tmp_path, plan_of):
    df = stored(spark, str(tmp_path / "t"), random_rows(6, 100, 6))
    plan = plan_of(recent.recent(df, "1 HOUR", START + timedelta(days=4)))
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    assert "GreaterThanOrEqual(ingested_at" in plan


def test_recent_prunes_days_for_the_current_time(spark, tmp_path, plan_of):
    df = stored(spark, str(tmp_path / "t"), random_rows(6, 100, 6))
    result = recent.recent(df, "1 HOUR")
    assert result.isEmpty()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan_of(result)


def test_last_ingest(spark, tmp_path, plan_of):
    rows = random_rows(7, 100, 6, missing=2)
    df = stored(spark, str(tmp_path / "t"), rows)
    expected = max(r[1] for r in rows if r[1])
    for table in (df, df.drop("ingest_date")):
        got = recent.last_ingest(table).select(F.col("last").cast("string")).first()[0]
        assert got == str(expected)
    empty = df.filter("transaction_id = 'none'")
    assert recent.last_ingest(empty).first().last is None
