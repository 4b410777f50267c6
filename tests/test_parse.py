"""Message parsing on malformed and unusual bodies."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from txrisk.functions import parse
from txrisk.operators import routing
from txrisk.schemas import ENVELOPE

BOTH = '"transaction_id":"a","user_id":"u"'


def messages(spark, bodies):
    rows = [
        (None, body.encode() if body is not None else None, "t", i % 3, i, None, 0)
        for i, body in enumerate(bodies)
    ]
    return spark.createDataFrame(rows, ENVELOPE)


def parsed(spark, body):
    return parse.transactions(messages(spark, [body])).withColumn(
        "valid", routing.has_ids()
    ).first()


@pytest.mark.parametrize(
    "body",
    [None, "", "{oops", '{"transaction_id":"a","user_id":"u"', "[]", "[{" + BOTH + "}]",
     '{"Transaction_ID":"a","User_Id":"u"}', '{"transaction_id":"a"}', "{}"],
)
def test_rejected(spark, body):
    assert not parsed(spark, body).valid


@pytest.mark.parametrize(
    "body, field, value",
    [
        ('{"transaction_id":"","user_id":""}', "transaction_id", ""),
        ("{" + BOTH + ',"amount":12.5}', "amount", 12.5),
        ("{" + BOTH + ',"amount":"12.5"}', "amount", None),
        ("{" + BOTH + ',"amount":"zz"}', "amount", None),
        ("{" + BOTH + ',"velocity_flag":true}', "velocity_flag", True),
        ("{" + BOTH + ',"velocity_flag":"true"}', "velocity_flag", None),
        ('{"transaction_id":5,"user_id":true}', "transaction_id", "5"),
        ('{"transaction_id":5,"user_id":true}', "user_id", "true"),
        ('{"transaction_id":{"k":1},"user_id":"u"}', "transaction_id", '{"k":1}'),
        ("{" + BOTH + ',"country":"FR","country":"US"}', "country", "US"),
        ("{" + BOTH + ',"extra":1}', "user_id", "u"),
        ("{" + BOTH + ',"timestamp":"garbage"}', "timestamp", None),
        ("{" + BOTH + ',"timestamp":""}', "timestamp", None),
        ("{" + BOTH + ',"timestamp":"2024-05-01T12:30:00.123456+00:00"}', "timestamp",
         datetime(2024, 5, 1, 12, 30, 0, 123456)),
        ("{" + BOTH + ',"timestamp":"2024-05-01T12:30:00+02:00"}', "timestamp",
         datetime(2024, 5, 1, 10, 30)),
    ],
)
def test_kept(spark, body, field, value):
    row = parsed(spark, body)
    assert row.valid
    got = row[field]
    if field == "timestamp" and got is not None:
        got = got.astimezone(tz=None).replace(tzinfo=None)
    assert got == value


@pytest.mark.parametrize("text", ["NaN", '"NaN"'])
def test_nan_amount_is_an_alert_stored_without_amount(spark, text):
    raw = messages(spark, ["{" + BOTH + f',"amount":{text}}}'])
    alerts = routing.alerts(parse.transactions(raw))
    row = alerts.withColumn("stored", routing.stored_amount()).first()
    assert math.isnan(row.amount)
    assert row.fraud_reason == "HIGH_AMOUNT"
    assert row.stored is None


def test_one_ingest_time_per_query(spark):
    raw = messages(spark, ["{" + BOTH + "}"] * 20).repartition(4)
    assert parse.transactions(raw).select("ingested_at").distinct().count() == 1


def test_row_id_is_unique_and_repeatable(spark):
    positions = spark.range(1000).select(
        (F.col("id") % 3).cast("int").alias("kafka_partition"),
        (F.col("id") / 3).cast("bigint").alias("kafka_offset"),
    )
    ids = [r[0] for r in positions.select(parse.row_id()).collect()]
    assert len(set(ids)) == 1000
    shuffled = positions.repartition(7)
    assert sorted(ids) == sorted(r[0] for r in shuffled.select(parse.row_id()).collect())
