"""Rule order, three-valued logic and custom rules."""

import pytest
from pyspark.sql import functions as F

from txrisk.functions import rules

COLUMNS = (
    "amount DOUBLE, country STRING, ip_address STRING, card_type STRING, velocity_flag BOOLEAN"
)
EDGE_ROWS = [
    ((9500.0, "NG", "185.1", "amex", True), "HIGH_AMOUNT", True),
    ((600.0, "NG", "185.1", "amex", True), "HIGH_RISK_COUNTRY", True),
    ((10.0, "FR", "185.1", "amex", True), "SUSPICIOUS_IP", True),
    ((6000.0, "FR", "1.1", "amex", True), "AMEX_LARGE", True),
    ((1.0, "FR", "1.1", "visa", True), "VELOCITY_FRAUD", True),
    ((1.0, "FR", "1.1", "visa", False), None, False),
    ((500.0, "NG", "1.1", "visa", False), None, False),
    ((9000.0, "FR", "1.1", "visa", False), None, False),
    ((9000.004, "FR", "1.1", "visa", False), "HIGH_AMOUNT", True),
    ((6000.0, "FR", "1.1", "AMEX", False), None, False),
    ((None, "FR", "1.1", "visa", False), None, None),
    ((1.0, "FR", "1.1", "visa", None), None, None),
    ((1.0, None, None, None, None), None, None),
    ((None, None, "185.9", None, None), "SUSPICIOUS_IP", True),
    ((1.0, "FR", "1850.1", "visa", False), None, False),
]


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame([row for row, _, _ in EDGE_ROWS], COLUMNS)
    return df.select(
        rules.fraud_reason().alias("reason"),
        rules.any_rule().alias("any"),
        rules.no_rule().alias("none"),
    ).collect()


@pytest.mark.parametrize("i", range(len(EDGE_ROWS)))
def test_edge_row(scored, i):
    _, reason, some = EDGE_ROWS[i]
    assert scored[i].reason == reason
    assert scored[i].any is some
    assert scored[i].none is (None if some is None else not some)
    assert (scored[i].reason is not None) == bool(scored[i].any)


def test_custom_rules_take_columns_and_text(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "n INT, s STRING")
    own = [("LARGE", F.col("n") > 2), ("Y", "s = 'y'")]
    got = df.select(rules.fraud_reason(own)).collect()
    assert [r[0] for r in got] == [None, "Y", "LARGE"]


def test_no_rules(spark):
    row = spark.range(1).select(rules.fraud_reason([]), rules.any_rule([])).first()
    assert list(row) == [None, False]
