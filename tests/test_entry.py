"""The driver contract and the known figures of the fixture."""

import pytest

import __spark_entry__ as contract
from txrisk.checks.fixtures import Fixture
from txrisk.plans import reports

# Rows per table, unacknowledged alerts, fraud rate over 24 hours.
FIGURES = {
    "sf0.001": (969, 305, 31, 233, 32.50),
    "sf0.01": (9696, 3292, 304, 2585, 31.78),
    "sf0.1": (96969, 34036, 3031, 26568, 34.60),
}


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["fraud_reason", "n"]
    assert [r.n for r in result.collect()] == [227, 29, 23, 20, 6]


def test_every_query_has_an_oracle():
    """But for the training-data queries, which SQL can express in part only."""
    own = contract.queries().keys() - contract.LLM_QUERIES.keys()
    assert own == contract.oracle_sql().keys() - contract.LLM_ORACLES.keys()
    assert contract.LLM_ORACLES.keys() <= contract.LLM_QUERIES.keys()


@pytest.mark.parametrize("scale", FIGURES)
def test_figures(spark, scale):
    f = Fixture(spark, f"/root/testdata/{scale}")
    totals = reports.pipeline_totals(f.tables).first()
    unacked = reports.unacknowledged(f.alerts).count()
    rate = reports.fraud_rate(f.transactions, f.alerts, f.as_of, reports.ALERT_PERIOD).first()[0]
    assert (*totals[:3], unacked, rate) == FIGURES[scale]
