"""Input columns named like an operator's results or its own columns."""

import pytest
from pyspark.sql import functions as F

from txrisk.llm import line_dedup, mixing, quality_rules
from txrisk.llm.common import given_back, set_aside

OPERATORS = [
    (quality_rules.quality_rules, quality_rules.RESULT, quality_rules.HELPERS),
    (line_dedup.line_dedup, line_dedup.RESULT, (line_dedup.ROW,)),
    (mixing.plan_mix, mixing.RESULT, mixing.HELPERS),
    (quality_rules.kept_documents, (), (*quality_rules.RESULT, *quality_rules.HELPERS)),
    (line_dedup.kept_documents, (), (*line_dedup.RESULT, line_dedup.ROW)),
    (mixing.mix, ("shard",), (*mixing.RESULT, *mixing.HELPERS)),
]


@pytest.mark.parametrize("operator, result, passed", OPERATORS)
def test_results_win_and_others_pass(documents, numbered_lines, operator, result, passed):
    plain = documents([(i, numbered_lines(i % 4, i % 3), f"s{i % 2}") for i in range(12)])
    names = [c for c in passed if c not in result]
    mine = {c: F.lit(f"mine {c}") for c in (*result, *names)}
    got, want = operator(plain.withColumns(mine)), operator(plain)
    rows = [r.asDict() for r in got.collect()]
    expected = [r.asDict() for r in want.collect()]
    assert len(rows) == len(expected) > 0
    for name in names:
        assert {r.pop(name) for r in rows} == {f"mine {name}"}
    order = lambda r: repr(sorted(r.items()))
    assert sorted(rows, key=order) == sorted(expected, key=order)


def test_case_does_not_matter(spark):
    rows, meanwhile = set_aside(spark.createDataFrame([(1, 2)], "Kept int, other int"), ["kept"])
    assert "Kept" not in rows.columns and list(meanwhile) == ["Kept"]
    rows = rows.withColumn("kept", F.lit(True))
    assert given_back(rows, ["Kept", "other"], meanwhile, "kept").collect() == [(2, True)]
    assert given_back(rows, ["Kept", "other"], meanwhile).collect() == [(1, 2)]
