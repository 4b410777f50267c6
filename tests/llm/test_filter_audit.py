"""The audit of filter orders against all orders tried one by one."""

from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from txrisk.llm import filter_audit

DOCS = "doc_id BIGINT, text STRING, lang STRING, n BIGINT, part STRING, failures INT, digest STRING"
LABELS = "doc_id BIGINT, quality INT, toxic INT, part STRING, n INT"
LOST = {"good_lost": "good", "toxic_lost": "toxic"}
PLAIN = " ".join(f"w{i}" for i in range(120))


def audited(spark, docs, labels):
    rows = [(d, t, g, 7, "x", 9, "y") for d, t, g in docs]
    marks = [(*r, "z", 1) for r in labels]
    found = filter_audit.documents_with_filters(
        spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, LABELS)
    )
    return filter_audit.filter_audit(found, "ABCDE", LOST)


def failures(docs):
    """Letters that each document fails, decided one by one."""
    for doc_id, text, _ in docs:
        text = text or ""
        words = text.encode().split()
        capitals = sum("A" <= c <= "Z" for c in text)
        smaller = [
            d for d, t, _ in docs if (t or "") == text and None not in (d, doc_id) and d < doc_id
        ]
        yield {
            letter
            for letter, fails in {
                "A": len(words) < 100,
                "B": 100 * len(set(words)) < 80 * len(words),
                "C": 100 * capitals > 10 * len(text),
                "D": any(c in "#$%&*|" for c in text),
                "E": bool(smaller),
            }.items()
            if fails
        }


def expected(docs, labels):
    failed = list(failures(docs))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows, shapley = {}, Counter()
    for part in {g or "" for _, _, g in docs}:
        mine = [(d, f) for (d, _, g), f in zip(docs, failed) if (g or "") == part]
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                removed = [d for d, f in mine if letter in f and not f & before]
                rows[part, order, step] = (
                    sum(not f & {*before, letter} for _, f in mine),
                    len(removed),
                    sum(letter in f and bool(f & before) for _, f in mine),
                    sum(f == {letter} for _, f in mine),
                    sum(d in good for d in removed),
                    sum(d in toxic for d in removed),
                )
                shapley[part, letter] += len(removed)
    return {(p, o, s, *v, shapley[p, o[s - 1]]) for (p, o, s), v in rows.items()}


TEXTS = [
    PLAIN, "", None, "short", PLAIN + " $", "A" * 30, "the " * 150, PLAIN.upper(), "é" * 9 + "A",
    "Ab " * 60 + "\x0b\x1f# " + PLAIN, PLAIN + " x", "  \t ", PLAIN + " #" + PLAIN.upper(),
]


@pytest.fixture(scope="module")
def sample():
    langs = ["en", "de", None, ""]
    docs = [(i, TEXTS[i * i % len(TEXTS)], langs[i % 4]) for i in range(70)]
    # Ids missing, rows repeated, ids shared by two texts and by two parts.
    docs += [(None, PLAIN, "en"), (None, "only here", "en"), (0, PLAIN, "en"), (0, PLAIN, "de")]
    docs += [(3, "another text", "en"), (900, "x" * 200_000 + " " + PLAIN, "en"), (69, None, "fr")]
    labels = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(0, 80, 2)]
    labels += [(1, 1, None), (1, 0, 1), (None, 1, 1), (5, None, None)]
    return docs, labels


def test_audit_is_every_order_tried(spark, sample):
    rows = audited(spark, *sample).collect()
    columns = [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley",
    ]
    got = [tuple(r[c] for c in columns) for r in rows]
    assert len(got) == len(set(got)) == 600 * len({g or "" for _, _, g in sample[0]})
    assert set(got) == expected(*sample)


def test_empty_tables(spark, sample):
    assert audited(spark, [], []).collect() == []
    rows = audited(spark, sample[0], []).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(rows) == (0, 0)


def test_many_parts_exceed_no_recursion_limit(spark):
    before = spark.conf.get(filter_audit.ROW_LIMIT)
    spark.conf.set(filter_audit.ROW_LIMIT, "400")
    try:
        docs = [(i, "short", f"lang{i % 9}") for i in range(40)]
        assert audited(spark, docs, []).count() == 9 * 600
        assert spark.conf.get(filter_audit.ROW_LIMIT) == "400"
    finally:
        spark.conf.set(filter_audit.ROW_LIMIT, before)


def test_other_letters(spark):
    rows = spark.createDataFrame(
        [("p", 0, 5), ("p", 1, 2), ("p", 3, 4)], "part string, failures int, n bigint"
    )
    found = filter_audit.filter_audit(rows, "xy", {}).collect()
    assert {(r.filter_order, r.step, r.kept, r.removed, r.redundant, r.shapley) for r in found} == {
        ("xy", 1, 5, 6, 0, 8), ("xy", 2, 5, 0, 4, 4), ("yx", 1, 7, 4, 0, 4), ("yx", 2, 5, 2, 4, 8),
    }
    for letters in ("", "xx", "abcdefgh", "a'"):
        with pytest.raises(ValueError):
            filter_audit.filter_audit(rows, letters, {})
