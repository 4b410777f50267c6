"""The classifier with next to nothing to learn from, and its scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from txrisk.llm import quality_classifier
from txrisk.llm.quality_classifier import Model, Settings, classify, fit, held_out

DOCS = "doc_id BIGINT, text STRING, score STRING, predicted STRING, held_out STRING"
LABELS = "doc_id BIGINT, quality INT, text STRING"


def tables(spark, docs, labels):
    docs = [(d, t, "x", "y", "z") for d, t in docs]
    labels = [(d, q, "not read") for d, q in labels]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def in_training(spark, n):
    rows = spark.range(1000).filter(~held_out(F.col("id"))).orderBy("id").limit(n)
    return [r.id for r in rows.collect()]


def test_empty_tables(spark):
    assert classify(*tables(spark, [], [])).collect() == []
    assert classify(*tables(spark, [], [(1, 1), (2, 0)])).collect() == []
    rows = classify(*tables(spark, [(1, "a"), (None, None)], [])).collect()
    assert [(r.doc_id, r.score, r.predicted) for r in rows] == [(1, 0.5, 1), (None, 0.5, 1)]


def test_labels_without_documents_give_the_prior(spark):
    good, bad, *others = in_training(spark, 6)
    rows = classify(*tables(spark, [(i, "text") for i in others], [(good, 1), (bad, 0)])).collect()
    assert {r.score for r in rows} == {0.5}
    rows = classify(*tables(spark, [(i, "text") for i in others], [(bad, 0)])).collect()
    assert {(r.score, r.predicted) for r in rows} == {(0.0, 0)}


def test_positives_are_bounded_however_often_they_repeat(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(
        quality_classifier, "train", lambda p, u, *_: sizes.append((len(p), len(u))) or 0.25
    )
    good = in_training(spark, 5)
    docs, labels = tables(spark, [(i, "some text") for i in good] * 200, [(i, 1) for i in good])
    assert fit(docs, labels, Settings(positives=50, unlabelled=1000)) == 0.25
    [(positives, unlabelled)] = sizes
    assert positives == 50 and unlabelled == 1000


def test_very_long_and_repeated_texts_get_equal_scores(spark):
    good = in_training(spark, 8)
    docs = [(i, f"A plain sentence, number {i}. " * 5) for i in good]
    docs += [(5000, "word " * 300_000), (5001, None), (5001, None), (good[0], docs[0][1])]
    rows = classify(*tables(spark, docs, [(i, 1) for i in good])).collect()
    assert len(rows) == len(docs)
    assert all(0 <= r.score <= 1 for r in rows)
    for same in ([r.score for r in rows if r.doc_id == i] for i in (5001, good[0])):
        assert len(same) == 2 and same[0] == same[1]


def test_score_is_the_sum_of_the_ranges(spark):
    model = Model(np.array([[0.0, 1.0], [5.0, 6.0]]), np.arange(6) / 10, 0.3, 0.5)
    rows = np.array([[-1.0, 5.5], [2.0, 9.0], [0.0, 0.0]])
    margins = [0.0 + 0.4 + 0.3, 0.2 + 0.5 + 0.3, 0.1 + 0.3 + 0.3]
    assert model.score(rows) == pytest.approx(1 / (1 + np.exp(-np.array(margins))))


def test_figures_are_taken_where_the_texts_are_read(spark, monkeypatch):
    """No task gets the texts of a whole sample: before, one task took the figures
    of all texts of either sample."""
    tasks, samples = [], []
    taken = quality_classifier.figure_rows

    def watched(rows, keys):
        tasks.append(rows.rdd.getNumPartitions())
        return taken(rows, keys)

    monkeypatch.setattr(quality_classifier, "figure_rows", watched)
    monkeypatch.setattr(quality_classifier, "train", lambda p, u, *_: samples.append((p, u)) or 0.25)
    ids = in_training(spark, 60)
    texts = {i: f"Text {i} " * (i % 7 + 1) for i in ids}
    docs, labels = tables(spark, texts.items(), [(i, 1) for i in ids[:40]])
    # a table of unknown size, so that no limit is left out
    docs = docs.repartition(6).withColumn("text", F.explode(F.array("text")))
    assert fit(docs, labels, Settings(positives=30)) == 0.25
    assert tasks == [6, 6]
    order = spark.createDataFrame([(i,) for i in ids[:40]], "doc_id BIGINT").orderBy(
        F.xxhash64(F.lit(Settings.seed), "doc_id")
    )
    first = [r.doc_id for r in order.limit(30).collect()]
    [(positive, unlabelled)] = samples
    assert positive.tolist() == [quality_classifier.figures(texts[i]) for i in first]
    expected = [quality_classifier.figures(t) for t in texts.values()]
    assert sorted(unlabelled.tolist()) == sorted(expected)
