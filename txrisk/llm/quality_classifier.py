"""Quality classifier by positive-unlabelled learning (operator 2).

Trusted positives are rows labelled good; the other class is never shown to the
model. It is learnt from unlabelled documents, which hold a share ``prior`` of
positives: the risk of calling them negative, minus ``prior`` times that risk on
the positives, estimates the risk on the hidden negatives. An estimate below
zero only shows overfitting, so such steps go the other way (non-negative
risk).

The prior is estimated from the same two samples, without a negative label. A
first model tells trusted positives from unlabelled rows, and scores those that it
was not trained on, in turns (``folds``). The share of unlabelled rows that score
at least t, divided by that of the positives, is at least the prior for each t,
and near it where hardly any negative scores that high; the t with the least
ratio, widened by what chance may add in samples of these sizes, gives the
estimate. It errs towards 1 where samples are small (some hundred rows).

A document is described by figures of its whole text. Each is cut into ranges
at quantiles of the training sample, and the model is additive over ranges, so
its score rises and falls with a figure as the data ask for.

Training uses bounded samples (``Settings``), drawn by a hash over all rows;
their figures, some dozen numbers a row, are all that reaches the driver.
Scoring is one pass without a shuffle over every document. Labels, language,
source and ids are never inputs of a score.

Defined results: a NULL or empty text is scored as a text without words; rows
without a doc_id are held out; where nothing can be learnt (no text of a trusted
positive, no unlabelled row) all texts get one score, 0.5 without labels; of a
repeated label any row counts; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import body_text


@dataclass(frozen=True)
class Settings:
    """Bounds of the two training samples, ranges per figure, and training.
    Weights are held back by ``decay`` over the number of positives; ``doubt`` is
    the chance that the bound behind the prior may miss."""

    positives: int = 16_000
    unlabelled: int = 32_000
    ranges: int = 24
    steps: int = 400
    rate: float = 0.2
    decay: float = 0.1
    folds: int = 5
    doubt: float = 0.1
    seed: int = 7


FIGURES = (
    "words", "mean_length", "long_words", "upper", "digits", "symbols", "marks", "exclaims",
    "stops", "commas", "bars", "distinct_words", "distinct_pairs", "same_as_next", "line_length",
    "repeated_lines", "odd_ends", "capital_words",
)
SYMBOLS = "#*$%&|<>=_~^"


def figures(text: str) -> list[float]:
    """Figures of one text; shares are of its characters, words or lines."""
    words = text.split()
    n, chars = len(words), max(1, len(text))
    if not n:
        return [0.0] * len(FIGURES)
    lines = [line for line in text.split("\n") if line.strip()]
    pairs = len(set(zip(words, words[1:]))) / max(1, n - 1)
    count = text.count
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        sum(len(w) > 14 for w in words) / n,
        sum(map(str.isupper, words)) / n,
        sum(count(d) for d in "0123456789") / chars,
        sum(count(s) for s in SYMBOLS) / chars,
        sum(count(m) for m in ".,;:!?") / n,
        count("!") / n,
        count(".") / n,
        count(",") / n,
        count("|") / n,
        len(set(words)) / n,
        pairs,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        float(np.log1p(n / len(lines))),
        1 - len(set(lines)) / len(lines),
        sum(not w[-1].isalnum() for w in words) / n,
        sum(w[0].isupper() for w in words) / n,
    ]


def figure_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the figures of ``text`` as an array."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [figures(t.as_py()) for t in batch.column(len(keys))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keys)], pa.array(found, pa.list_(pa.float64()))],
                names=[*keys, "figures"],
            )

    kinds = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys]
    return rows.select(*keys, body_text().alias("text")).mapInArrow(
        scan, ", ".join([*kinds, "figures array<double>"])
    )


@dataclass(frozen=True)
class Model:
    """Cut points per figure, and a weight per figure and range."""

    cuts: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def ranges(self, rows: np.ndarray) -> np.ndarray:
        """Column of each row's range in the flat weights."""
        width = self.cuts.shape[1] + 1
        return np.stack(
            [
                np.searchsorted(cut, rows[:, k], side="right") + k * width
                for k, cut in enumerate(self.cuts)
            ],
            axis=1,
        )

    def score(self, rows: np.ndarray) -> np.ndarray:
        margin = self.weights[self.ranges(rows)].sum(axis=1) + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def mean_slopes(at: np.ndarray, slopes: np.ndarray, size: int) -> np.ndarray:
    """Gradient of the mean loss, whose slope by each row's margin is given. The
    last weight is the intercept."""
    flat = np.bincount(at.ravel(), np.repeat(slopes, at.shape[1]), minlength=size)
    flat[-1] = slopes.sum()
    return flat / len(at)


def risks(
    weights: np.ndarray, at_p: np.ndarray, at_u: np.ndarray, prior: float
) -> tuple[tuple[float, np.ndarray], tuple[float, np.ndarray]]:
    """Logistic risk of the positives and estimated risk of the hidden negatives,
    each with its gradient."""
    margin_p = weights[at_p].sum(axis=1) + weights[-1]
    margin_u = weights[at_u].sum(axis=1) + weights[-1]
    good_p, good_u = 1 / (1 + np.exp(-margin_p)), 1 / (1 + np.exp(-margin_u))
    size = len(weights)
    called_good = prior * np.logaddexp(0, -margin_p).mean()
    hidden = np.logaddexp(0, margin_u).mean() - prior * np.logaddexp(0, margin_p).mean()
    hidden_slope = mean_slopes(at_u, good_u, size) - prior * mean_slopes(at_p, good_p, size)
    return (
        (called_good, prior * mean_slopes(at_p, good_p - 1, size)),
        (hidden, hidden_slope),
    )


def separating(weights: np.ndarray, at_p: np.ndarray, at_u: np.ndarray) -> np.ndarray:
    """Gradient of the risk of telling positives from unlabelled rows."""
    good_p = 1 / (1 + np.exp(-(weights[at_p].sum(axis=1) + weights[-1])))
    good_u = 1 / (1 + np.exp(-(weights[at_u].sum(axis=1) + weights[-1])))
    size = len(weights)
    return (mean_slopes(at_p, good_p - 1, size) + mean_slopes(at_u, good_u, size)) / 2


def non_negative(
    weights: np.ndarray, at_p: np.ndarray, at_u: np.ndarray, prior: float
) -> np.ndarray:
    """Where to step for the non-negative unbiased risk."""
    (_, good_slope), (hidden, hidden_slope) = risks(weights, at_p, at_u, prior)
    return good_slope + hidden_slope if hidden >= 0 else -hidden_slope


def descended(
    size: int, slope_at: Callable[[np.ndarray], np.ndarray], settings: Settings, positives: int
) -> np.ndarray:
    """Weights and intercept by Adam, with all rows in each step: the mean over the
    second half of the steps, since those of the non-negative risk go to and fro."""
    decay = settings.decay / positives
    weights, first, second, total = (np.zeros(size) for _ in range(4))
    for step in range(1, settings.steps + 1):
        slope = slope_at(weights)
        slope[:-1] += decay * weights[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        scale = np.sqrt(second / (1 - 0.999**step)) + 1e-8
        weights = weights - settings.rate * (first / (1 - 0.9**step)) / scale
        if 2 * step > settings.steps:
            total += weights
    return total / (settings.steps - settings.steps // 2)


def untrained(positive: np.ndarray, unlabelled: np.ndarray, settings: Settings) -> Model:
    """Ranges at the quantiles of the rows, without weights."""
    levels = np.linspace(0, 1, settings.ranges + 1)[1:-1]
    cuts = np.quantile(np.concatenate([positive, unlabelled]), levels, axis=0).T
    return Model(cuts, np.zeros(cuts.shape[0] * (cuts.shape[1] + 1)), 0.0, 1.0)


def least_ratio(score_p: np.ndarray, score_u: np.ndarray, doubt: float) -> float:
    """Largest share of positives among the unlabelled rows that their scores
    allow, chance considered."""
    limits = np.unique(score_p)
    share_p = 1 - np.searchsorted(np.sort(score_p), limits) / len(score_p)
    share_u = 1 - np.searchsorted(np.sort(score_u), limits) / len(score_u)
    chance = sum(np.sqrt(np.log(4 / doubt) / (2 * len(s))) for s in (score_p, score_u))
    best = np.argmin((share_u + chance) / share_p)
    return float(min(1.0, max(share_u[best], 1 / len(score_u)) / share_p[best]))


def class_prior(
    positive: np.ndarray, unlabelled: np.ndarray, settings: Settings = Settings()
) -> float:
    """Estimated share of positives among the unlabelled rows. With a single row
    of either kind nothing speaks against 1."""
    if min(len(positive), len(unlabelled)) < 2:
        return 1.0
    model = untrained(positive, unlabelled, settings)
    at_p, at_u = model.ranges(positive), model.ranges(unlabelled)
    size, folds = len(model.weights) + 1, min(settings.folds, len(positive), len(unlabelled))
    turn_p, turn_u = np.arange(len(at_p)) % folds, np.arange(len(at_u)) % folds
    score_p, score_u = np.empty(len(at_p)), np.empty(len(at_u))
    for turn in range(folds):
        own_p, own_u = at_p[turn_p != turn], at_u[turn_u != turn]
        weights = descended(size, lambda w: separating(w, own_p, own_u), settings, len(own_p))
        score_p[turn_p == turn] = weights[at_p[turn_p == turn]].sum(axis=1) + weights[-1]
        score_u[turn_u == turn] = weights[at_u[turn_u == turn]].sum(axis=1) + weights[-1]
    return least_ratio(score_p, score_u, settings.doubt)


def train(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, settings: Settings = Settings()
) -> Model:
    """Minimise the non-negative unbiased risk with logistic loss."""
    model = untrained(positive, unlabelled, settings)
    at_p, at_u = model.ranges(positive), model.ranges(unlabelled)
    size = len(model.weights) + 1
    weights = descended(size, lambda w: non_negative(w, at_p, at_u, prior), settings, len(at_p))
    return Model(model.cuts, weights[:-1], float(weights[-1]), prior)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model | float:
    """Model from labelled and unlabelled rows that are not held out. Without a
    trusted positive or an unlabelled row it is one score for all texts: the share
    of good rows among the labelled ones, without a label one half."""
    known = labels.filter(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    good = known.filter(F.col("quality") == 1)
    n_known, n_good = known.count(), good.count()
    if not n_good:
        return 0.0 if n_known else 0.5
    order = F.xxhash64(F.lit(settings.seed), F.col("doc_id"))
    trusted = good.select("doc_id").distinct().orderBy(order, "doc_id").limit(settings.positives)
    usable = docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text")
    # At most ``positives`` ids, whatever the size of the corpus, and as many
    # rows, however often an id is repeated. Figures are taken where the texts
    # are read: one task sorts or limits figures only, not the sample's texts.
    positive = usable.join(F.broadcast(trusted), "doc_id").select(
        order.alias("place"), F.xxhash64("text").alias("text_hash"), "text"
    )
    positive = figure_rows(positive, ["place", "text_hash"])
    positive = positive.orderBy("place", "text_hash").limit(settings.positives)
    total = usable.count()
    share = min(1.0, settings.unlabelled / max(1, total))
    drawn = usable.filter(F.pmod(order, F.lit(1 << 30)) < int(share * (1 << 30)))
    # The draw varies a little in size; the limit only bounds it.
    drawn = figure_rows(drawn, ["doc_id"]).limit(2 * settings.unlabelled)

    def collected(rows: DataFrame) -> np.ndarray:
        found = rows.select("figures").toArrow()
        if not found.num_rows:
            return np.empty((0, len(FIGURES)))
        flat = found.column(0).combine_chunks().flatten()
        return flat.to_numpy(zero_copy_only=False).reshape(-1, len(FIGURES))

    trusted_rows, drawn_rows = collected(positive), collected(drawn)
    if not len(trusted_rows) or not len(drawn_rows):
        return n_good / n_known
    prior = class_prior(trusted_rows, drawn_rows, settings)
    return train(trusted_rows, drawn_rows, prior, settings)


def classify(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.3
) -> DataFrame:
    """doc_id, held_out, score and predicted per document."""
    model = fit(docs, labels, settings)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([figures(t.as_py()) for t in batch.column(1)])
            if isinstance(model, Model):
                score = model.score(rows.reshape(-1, len(FIGURES)))
            else:
                score = np.full(len(rows), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"]
            )

    scored = docs.select("doc_id", body_text().alias("text")).mapInArrow(
        scan, f"doc_id {kind}, score double"
    )
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
