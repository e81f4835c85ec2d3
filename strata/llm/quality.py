"""Text quality by positive-unlabelled learning.

Trusted positives (label 1) and unlabelled web text train a small network by
the non-negative risk: ``prior * loss(positives as 1)`` plus the unlabelled
texts' loss as 0, less the share of it that positives among them must have,
which is kept from going below zero. Labels 0 are never used. The descent takes
at most ``POSITIVES`` and ``UNLABELLED`` documents. The class prior is estimated
first, from all documents: of a plain positive-against-unlabelled scorer, the
least ratio, over score thresholds, of the share of all documents above to the
positives' share above, each with its sampling error against it.

Features are shares of byte classes, marks, repeated words and the like, of the
whole text. Scores are shifted so that ``keep`` of the trusted positives reach
``LEAST``.

Defined cases: null and empty texts have zero features and a score like any;
training ignores null labels and ids, and takes the smallest text of rows that
share an id; a text of any length is read whole, a batch of rows at a time;
score ties mean equal features; without positives every score is 0;
repeated rows are scored each; null ids stay null; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import first_by_hash, fold, map_rows, text_bytes

#: Rows that the model is fitted on.
POSITIVES, UNLABELLED = 3000, 6000
LEAST, KEEP = 0.7, 0.998
HIDDEN, STEPS, BATCH, RATE = 16, 600, 512, 0.02
SCORES = "doc_id long, held_out boolean, score double, predicted int"

MARKS = ".,!?;:|&%$#*@'\"()[]{}<>/\\-_=+~^`"
#: Byte classes: lower, upper, digit, blank, line end, other control, beyond ASCII, marks.
_CLASS = np.full(256, 5, np.uint8)
for _k, _bytes in enumerate((range(97, 123), range(65, 91), range(48, 58), (9, 32), (10, 13))):
    _CLASS[list(_bytes)] = _k
_CLASS[128:] = 6
for _k, _mark in enumerate(MARKS):
    _CLASS[ord(_mark)] = 7 + _k
CLASSES = 7 + len(MARKS)


def features(column: pa.Array) -> np.ndarray:
    """(texts, features) of whole texts."""
    data, offsets = text_bytes(column)
    lengths = np.diff(offsets)
    shares = np.zeros((len(lengths), CLASSES))
    for row in range(len(lengths)):
        part = _CLASS[data[offsets[row] : offsets[row + 1]]]
        shares[row] = np.bincount(part, minlength=CLASSES)
    words, distinct, twice, lines, once = (np.zeros(len(lengths)) for _ in range(5))
    for row, text in enumerate(column):
        text = text.as_py()
        if text:
            split = text.split()
            words[row], distinct[row] = len(split), len(set(split))
            twice[row] = sum(map(operator.eq, split, split[1:]))
            rows = text.split("\n")
            lines[row], once[row] = len(rows), len(set(rows))
    size = np.maximum(lengths, 1)[:, None]
    return np.hstack(
        [
            shares / size,
            np.sqrt(shares / size),
            np.column_stack(
                [
                    np.log1p(lengths) / 10,
                    (lengths > 0).astype(float),
                    twice / np.maximum(words, 1),
                    np.sqrt(twice / np.maximum(words, 1)),
                    np.log1p(distinct) / np.maximum(np.log1p(words), 1),
                    once / np.maximum(lines, 1),
                    words / size[:, 0],
                ]
            ),
        ]
    )


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Scorer:
    """A network of one hidden layer over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    shift: float = 0.0
    prior: float = 0.0

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights[0] + self.weights[1])

    def margin(self, x: np.ndarray) -> np.ndarray:
        return (self.hidden(x) @ self.weights[2] + self.weights[3])[:, 0] + self.shift

    def gradients(self, x: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        """Of the weights, from the slope of the risk by each margin."""
        h = self.hidden(x)
        back = slope[:, None] * self.weights[2].T * (1 - h * h)
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        return [x.T @ back, back.sum(axis=0), h.T @ slope[:, None], slope.sum(keepdims=True)]


def _descend(model: Scorer, slopes, steps: int, rng: np.random.Generator) -> None:
    """Adam; ``slopes(model, rng)`` gives a batch and its slopes."""
    first = [np.zeros_like(w) for w in model.weights]
    second = [np.zeros_like(w) for w in model.weights]
    for step in range(1, steps + 1):
        rate = RATE * (1 - step / (steps + 1))
        for k, g in enumerate(model.gradients(*slopes(model, rng))):
            g = g + 1e-4 * model.weights[k]
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            step_size = np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8
            model.weights[k] = model.weights[k] - rate * first[k] / (1 - 0.9**step) / step_size


def _fresh(x: np.ndarray, rng: np.random.Generator) -> Scorer:
    n = x.shape[1]
    weights = [rng.normal(0, n**-0.5, (n, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.25, (HIDDEN, 1)), np.zeros(1)]
    return Scorer(x.mean(axis=0), x.std(axis=0) + 1e-3, weights)


def prior_cuts(positive: np.ndarray) -> np.ndarray:
    """Scores at which the shares above are compared."""
    return np.quantile(positive, np.linspace(0.0, 0.8, 81))


def estimate_prior(positive: np.ndarray, below: np.ndarray) -> float:
    """Share of positives among the unlabelled, from the positives' scores and a
    histogram of the others': how many are under the first of ``prior_cuts``,
    from there to the second, and so on."""
    cuts, n = prior_cuts(positive), int(below.sum())
    p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    u = 1 - np.cumsum(below)[:-1] / n
    error = np.sqrt(u * (1 - u) / n) + np.sqrt(p * (1 - p) / len(positive))
    return float(np.clip(((u + error) / np.maximum(p, 1e-6)).min(), 0.05, 0.98))


def counted(margins: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many are under the first cut, between it and the second, ..., from the last on."""
    return np.bincount(np.searchsorted(cuts, margins, side="right"), minlength=len(cuts) + 1)


def train(
    positive: np.ndarray, unlabelled: np.ndarray, *, histogram=None, keep: float = KEEP, seed: int = 10
) -> Scorer:
    """``histogram(probe, cuts)`` counts the probe's scores of all documents
    between cuts, for the class prior; without it ``unlabelled`` are all there are."""
    rng = np.random.default_rng(seed)
    both = np.vstack([positive, unlabelled])

    def batch(rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
        return (
            positive[rng.integers(0, len(positive), BATCH)],
            unlabelled[rng.integers(0, len(unlabelled), BATCH)],
        )

    def plain(model: Scorer, rng: np.random.Generator):
        p, u = batch(rng)
        return np.vstack([p, u]), np.concatenate(
            [(logistic(model.margin(p)) - 1) / BATCH, logistic(model.margin(u)) / BATCH]
        )

    probe = _fresh(both, rng)
    _descend(probe, plain, STEPS // 2, rng)
    known = probe.margin(positive)
    cuts = prior_cuts(known)
    below = histogram(probe, cuts) if histogram else counted(probe.margin(unlabelled), cuts)
    prior = estimate_prior(known, below)

    def non_negative(model: Scorer, rng: np.random.Generator):
        p, u = batch(rng)
        mp, mu = model.margin(p), model.margin(u)
        negative = np.logaddexp(0, mu).mean() - prior * np.logaddexp(0, mp).mean()
        as_one, p_as_zero, u_as_zero = (logistic(mp) - 1) / BATCH, logistic(mp) / BATCH, logistic(mu) / BATCH
        if negative >= 0:
            slope = np.concatenate([prior * (as_one - p_as_zero), u_as_zero])
        else:  # climb back: the unlabelled risk must not be fitted below zero
            slope = np.concatenate([prior * p_as_zero, -u_as_zero])
        return np.vstack([p, u]), slope

    model = _fresh(both, rng)
    _descend(model, non_negative, STEPS, rng)
    model.prior = prior
    model.shift = float(np.log(LEAST / (1 - LEAST)) - np.quantile(model.margin(positive), 1 - keep))
    return model


def fit(docs: DataFrame, labels: DataFrame, *, held_out: int = 2, folds: int = 4) -> Scorer | None:
    """Positives: the first labelled 1 by a hash of the id, of the other folds;
    unlabelled: the first documents by another hash."""
    known = labels.where((fold("doc_id", folds) != held_out) & (F.col("quality") == 1)).select(
        F.col("doc_id").cast("long").alias("doc_id")
    )
    chosen = first_by_hash(known.distinct(), POSITIVES, "doc_id")
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    # POSITIVES ids at most: a size known beforehand.
    positive = map_features(texts.join(F.broadcast(chosen), "doc_id", "left_semi"))
    others = texts.where("doc_id IS NOT NULL").select("doc_id").distinct()
    others = first_by_hash(others, UNLABELLED, F.lit("unlabelled"), "doc_id")
    unlabelled = map_features(texts.join(F.broadcast(others), "doc_id", "left_semi"))

    def histogram(probe: Scorer, cuts: np.ndarray) -> np.ndarray:
        def run(batch: pa.RecordBatch) -> dict:
            bins = counted(probe.margin(features(batch.column(0))), cuts)
            return {"bin": np.arange(len(bins)), "n": bins}

        every = map_rows(texts.select("text"), run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
        out = np.zeros(len(cuts) + 1, np.int64)
        for row in every.collect():
            out[row.bin] = row.n
        return out

    return train(positive, unlabelled, histogram=histogram) if len(positive) and len(unlabelled) else None


def map_features(texts: DataFrame) -> np.ndarray:
    """Features only come to the driver: a few hundred bytes an id. Of rows that
    share an id the smallest text counts."""
    one = texts.groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = map_rows(
        one.select("doc_id", "text"),
        lambda batch: {"doc_id": batch.column(0), "x": list(features(batch.column(1)))},
        "doc_id long, x array<double>",
    )
    rows = sorted(((r.doc_id, r.x) for r in rows.collect()), key=lambda r: r[0])
    return np.array([x for _, x in rows])


def score(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, *, held_out: int = 2, folds: int = 4
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every text."""
    model = fit(docs, labels, held_out=held_out, folds=folds)

    def run(batch: pa.RecordBatch) -> dict:
        scores = logistic(model.margin(features(batch.column(1)))) if model else np.zeros(batch.num_rows)
        return {
            "doc_id": batch.column(0),
            "held_out": batch.column(2),
            "score": scores,
            "predicted": (scores >= LEAST).astype(np.int32),
        }

    rows = docs.select(F.col("doc_id").cast("long"), "text", (fold("doc_id", folds) == held_out).alias("held_out"))
    return map_rows(rows, run, SCORES)
