"""Ordinal quality classifier: a cumulative-link regression on graded ratings.

One weight vector on hashed text is shared by all grades; ordered thresholds `t1 < t2 < ...` turn the margin into
`P(grade >= k) = sigmoid(margin - t_k)`. Their sum gives the expected grade, and one of them the tail probability by which texts
are selected. Features are words and the kinds of the last characters of each token, valued by the root of their share.

Fitted with numpy on the driver from at most `MAX_RATED` rated texts per grade, of which only buckets are collected. Ratings are
learnt from rows that are not held out. Cases: a null text is empty; with a single grade every text gets it; null and repeated
ids stay, but an id that rows repeat is learnt from once, by the least of its texts; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from .common import arrow_step, texts
from .features import BUCKETS, Adam, Sparse, bounded_sample, feature_rows, features, held_out, sampled_texts, sigmoid

MAX_RATED = 4000
ROUNDS, RATE, DECAY, LEAST_TEXTS = 250, 0.08, 2e-5, 3
KEEP_PROBABILITY = 0.5


@dataclass
class OrdinalModel:
    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, margins: np.ndarray) -> np.ndarray:
        """P(grade >= grades[k]) for k = 1, 2, ..., a column each."""
        return sigmoid(margins[:, None] - self.thresholds[None, :])


def root_shares(text: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    total = np.bincount(text, count, minlength=n)
    return np.sqrt(count / np.maximum(total, 1)[text])


def likelihood_slopes(
    data: Sparse, grade: np.ndarray, sample_weight: np.ndarray, weights: np.ndarray, first: float, gaps: np.ndarray
) -> tuple[float, np.ndarray]:
    """Weighted negative log-likelihood and its gradient by `weights`, `first` and `gaps` (logarithms), in one vector."""
    n_grades = len(gaps) + 2
    cuts = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
    tail = sigmoid(data.margins(weights)[:, None] - cuts)
    above = np.column_stack([np.ones(data.rows), tail])  # P(grade >= k)
    below = np.column_stack([tail, np.zeros(data.rows)])  # P(grade >= k + 1)
    rows = np.arange(data.rows)
    chance = np.maximum(above[rows, grade] - below[rows, grade], 1e-9)
    slope_above, slope_below = above * (1 - above), below * (1 - below)
    up = slope_above[rows, grade] / chance * sample_weight
    down = slope_below[rows, grade] / chance * sample_weight
    by_cut = np.zeros(n_grades - 1)
    np.add.at(by_cut, grade[grade > 0] - 1, up[grade > 0])
    np.add.at(by_cut, grade[grade < n_grades - 1], -down[grade < n_grades - 1])
    by_gap = np.cumsum(by_cut[::-1])[::-1][1:] * np.exp(gaps)
    return -np.sum(sample_weight * np.log(chance)), np.concatenate([data.gradient(-(up - down)), [by_cut.sum()], by_gap])


def fit_ordinal(data: Sparse, grade: np.ndarray, n_grades: int, sample_weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds that maximise the likelihood. Thresholds are a first one and positive gaps."""
    weights, first, gaps = np.zeros(BUCKETS), 0.0, np.zeros(n_grades - 2)  # gaps hold logarithms
    optimiser = Adam(BUCKETS + 1 + len(gaps), RATE)
    for _ in range(ROUNDS):
        gradient = likelihood_slopes(data, grade, sample_weight, weights, first, gaps)[1]
        gradient[:BUCKETS] += DECAY * weights
        step = optimiser.step(gradient)
        weights, first, gaps = weights - step[:BUCKETS], first - step[BUCKETS], gaps - step[BUCKETS + 1 :]
    return weights, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])


def train(docs: DataFrame, ratings: DataFrame, rating: str = "quality") -> OrdinalModel:
    """Fit on a bounded sample of each grade; the grades' shares among all training rows weight the samples."""
    rated = ratings.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(rating).cast("long").alias("grade")).where("doc_id is not null and grade is not null")
    rated = rated.where(~held_out(F.col("doc_id")))
    sizes = {r.grade: r.n for r in rated.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).orderBy("grade").collect()}  # one row per grade
    grades = list(sizes)
    if len(grades) < 2:
        return OrdinalModel(grades or [0], np.zeros(BUCKETS), np.zeros(0))
    sample = reduce(DataFrame.unionByName, (bounded_sample(rated.where(F.col("grade") == g).distinct(), MAX_RATED) for g in grades))
    rows = feature_rows(sampled_texts(docs, sample, "grade"), "grade", tails=True).toArrow()
    data = Sparse.collected(rows)
    data.value = root_shares(data.row, data.count, data.rows)
    data.keep_frequent(LEAST_TEXTS)
    grade = np.searchsorted(grades, rows["grade"].to_numpy())
    drawn = np.maximum(np.bincount(grade, minlength=len(grades)), 1)
    share = np.array([sizes[g] for g in grades]) / sum(sizes.values())
    weights, thresholds = fit_ordinal(data, grade, len(grades), (share / drawn)[grade])
    return OrdinalModel(grades, weights, thresholds)


def rated(docs: DataFrame, model: OrdinalModel, tail_grade: int | None = None) -> DataFrame:
    """`doc_id`, `expected_grade`, `tail_probability` (of `tail_grade` or better; by default the best grade) and `kept`."""
    shared = docs.sparkSession.sparkContext.broadcast(OrdinalModel(model.grades, model.weights.astype(np.float32), model.thresholds))
    wanted = model.grades[-1] if tail_grade is None else tail_grade

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model = shared.value
        grades = np.array(model.grades, float)
        expected, chance = np.empty(batch.num_rows), np.empty(batch.num_rows)
        for i, j, text, bucket, count in features(batch["text"], tails=True):
            margins = np.bincount(text, model.weights[bucket] * root_shares(text, count, j - i), minlength=j - i)
            tails = model.tails(margins)
            expected[i:j] = grades[0] + tails @ np.diff(grades)
            k = int(np.searchsorted(grades, wanted))
            chance[i:j] = 1.0 if k == 0 else 0.0 if k > tails.shape[1] else tails[:, k - 1]
        columns = [batch["doc_id"], pa.array(expected), pa.array(chance), pa.array(chance >= KEEP_PROBABILITY)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "expected_grade", "tail_probability", "kept"])

    return arrow_step(texts(docs), step, "doc_id long, expected_grade double, tail_probability double, kept boolean")
