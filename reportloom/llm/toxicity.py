"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positive examples; all other training texts are unlabelled, whatever their label says. With the
class prior `p` the risk is `p * R+(positive) + max(0, R-(unlabelled) - p * R-(positive))`; where the second part gets negative,
a step goes the other way. The classifier is linear on the presence of hashed words and fitted with numpy on the driver from
at most `MAX_POSITIVE` and `MAX_UNLABELLED` texts; only their buckets are collected. Scores are made where the texts are.

Labels are learnt from rows that are not held out (see `features.held_out`). Cases: a null text is empty and gets the score of
the bias alone; without confirmed toxic texts all scores are 0; null and repeated ids stay, but an id that rows repeat is learnt
from once, by the least of its texts; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from .common import arrow_step, texts
from .features import BUCKETS, Adam, Sparse, bounded_sample, feature_rows, features, held_out, sampled_texts, sigmoid

MAX_POSITIVE, MAX_UNLABELLED = 3000, 9000
ROUNDS, RATE, DECAY = 300, 0.05, 5e-5
#: Words take part if they are so many standard deviations more or less frequent in positive than in unlabelled texts.
LEAST_DEVIATION, LEAST_TEXTS = 3.5, 2


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.empty(len(column))
        for i, j, text, bucket, _ in features(column):
            out[i:j] = sigmoid(np.bincount(text, self.weights[bucket], minlength=j - i) + self.bias)
        return out


def screen(positive: Sparse, unlabelled: Sparse) -> None:
    """Keep the buckets whose frequency in positive texts differs from the one in unlabelled texts by more than chance."""
    in_positive, in_unlabelled = (np.bincount(s.column, minlength=BUCKETS) for s in (positive, unlabelled))
    share = (in_unlabelled + 1) / (unlabelled.rows + 2)
    expected = positive.rows * share
    deviation = np.abs(in_positive - expected) / np.sqrt(expected * (1 - share) + 0.25)
    kept = (in_positive >= LEAST_TEXTS) & (deviation > LEAST_DEVIATION)
    for s in (positive, unlabelled):
        s.keep(kept[s.column])


def risk_parts(positive: Sparse, unlabelled: Sparse, prior: float, weights: np.ndarray, bias: float) -> tuple[float, float, np.ndarray]:
    """`p * R+(positive)`, `R-(unlabelled) - p * R-(positive)`, and the direction of a step (weights, bias).

    The direction is the gradient of the parts' sum, or, where the second part is negative, the one that raises that part.
    """
    p, u = sigmoid(positive.margins(weights) + bias), sigmoid(unlabelled.margins(weights) + bias)
    as_negative = lambda x: -np.log1p(-np.minimum(x, 1 - 1e-12))
    n_p, n_u = max(positive.rows, 1), max(unlabelled.rows, 1)
    positive_risk = prior * np.sum(-np.log(p)) / n_p
    negative_risk = np.sum(as_negative(u)) / n_u - prior * np.sum(as_negative(p)) / n_p
    if negative_risk >= 0:
        at_p, at_u = prior * (p - 1) - prior * p, u  # slopes of the loss as positive, less the loss as negative
    else:
        at_p, at_u = prior * p, -u
    at_p, at_u = at_p / n_p, at_u / n_u
    return positive_risk, negative_risk, np.append(positive.gradient(at_p) + unlabelled.gradient(at_u), at_p.sum() + at_u.sum())


def fit_positive_unlabelled(positive: Sparse, unlabelled: Sparse, prior: float) -> ToxicityModel:
    """Minimise the non-negative risk with the logistic loss."""
    weights, bias = np.zeros(BUCKETS), np.log(prior / (1 - prior))
    optimiser = Adam(BUCKETS + 1, RATE)
    for _ in range(ROUNDS):
        direction = risk_parts(positive, unlabelled, prior, weights, bias)[2]
        direction[:-1] += DECAY * weights
        step = optimiser.step(direction)
        weights, bias = weights - step[:-1], bias - step[-1]
    return ToxicityModel(weights, float(bias))


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit on the documented bounds; the class prior is the share of toxic rows among all labelled training rows."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    known = known.where(~held_out(F.col("doc_id")))
    n, n_toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_toxic:
        return ToxicityModel(np.zeros(BUCKETS), -40.0)
    toxic = bounded_sample(known.where("toxic = 1").select("doc_id").distinct(), MAX_POSITIVE).withColumn("role", F.lit(1).cast("long"))
    others = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    others = bounded_sample(others.distinct(), MAX_UNLABELLED).withColumn("role", F.lit(0).cast("long"))
    rows = feature_rows(sampled_texts(docs, toxic.unionByName(others), "role"), "role").toArrow()
    sets = [Sparse.collected(rows.filter(pc.equal(rows["role"], role))) for role in (1, 0)]
    if not sets[0].rows:
        return ToxicityModel(np.zeros(BUCKETS), -40.0)
    screen(*sets)
    return fit_positive_unlabelled(*sets, prior=min(0.9, max(0.001, n_toxic / n)))


def scored(docs: DataFrame, model: ToxicityModel, *keep: str) -> DataFrame:
    """`doc_id`, the columns in `keep`, and the score of each row of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(ToxicityModel(model.weights.astype(np.float32), model.bias))  # BUCKETS floats

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept = [batch[c] for c in keep]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *kept, pa.array(shared.value.scores(batch["text"]))], ["doc_id", *keep, "score"])

    source = texts(docs, *keep)
    types = "".join(f", `{c}` {t}" for c, t in source.select(*keep).dtypes) if keep else ""
    return arrow_step(source, step, f"doc_id long{types}, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id`, `held_out`, `score` and `predicted` of each row of `docs`."""
    return scored(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` whose text scores below 0.5, with all columns as they are."""
    model = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(ToxicityModel(model.weights.astype(np.float32), model.bias))

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        text = batch["text"].fill_null("")
        yield batch.filter(pa.array(shared.value.scores(text) < 0.5))

    return arrow_step(docs, step, docs.schema)
