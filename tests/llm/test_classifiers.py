import random
import zlib

import numpy as np
import pytest

from fixtures import frame
from reportloom.llm import ordinal_quality, toxicity
from reportloom.llm.common import table
from reportloom.llm.features import BUCKETS, Sparse, held_out, sampled_texts

BASE = "/root/testdata/sf0.01"


def labelled(spark, n=600, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic, grade = int(rng.random() < 0.2), rng.randrange(3)
        own = [rng.choice(vocabulary) for _ in range(40)] + [rng.choice(["blorg", "snark", "vile"])] * 2 * toxic
        own += [["junk%%", "plain", "superb"][grade]] * 6
        rng.shuffle(own)
        rows.append((i, " ".join(own)))
        labels.append((i, grade, toxic))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


ODD = [(9001, None), (9002, ""), (None, "blorg"), (9003, "blorg " * 50_000), (9003, "blorg " * 50_000)]


def test_held_out_is_the_remainder_of_crc32(spark):
    ids = [0, 1, 17, 123456, -5, None]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    got = {r.doc_id: r.h for r in rows.select("doc_id", held_out(rows.doc_id).alias("h")).collect()}
    assert got == {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}


def test_toxicity_on_held_out_rows(spark):
    rows, labels, known = labelled(spark)
    got = toxicity.toxicity(frame(spark, rows + ODD, clashing=True), labels).collect()
    assert len(got) == len(rows) + len(ODD)
    by_id = {r.doc_id: r for r in got}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    test = [(by_id[i], toxic) for i, _, toxic in known if by_id[i].held_out]
    assert len(test) > 80 and np.mean([r.predicted == toxic for r, toxic in test]) > 0.95
    assert by_id[9001].score == by_id[9002].score < 0.5
    kept = toxicity.without_toxic(frame(spark, rows + ODD, clashing=True), labels)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in got if not r.predicted}


def test_toxicity_ignores_labels_of_held_out_rows(spark):
    rows, labels, known = labelled(spark, 300)
    flipped = spark.createDataFrame([(i, g, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, g, t in known], labels.schema)
    one, two = (sorted(map(tuple, toxicity.toxicity(frame(spark, rows), x).collect())) for x in (labels, flipped))
    assert one == two


def test_toxicity_without_examples_and_on_no_rows(spark):
    rows, labels, _ = labelled(spark, 60)
    none = toxicity.toxicity(frame(spark, rows), labels.where("toxic = 0")).collect()
    assert all(r.score < 1e-6 for r in none)
    assert toxicity.toxicity(frame(spark, rows).limit(0), labels).count() == 0


def test_non_negative_risk_finds_positives_among_unlabelled():
    rng = np.random.default_rng(0)

    def texts(n, positive):
        return [np.unique(np.concatenate([rng.integers(100, 400, 20), rng.integers(0, 10, 3) if positive else []]).astype(int)) for _ in range(n)]

    p, u = texts(200, True), texts(160, True) + texts(640, False)
    sets = [Sparse(x, [np.ones(len(b)) for b in x]) for x in (p, u)]
    toxicity.screen(*sets)
    model = toxicity.fit_positive_unlabelled(*sets, prior=0.2)
    margins = np.array([model.weights[b].sum() + model.bias for b in u])
    assert np.mean(margins[:160] > 0) > 0.95 and np.mean(margins[160:] > 0) < 0.02


def slope(value, x, at, width=1e-5):
    up, down = x.copy(), x.copy()
    up[at] += width
    down[at] -= width
    return (value(up) - value(down)) / (2 * width)


def sparse(rng, rows, first=0):
    own = [np.unique(rng.integers(first, first + 30, 6)) for _ in range(rows)]
    return Sparse(own, [np.ones(len(b)) for b in own])


@pytest.mark.parametrize("apart", [False, True])
def test_direction_of_the_risk_by_finite_differences(apart):
    """Where positive texts are far above the unlabelled ones the second part is negative: then the direction is that of its rise."""
    rng = np.random.default_rng(5)
    positive, unlabelled, prior = sparse(rng, 40), sparse(rng, 90, first=20), 0.4
    x = np.append(rng.normal(0, 0.3, BUCKETS), 0.1)
    if apart:
        x[:20] += 2.0
        x[20:50] -= 1.0
    first, second, direction = toxicity.risk_parts(positive, unlabelled, prior, x[:-1], x[-1])
    assert (second < 0) == apart and first > 0

    def plain(x):
        loss = lambda data, sign: np.mean([np.log1p(np.exp(-sign * z)) for z in data.margins(x[:-1]) + x[-1]])
        rest = loss(unlabelled, -1) - prior * loss(positive, -1)
        return prior * loss(positive, 1) + rest if rest >= 0 else -rest

    assert np.isclose(-second if apart else first + second, plain(x), rtol=1e-9)
    for at in [*range(50), BUCKETS]:
        assert np.isclose(direction[at], slope(plain, x, at), rtol=1e-4, atol=1e-8)


@pytest.mark.parametrize("grades", [2, 3, 5])
def test_likelihood_by_finite_differences(grades):
    rng = np.random.default_rng(grades)
    data, grade = sparse(rng, 60), rng.integers(0, grades, 60)
    sample_weight = rng.random(60)
    x = np.concatenate([rng.normal(0, 0.5, BUCKETS), [-0.7], rng.normal(0, 0.4, grades - 2)])

    def plain(x):
        cuts = [-np.inf, x[BUCKETS]]
        for gap in x[BUCKETS + 1 :]:
            cuts.append(cuts[-1] + np.exp(gap))
        cuts.append(np.inf)
        total = 0.0
        for z, g, w in zip(data.margins(x[:BUCKETS]), grade, sample_weight, strict=True):
            total -= w * np.log(1 / (1 + np.exp(cuts[g] - z)) - 1 / (1 + np.exp(cuts[g + 1] - z)))
        return total

    value, gradient = ordinal_quality.likelihood_slopes(data, grade, sample_weight, x[:BUCKETS], x[BUCKETS], x[BUCKETS + 1 :])
    assert np.isclose(value, plain(x), rtol=1e-9)
    for at in [*range(30), *range(BUCKETS, len(x))]:
        assert np.isclose(gradient[at], slope(plain, x, at), rtol=1e-4, atol=1e-8)


def test_an_id_is_learnt_from_once_however_often_it_is_repeated(spark):
    rows = [(7, f"text {i % 3}") for i in range(500)] + [(8, None), (8, "b")]
    sample = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, role long")
    got = sorted(map(tuple, sampled_texts(frame(spark, rows), sample, "role").collect()))
    assert got == [(0, ""), (1, "text 0")]


def test_repeated_rows_and_ratings_leave_the_models_as_they_are(spark):
    rows, labels, _ = labelled(spark, 200)
    many = frame(spark, rows + rows[:40] * 3)
    few = frame(spark, rows)
    one, two = (ordinal_quality.train(df, labels) for df in (few, many))
    assert np.allclose(one.weights, two.weights, atol=1e-6) and np.allclose(one.thresholds, two.thresholds, atol=1e-6)
    one, two = (toxicity.train(df, labels) for df in (few, many))
    assert np.allclose(one.weights, two.weights, atol=1e-6)


def test_held_out_quality_of_the_generated_table(spark):
    docs, labels = table(spark, BASE, "documents"), table(spark, BASE, "labels")
    got = ordinal_quality.rated(docs, ordinal_quality.train(docs, labels)).join(labels, "doc_id").where(held_out(labels.doc_id)).collect()
    assert np.mean([r.kept == (r.quality == 1) for r in got]) > 0.93


def test_ordinal_grades(spark):
    rows, labels, known = labelled(spark)
    df = frame(spark, rows + ODD, clashing=True)
    model = ordinal_quality.train(df, labels)
    assert model.grades == [0, 1, 2] and np.all(np.diff(model.thresholds) > 0)
    got = ordinal_quality.rated(df, model).collect()
    assert len(got) == len(rows) + len(ODD)
    by_id = {r.doc_id: r for r in got}
    held = [(by_id[i], grade) for i, grade, _ in known if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([round(r.expected_grade) == grade for r, grade in held]) > 0.95
    assert np.mean([r.kept == (grade == 2) for r, grade in held]) > 0.95
    better = {r.doc_id: r for r in ordinal_quality.rated(df, model, tail_grade=1).collect()}
    assert all(better[r.doc_id].tail_probability >= r.tail_probability - 1e-9 for r in got if r.doc_id is not None)
    assert ordinal_quality.rated(df.limit(0), model).count() == 0


def test_a_single_grade(spark):
    rows, labels, _ = labelled(spark, 50)
    df = frame(spark, rows)
    got = ordinal_quality.rated(df, ordinal_quality.train(df, labels.where("quality = 1"))).collect()
    assert {(r.expected_grade, r.kept) for r in got} == {(1.0, True)}


@pytest.mark.parametrize("grades", [2, 4])
def test_ordinal_fit_orders_thresholds(grades):
    rng = np.random.default_rng(3)
    grade = rng.integers(0, grades, 400)
    rows = [np.array([g, 50 + rng.integers(0, 20)]) for g in grade]
    data = Sparse(rows, [np.ones(2)] * 400)
    weights, cuts = ordinal_quality.fit_ordinal(data, grade, grades, np.full(400, 1 / 400))
    margins = np.array([weights[b].sum() for b in rows])
    assert len(weights) == BUCKETS and np.mean(np.searchsorted(cuts, margins) == grade) > 0.95
