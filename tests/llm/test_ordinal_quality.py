"""Ordinal regression: recovers graded marks, keeps clean texts, and held-out accuracy."""

import numpy as np

from starmill.llm import quality
from starmill.llm.queries import QUERIES


def _texts(n, seed=1):
    draw = np.random.default_rng(seed)
    rows, grades = [], []
    for i in range(n):
        words = [f"w{draw.integers(400)}" for _ in range(draw.integers(5, 60))]
        grade = i % 3
        if grade == 0:
            words = [w + "###" for w in words]
        if grade == 1:
            words[draw.integers(len(words))] = ("bad", "worse", "worst")[draw.integers(3)]
        rows.append(" ".join(words))
        grades.append(grade)
    return rows, np.array(grades)


def test_thresholds_are_ordered_and_tails_fall():
    texts, grades = _texts(600)
    model = quality.fit([quality.features(t) for t in texts], grades, 3)
    assert (np.diff(model.thresholds) > 0).all() and (model.weights < 0).all()
    tails = model.tails(-5.0)
    assert (np.diff(tails) < 0).all() and ((tails >= 0) & (tails <= 1)).all()


def test_held_out_accuracy():
    texts, grades = _texts(900)
    model = quality.fit([quality.features(t) for t in texts], grades, 3)
    more, truth = _texts(600, seed=2)
    kept = np.array([model.tails(model.score(quality.features(t)))[-1] >= quality.KEEP for t in more])
    assert kept[truth == 2].mean() > 0.99 and kept[truth < 2].mean() < 0.02


def test_fit_does_not_depend_on_row_order(spark, docs_of):
    texts, grades = _texts(60)
    docs, labels = docs_of(list(enumerate(texts))), spark.createDataFrame(list(enumerate(map(int, grades))), "doc_id long, grade int")
    one = quality.train(docs, labels)
    two = quality.train(docs.orderBy("text").repartition(3), labels.repartition(5))
    assert (one.marks == two.marks).all() and np.allclose(one.weights, two.weights)


def _problem(seed, n=40, marks=12, levels=3):
    draw = np.random.default_rng(seed)
    cells = [draw.choice(marks, draw.integers(0, 5), replace=False) for _ in range(n)]
    row, cell = np.repeat(np.arange(n), [len(c) for c in cells]), np.concatenate(cells)
    theta = np.concatenate([-draw.random(marks), [draw.normal()], draw.normal(size=levels - 1) / 2])
    return theta, cell, row, draw.integers(0, levels + 1, n), marks


def test_likelihood_equals_brute_force():
    for seed in range(5):
        theta, cell, row, grades, marks = _problem(seed)
        cut = [theta[marks]]
        for gap in theta[marks + 1 :]:
            cut.append(cut[-1] + np.exp(gap))
        total = 0.0
        for i, grade in enumerate(grades):
            score = sum(theta[c] for c, r in zip(cell, row, strict=True) if r == i)
            at_most = [1 / (1 + np.exp(score - c)) for c in cut] + [1.0]
            total -= np.log(at_most[grade] - (at_most[grade - 1] if grade else 0.0))
        assert np.isclose(quality.objective(theta, cell, row, grades, marks)[0], total / len(grades) + quality.RIDGE / 2 * (theta[:marks] ** 2).sum())
        # The expected grade is the sum of the tail probabilities.
        model = quality.Model(np.arange(marks, dtype=np.uint64), theta[:marks], np.array(cut))
        score = model.score(cell[row == 1].astype(np.uint64))
        at_most = [1 / (1 + np.exp(score - c)) for c in cut] + [1.0]
        mean = sum(g * (at_most[g] - (at_most[g - 1] if g else 0.0)) for g in range(len(at_most)))
        assert np.isclose(model.tails(score).sum(), mean)


def test_gradient_equals_finite_differences():
    for seed in range(5):
        theta, *rest = _problem(seed)
        grad = quality.objective(theta, *rest)[1]
        for k in range(len(theta)):
            step = np.zeros_like(theta)
            step[k] = 1e-6
            slope = (quality.objective(theta + step, *rest)[0] - quality.objective(theta - step, *rest)[0]) / 2e-6
            assert abs(slope - grad[k]) < 1e-6


def test_the_sample_does_not_depend_on_partitions(spark, docs_of):
    texts, grades = _texts(120)
    docs, labels = docs_of(list(enumerate(texts))), spark.createDataFrame(list(enumerate(map(int, grades))), "doc_id long, grade int")
    one = quality.train(docs, labels, sample=70)
    for parts in (1, 5, 11):
        two = quality.train(docs.repartition(parts), labels.repartition(parts), sample=70)
        assert (one.marks == two.marks).all() and (one.weights == two.weights).all() and (one.thresholds == two.thresholds).all()


def test_a_repeated_labelled_id_counts_once(spark, docs_of):
    texts, grades = _texts(60)
    docs, labels = list(enumerate(texts)), spark.createDataFrame(list(enumerate(map(int, grades))), "doc_id long, grade int")
    one = quality.train(docs_of(docs), labels)
    two = quality.train(docs_of(docs + docs[:1] * 500), labels)
    assert (one.marks == two.marks).all() and (one.weights == two.weights).all()


def test_edges(spark, docs_of, edges):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (4, 1, 0), (5, 1, 1), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    assert {tuple(r) for r in quality.graded(labels).collect()} == {(1, 2), (4, 0), (5, 1)}
    out = quality.select(docs_of(edges), quality.graded(labels))
    assert out.columns == docs_of([]).columns and out.count() <= len(edges)
    assert quality.select(docs_of([]), quality.graded(labels)).collect() == []
    # Nothing to learn from: everything stays.
    assert quality.select(docs_of(edges), quality.graded(labels.where("false"))).count() == len(edges)


def test_query_scores_equal_the_model_row_by_row(spark, table):
    docs, labels = table("documents"), table("labels")
    model = quality.train(docs, quality.graded(labels))
    expected = {}
    for r in docs.collect():
        tails = model.tails(model.score(quality.features(r["text"])))
        if tails[-1] >= quality.KEEP:
            expected[r["doc_id"]] = (float(tails.sum()), float(tails[-1]))
    got = {r["doc_id"]: tuple(r)[-2:] for r in QUERIES["op3_ordinal_quality"](spark, "/root/testdata/sf0.001").collect()}
    assert got.keys() == expected.keys() and all(np.allclose(got[i], expected[i]) for i in got)
