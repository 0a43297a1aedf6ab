from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector

from clickloom.operators import cleaning, encoders, linear, metrics


def value(frame):
    return frame.first()[0]


def test_worked_auc(rows):
    frame = rows(
        list(zip([0, 1, 1, 0, 1], [0.1, 0.9, 0.4, 0.6, 0.61])), "y int, p double"
    )
    assert value(metrics.roc_auc(frame, "y", "p")) == pytest.approx(5 / 6)


def test_auc_equals_the_evaluator(rows):
    rng = np.random.default_rng(5)
    score = np.round(rng.random(3000), 2)
    score[::3] = 0.5  # a third of the rows share one score
    label = (rng.random(3000) < score).astype(float)
    frame = rows(list(zip(label.tolist(), score.tolist())), "label double, rawPrediction double")
    expected = BinaryClassificationEvaluator(numBins=0).evaluate(frame)
    assert value(metrics.roc_auc(frame, "label", "rawPrediction")) == pytest.approx(expected)


def test_auc_of_one_class_is_null(rows):
    frame = rows([(1, 0.5), (1, 0.7)], "y int, p double")
    assert value(metrics.roc_auc(frame, "y", "p")) is None


def test_log_loss_is_clipped(rows):
    frame = rows([(1, 0.0), (0, 0.0)], "y int, p double")
    expected = -(math.log(1e-10) + math.log(1 - 1e-10)) / 2
    assert value(metrics.log_loss(frame, "y", "p")) == pytest.approx(expected)


def test_report(rows):
    frame = rows([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b"), ("a", "d")], "y string, p string")
    report = {r.label: r for r in metrics.classification_report(frame, "y", "p").collect()}
    assert tuple(report["a"])[1:] == pytest.approx((1.0, 1 / 3, 0.5, 3))
    assert tuple(report["b"])[1:] == pytest.approx((1 / 3, 1.0, 0.5, 1))
    assert tuple(report["c"])[1:] == (0.0, 0.0, 0.0, 1)
    assert tuple(report["d"])[1:] == (0.0, 0.0, 0.0, 0)
    assert report["macro avg"].f1 == pytest.approx(0.25)
    assert value(metrics.weighted_f1(frame, "y", "p")) == pytest.approx(0.4)
    assert value(metrics.accuracy(frame, "y", "p")) == pytest.approx(0.4)


def test_cross_entropy(rows):
    frame = rows([([0.0, 0.0], 0), ([1000.0, 0.0], 1)], "s array<double>, y int")
    assert value(metrics.cross_entropy(frame, "y", "s")) == pytest.approx((math.log(2) + 1000) / 2)


def binary_data(rows, n=400, k=3):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(n, k))
    y = (x @ [1.5, -2.0, 0.0] + rng.normal(size=n) > 0).astype(float)
    frame = rows([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, label double")
    return frame, x, y


def numpy_gradient(x, y, w, l1, l2):
    full = np.c_[np.ones(len(x)), x]
    p = 1 / (1 + np.exp(-full @ w))
    free = np.r_[0, w[1:]]
    return full.T @ (p - y) / len(y) + l1 * np.sign(free) + 2 * l2 * free


def test_gradient(rows):
    frame, x, y = binary_data(rows)
    w = np.array([0.3, -1.0, 0.0, 2.0])
    found = linear.elastic_net_gradient(frame, "x", "label", w, 0.1, 0.2).collect()
    assert [r.gradient for r in sorted(found)] == pytest.approx(
        numpy_gradient(x, y, w, 0.1, 0.2).tolist()
    )


def test_ridge_fit_has_no_gradient(rows):
    frame, x, y = binary_data(rows)
    features = frame.withColumn("features", array_to_vector("x"))
    model = linear.elastic_net(0.0, 0.05, tol=1e-12).fit(features)
    w = np.r_[model.intercept, model.coefficients.toArray()]
    assert np.abs(numpy_gradient(x, y, w, 0.0, 0.05)).max() < 1e-5


def test_lasso_fit_is_optimal(rows):
    frame, x, y = binary_data(rows)
    features = frame.withColumn("features", array_to_vector("x"))
    model = linear.elastic_net(0.05, 0.02, max_iter=500, tol=1e-12).fit(features)
    w = np.r_[model.intercept, model.coefficients.toArray()]
    smooth = numpy_gradient(x, y, w, 0.0, 0.02)
    for g, c in zip(smooth[1:], w[1:]):
        if c == 0:
            assert abs(g) <= 0.05 + 1e-6
        else:
            assert g == pytest.approx(-0.05 * np.sign(c), abs=1e-5)


def test_threshold_is_inclusive(rows):
    frame = rows([([0.0],), ([1.0],), ([-1.0],)], "x array<double>")
    found = linear.logit_scores(frame, "x", [0.0, 1.0]).collect()
    assert [r.predicted for r in found] == [True, True, False]


def test_label_order(rows):
    frame = rows([("b",), ("b",), ("c",), ("a",)], "l string")
    found = encoders.label_indexer(frame, "l").transform(frame).distinct().collect()
    assert {r.l: r.label for r in found} == {"b": 0.0, "a": 1.0, "c": 2.0}
    by_name = encoders.label_indexer(frame, "l", order="alphabetAsc")
    assert list(by_name.labels) == ["a", "b", "c"]
    vocabulary = encoders.label_vocabulary(frame, "l").collect()
    assert sorted((r.idx, r.label) for r in vocabulary) == [(0, "a"), (1, "b"), (2, "c")]


def test_one_hot(rows):
    frame = rows([(1, "x"), (2, "y"), (3, None), (4, "z")], "id int, c string")
    assert encoders.observed_levels(frame, ["c"]) == {"c": ["x", "y", "z"]}
    found = encoders.one_hot(frame, {"c": ["x", "y", "z"]})
    assert found.columns == ["id", "c_x", "c_y", "c_z"]
    assert sorted(tuple(r) for r in found.collect()) == [
        (1, 1, 0, 0), (2, 0, 1, 0), (3, 0, 0, 0), (4, 0, 0, 1),
    ]
    with pytest.raises(Exception, match="outside its list: z"):
        encoders.one_hot(frame, {"c": ["x", "y"]}).collect()


def test_standardize_fits_on_train(rows):
    train = rows([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    test = rows([(5.0, 6.0)], "a double, b double")
    assert tuple(encoders.standardize(test, ["a", "b"], fit_on=train).first()) == (3.0, 1.0)
    dotted = train.toDF("a.x", "b")
    assert [r[0] for r in encoders.standardize(dotted, ["a.x"]).collect()] == [-1.0, 1.0]


def test_cleaning(rows):
    frame = rows([(1, "4"), (2, " "), (3, "x"), (4, "2.0"), (5, None)], "id int, t string")
    clean = cleaning.coerce_numeric(frame, ["t"])
    assert [r.t for r in clean.orderBy("id").collect()] == [4.0, None, None, 2.0, None]
    assert {r.feature: r.nulls for r in cleaning.null_census(clean).collect()} == {"id": 0, "t": 3}
    filled = cleaning.impute_mean(clean, ["t"]).orderBy("id").collect()
    assert [r.t for r in filled] == [4.0, 3.0, 3.0, 2.0, 3.0]
    other = cleaning.impute_mean(clean, ["t"], fit_on=clean.filter("id = 1")).orderBy("id")
    assert [r.t for r in other.collect()] == [4.0, 4.0, 4.0, 2.0, 4.0]


def test_sample_is_reproducible(spark):
    one = cleaning.sample_rows(spark.range(0, 500, 1, 3), 8, "id").collect()
    two = cleaning.sample_rows(spark.range(0, 500, 1, 11), 8, "id").collect()
    assert len(one) == 8 and sorted(one) == sorted(two)
