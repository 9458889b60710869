"""Training is checked by the gradient of its objective."""

import math

import pytest

from moodstream.operators.features import labelled_points, vocabulary_terms
from moodstream.operators.model import gradient, loss, train_model
from moodstream.plans.training import labelled
from moodstream.plans.words import VOCABULARY, vocabulary

BOUND = 0.01


@pytest.fixture(scope="module")
def points(spark, data):
    terms = vocabulary_terms(vocabulary(spark, data), VOCABULARY + 4)
    return labelled_points(labelled(spark, data), terms).select("id", "label", "features").persist(), len(terms)


def steepest(spark, points, weights):
    rows = spark.createDataFrame(list(enumerate(map(float, weights))), "idx int, weight double")
    return max(abs(x.gradient) for x in gradient(points, rows).collect()), loss(points, rows).first().loss


def test_fitted_weights_are_an_optimum(spark, points):
    rows, n = points
    fitted = train_model(rows).coefficients.toArray()
    slope, low = steepest(spark, rows, fitted)
    assert slope < BOUND
    start, high = steepest(spark, rows, [0.0] * n)
    assert start > 10 * BOUND and math.isclose(high, math.log(2)) and low < high
    other, _ = steepest(spark, rows, [-x for x in fitted])
    assert other > BOUND


def test_gradient_equals_differences_of_the_loss(spark):
    from pyspark.ml.linalg import Vectors

    data = [(1, 1.0, Vectors.sparse(3, {0: 2.0})), (2, 0.0, Vectors.sparse(3, {0: 1.0, 2: 3.0})), (3, 1.0, Vectors.sparse(3, {}))]
    rows = spark.createDataFrame(data, ["id", "label", "features"])
    weights = [0.5, -1.0, 0.25]
    table = lambda w: spark.createDataFrame(list(enumerate(w)), "idx int, weight double")
    found = {x.idx: x.gradient for x in gradient(rows, table(weights)).collect()}
    for k in range(3):
        up, down = ([w + (step if j == k else 0) for j, w in enumerate(weights)] for step in (1e-5, -1e-5))
        slope = (loss(rows, table(up)).first().loss - loss(rows, table(down)).first().loss) / 2e-5
        assert math.isclose(found[k], slope, rel_tol=1e-6, abs_tol=1e-8)
