"""Fitted models next to answers that are known without a solver."""

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from upkeep.defaults import FEATURES, SMALL_GRIDS
from upkeep.learning.catalogue import candidates
from upkeep.learning.expressions import prediction_column
from upkeep.learning.search import search, vectors
from upkeep.operators.optimality import linear_residuals
from upkeep.operators.splitpoints import best_split, split_gains
from upkeep.operators.splits import with_row_fold
from upkeep.registry import standins
from upkeep.registry.queries import _matrix
from upkeep.workspace import stabilise


@pytest.fixture(scope="module")
def matrix(spark, tables):
    return stabilise(_matrix(standins.events(spark, tables)))


def fitted(matrix, name, **params):
    (candidate,) = candidates(SMALL_GRIDS, [name])
    estimator = candidate.estimator.copy({candidate.estimator.getParam(k): v for k, v in params.items()})
    return estimator.fit(vectors(matrix))


def worst(matrix, model, **how):
    found = linear_residuals(matrix, model, **how).collect()
    assert [r.term for r in found] == [*FEATURES, "intercept"]
    return max(r.residual for r in found) / max(r.start for r in found)


@pytest.mark.parametrize("penalty", [0.0, 0.01, 0.5])
def test_a_fitted_logistic_model_is_optimal_and_a_moved_one_is_not(matrix, penalty):
    model = fitted(matrix, "Logistic Regression", regParam=penalty, maxIter=100, tol=1e-9)
    assert worst(matrix, model) < 1e-3
    assert worst(matrix.where("label = 1 or aircraftid % 2 = 0"), model) > 1e-2  # other rows
    assert worst(matrix, fitted(matrix, "Logistic Regression", regParam=penalty, maxIter=1)) > 1e-3


def test_a_fitted_svm_is_optimal_and_a_moved_one_is_not(matrix):
    # Labels that cycles tell, so that margins differ.
    rows = matrix.withColumn("label", (F.col("flightcycles") + F.col("aircraftid") % 2 > 3).cast("int"))
    model = fitted(rows, "Linear SVC", regParam=0.1, maxIter=200, tol=1e-9)
    assert worst(rows, model, edge=0.01) < 0.02
    assert worst(rows.withColumn("label", 1 - F.col("label")), model, edge=0.01) > 0.1


def test_rows_with_nulls_do_not_count(matrix):
    model = fitted(matrix, "Logistic Regression", maxIter=5)
    broken = matrix.unionByName(matrix.limit(3).withColumn("flighthours", F.lit(None).cast("double")))
    assert worst(broken, model) == pytest.approx(worst(matrix, model), abs=1e-12)
    assert all(r.residual is None for r in linear_residuals(matrix.limit(0), model).collect())


def brute_split(values, labels):
    def gini(some):
        share = sum(some) / len(some)
        return 1 - share * share - (1 - share) * (1 - share)

    levels = sorted(set(values))
    found = []
    for low, high in zip(levels, levels[1:]):
        left = [y for x, y in zip(values, labels) if x <= low]
        right = [y for x, y in zip(values, labels) if x > low]
        gain = gini(labels) - len(left) / len(labels) * gini(left) - len(right) / len(labels) * gini(right)
        found.append(((low + high) / 2, round(gain, 9), left.count(0), left.count(1), right.count(0), right.count(1)))
    return found


def test_split_gains_equal_brute_force(spark):
    draw = random.Random(3)
    values = [draw.randrange(12) for _ in range(400)]
    labels = [int(draw.random() < v / 12) for v in values]
    frame = spark.createDataFrame([*zip(values, labels), (None, 1)], "x int, label int").withColumn("same", F.lit(1))
    names = ("threshold", F.round("gain", 9), "left_0", "left_1", "right_0", "right_1")
    want = brute_split(values, labels)
    assert sorted(tuple(r) for r in split_gains(frame, ["x", "same"]).select(*names).collect()) == want
    (best,) = best_split(frame, ["same", "x"]).select("feature", *names).collect()
    assert tuple(best) == ("x", *max(want, key=lambda w: (w[1], -w[0])))
    assert best_split(frame, ["same"]).count() == 0


@pytest.mark.parametrize(
    "name, params",
    [
        ("Decision Tree", {"maxDepth": 4}),
        ("Random Forest", {"numTrees": 7, "maxDepth": 6}),
        ("Gradient-Boosted Trees", {"maxIter": 5, "maxDepth": 3}),
        ("Decision Tree", {"maxDepth": 0}),
    ],
)
def test_trees_as_one_expression(matrix, name, params):
    model = fitted(matrix, name, **params)
    values = vector_to_array("features")
    from_vector = prediction_column(model, [values[i] for i in range(len(FEATURES))])
    predicted = model.transform(vectors(matrix)).select("prediction", from_vector.alias("expressed"))
    assert predicted.where("prediction <> expressed").count() == 0 and predicted.count() == matrix.count()
    plain = matrix.select(prediction_column(model).alias("p")).groupBy("p").count().collect()
    counts = predicted.groupBy("prediction").count().collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, counts))


def test_a_linear_model_has_no_trees(matrix):
    with pytest.raises(TypeError, match="no trees"):
        prediction_column(fitted(matrix, "Logistic Regression", maxIter=1))


def test_searches_cache_nothing_of_their_own(spark, matrix):
    rows = vectors(with_row_fold(matrix, 3), FEATURES, "label", "fold").cache()
    rows.count()
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    (candidate,) = candidates({"Decision Tree": {"maxDepth": [1, 2, 3]}})
    found = search(candidate, rows, parallelism=6)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    rows.unpersist()
    assert len(found.avgMetrics) == 3 and found.bestModel.getMaxDepth() == 1 + found.avgMetrics.index(max(found.avgMetrics))
