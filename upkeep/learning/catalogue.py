"""The six classifiers and their grids."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder

from upkeep.defaults import FEATURES, GRIDS, LABEL, SEED

ESTIMATORS = {
    "Decision Tree": DecisionTreeClassifier,
    "Random Forest": RandomForestClassifier,
    "Logistic Regression": LogisticRegression,
    "Gradient-Boosted Trees": GBTClassifier,
    "Linear SVC": LinearSVC,
    "Naive Bayes": NaiveBayes,
}


@dataclass(frozen=True)
class Candidate:
    """A classifier and the parameter values to try."""

    name: str
    estimator: Estimator
    grid: Mapping[str, Sequence[Any]]

    def param_maps(self) -> list[dict]:
        """The cartesian product of the grid's values."""
        builder = ParamGridBuilder()
        for param, values in self.grid.items():
            builder = builder.addGrid(self.estimator.getParam(param), list(values))
        return builder.build()


def candidates(
    grids: Mapping[str, Mapping[str, Sequence[Any]]] = GRIDS,
    names: Collection[str] | None = None,
    *,
    label: str = LABEL,
    seed: int = SEED,
) -> list[Candidate]:
    """Candidates in catalogue order. Seeds are explicit: the default differs between processes."""
    chosen = []
    for name, grid in grids.items():
        if names is not None and name not in names:
            continue
        estimator = ESTIMATORS[name](labelCol=label, featuresCol="features")
        if estimator.hasParam("seed"):
            estimator.setParams(seed=seed)
        chosen.append(Candidate(name, estimator, grid))
    return chosen


def assembler(features: Sequence[str] = FEATURES) -> VectorAssembler:
    """Feature columns to one vector; a null or NaN feature is an error."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def stages(candidate: Candidate, features: Sequence[str] = FEATURES) -> Pipeline:
    return Pipeline(stages=[assembler(features), candidate.estimator])


def f1_evaluator(label: str = LABEL) -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol="prediction", metricName="f1"
    )
