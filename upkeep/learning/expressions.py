"""Fitted trees and ensembles as Column expressions over plain feature columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from py4j.java_gateway import JavaObject
from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassificationModel, GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import Column
from pyspark.sql import functions as F

from upkeep.defaults import FEATURES


def tree_column(node: JavaObject, features: Sequence[Column], leaf: Callable[[JavaObject], float]) -> Column:
    """Nested conditions from ``node`` down, with a value of each leaf. Splits are those of numbers."""
    if node.numDescendants() == 0:
        return F.lit(float(leaf(node)))
    split = node.split()
    left, right = (tree_column(n, features, leaf) for n in (node.leftChild(), node.rightChild()))
    return F.when(features[split.featureIndex()] <= split.threshold(), left).otherwise(right)


def class_share(number: int) -> Callable[[JavaObject], float]:
    """The share of a class among the rows of a leaf."""

    def share(leaf: JavaObject) -> float:
        stats = list(leaf.impurityStats().stats())
        return stats[number] / sum(stats)

    return share


def _sum(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def prediction_column(model: Model, features: Sequence[str | Column] = FEATURES) -> Column:
    """What ``model`` predicts, without assembling vectors.

    A forest adds the class shares of its leaves, and the larger sum wins, the lower class of
    equals; a boosted model adds its trees' values by weight and says 1 above zero. Labels are 0
    and 1. The features must not be null.
    """
    columns = [F.col(f) if isinstance(f, str) else f for f in features]
    if isinstance(model, DecisionTreeClassificationModel):
        return tree_column(model._java_obj.rootNode(), columns, lambda leaf: leaf.prediction())
    if not isinstance(model, (RandomForestClassificationModel, GBTClassificationModel)):
        raise TypeError(f"{type(model).__name__} has no trees")
    roots = [tree._java_obj.rootNode() for tree in model.trees]
    if isinstance(model, RandomForestClassificationModel):
        votes = [_sum([tree_column(r, columns, class_share(c)) for r in roots]) for c in (0, 1)]
        return F.when(votes[1] > votes[0], 1.0).otherwise(0.0)
    values = [tree_column(r, columns, lambda leaf: leaf.prediction()) * w for r, w in zip(roots, model.treeWeights)]
    return F.when(_sum(values) > 0, 1.0).otherwise(0.0)
