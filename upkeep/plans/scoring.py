"""Scoring: feature rows in, predictions and verdicts out, in one lazy plan."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upkeep.defaults import KEYS
from upkeep.functions.columns import verdict
from upkeep.learning.search import model_name
from upkeep.sources.models import settings_of

# Classifiers that take no negative features.
NON_NEGATIVE = ("NaiveBayes",)


def problem(df: DataFrame, model: PipelineModel) -> Column:
    """Why the model cannot take a row, with the first column at fault; null if it can."""
    found = F.lit(None).cast("string")
    for name in reversed(settings_of(model).features):
        c = F.col(name)
        if model_name(model) in NON_NEGATIVE:
            found = F.when(c < 0, F.lit(f"column {name} is negative")).otherwise(found)
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            found = F.when(F.isnan(c), F.lit(f"column {name} is NaN")).otherwise(found)
        found = F.when(c.isNull(), F.lit(f"column {name} is null")).otherwise(found)
    return found


def unscorable(features: DataFrame, model: PipelineModel) -> DataFrame:
    """The rows that ``score`` leaves out: keys, features and the problem. Also for a stream of rows."""
    rows = features.select(*KEYS, *settings_of(model).features, problem(features, model).alias("problem"))
    return rows.where(F.col("problem").isNotNull())


def score(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Keys, features, model name, prediction and verdict, for a batch or a stream of rows.

    A row that the model cannot take does not end the job: it is left to ``unscorable``.
    The verdict names the horizon that the model was trained on, see ``Settings``.
    """
    settings = settings_of(model)
    rows = features.where(problem(features, model).isNull())
    return model.transform(rows).select(
        *KEYS,
        *settings.features,
        F.lit(model_name(model)).alias("model_name"),
        "prediction",
        verdict(F.col("prediction"), settings.horizon).alias("verdict"),
    )
