"""Model quality and ranking as plain aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_counts(
    predictions: DataFrame, *by: str, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Rows by label and prediction, per ``by``."""
    return (
        predictions.groupBy(
            *by, F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def weighted_f1(confusion: DataFrame, *by: str) -> DataFrame:
    """F1 per class, weighted by the class's share of labels, per ``by``.

    Every count enters once as support of its label and once as a prediction of its class, so
    one aggregation per class sees support, predictions and hits together.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("n").alias("support"),
            none.alias("predicted"),
            hit.cast("bigint").alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            none.alias("support"),
            F.col("n").alias("predicted"),
            none.alias("hits"),
        ),
    )
    classes = (
        confusion.select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    # 2PR/(P+R) = 2 hits / (support + predicted); a class in the data has support or predictions.
    f1 = 2.0 * F.col("hits") / (F.col("support") + F.col("predicted"))
    return classes.groupBy(*by).agg(
        (F.sum(F.col("support") * f1) / F.sum("support")).alias("f1")
    )


def rank(scores: DataFrame) -> DataFrame:
    """All scores, best first; equal scores keep catalogue order."""
    return scores.orderBy(F.desc("F1-Score"), "ordinal")


def preview(scores: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` scores of the ranking, to be shown."""
    return rank(scores).limit(limit)


def best(scores: DataFrame) -> DataFrame:
    """The best score above zero, the earliest of equals; no row if none is above zero."""
    return scores.where(F.col("F1-Score") > 0).orderBy(F.desc("F1-Score"), "ordinal").limit(1)
