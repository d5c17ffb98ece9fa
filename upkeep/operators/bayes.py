"""Multinomial naive Bayes parameters by aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.defaults import FEATURES, LABEL


def naive_bayes_parameters(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    smoothing: float = 1.0,
) -> DataFrame:
    """Per label: ``pi``, the log prior, and ``theta_<feature>``, the log feature weights.

    The data is aggregated once, per label and with partial sums; the totals over labels come
    from a window over that result, which has one row per label.
    """
    sums = df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(c).cast("double")).alias(f"sum_{c}") for c in features],
    )
    all_labels = Window.partitionBy(F.lit(0))
    joined = sums.select(
        "*",
        F.sum("n").over(all_labels).alias("n_all"),
        F.count(F.lit(1)).over(all_labels).alias("labels"),
    )
    weight = sum((F.col(f"sum_{c}") for c in features), F.lit(0.0))
    pi = F.ln(F.col("n") + smoothing) - F.ln(F.col("n_all") + F.col("labels") * smoothing)
    thetas = [
        (F.ln(F.col(f"sum_{c}") + smoothing) - F.ln(weight + len(features) * smoothing)).alias(
            f"theta_{c}"
        )
        for c in features
    ]
    return joined.select(label, pi.alias("pi"), *thetas)
