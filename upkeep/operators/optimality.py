"""Whether the coefficients of a linear classifier minimise its loss, by one aggregation.

Spark scales features by their standard deviation before it penalises coefficients, so the loss is
mean(loss of a row) + regParam / 2 * sum((coefficient * deviation) ** 2), the intercept apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LinearSVCModel, LogisticRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.defaults import FEATURES, LABEL

INTERCEPT = "intercept"


def linear_residuals(
    rows: DataFrame,
    model: LogisticRegressionModel | LinearSVCModel,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    edge: float = 0.01,
) -> DataFrame:
    """(term, residual, start): for each coefficient and the intercept how far zero is from the slope of the loss.

    The slope is taken per scaled coefficient; ``start`` is its size where all coefficients are
    zero. A logistic loss has one slope. The hinge loss has a bend at a margin of 1: rows that lie
    within ``edge`` of it may have any slope between none and their full one, which gives a range,
    and the residual is the distance of zero from that range. A row with a null feature or label
    does not count. Without rows all residuals are null.
    """
    values = {f: F.col(f).cast("double") for f in features} | {INTERCEPT: F.lit(1.0)}
    weights = dict(zip(features, map(float, model.coefficients)))
    margin = sum((values[f] * w for f, w in weights.items()), F.lit(float(model.intercept)))
    truth = F.col(label).cast("double")
    if isinstance(model, LinearSVCModel):
        sign = 2 * truth - 1
        inside = F.when(sign * margin < 1 - edge, 1.0).otherwise(0.0)
        bend = F.when(F.abs(sign * margin - 1) <= edge, 1.0).otherwise(0.0)
        slope, loose, start = -sign * inside, -sign * bend, -sign
    else:
        slope, loose, start = 1 / (1 + F.exp(-margin)) - truth, F.lit(0.0), 0.5 - truth

    def entry(name: str) -> Column:
        x = values[name]
        scale = F.lit(1.0) if name == INTERCEPT else F.stddev_samp(x)
        penalty = F.lit(0.0) if name == INTERCEPT else model.getOrDefault("regParam") * weights[name] * scale
        low = F.avg(slope * x + F.least(loose * x, F.lit(0.0))) / scale + penalty
        high = F.avg(slope * x + F.greatest(loose * x, F.lit(0.0))) / scale + penalty
        return F.struct(
            F.lit(name).alias("term"),
            F.when(low.isNotNull(), F.greatest(low, -high, F.lit(0.0))).alias("residual"),
            F.abs(F.avg(start * x) / scale).alias("start"),
        )

    known = rows.dropna(subset=[*features, label])
    return known.agg(F.array(*[entry(n) for n in values]).alias("terms")).select(F.inline("terms"))
