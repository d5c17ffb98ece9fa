"""The best split of labelled rows by one feature, exactly: prefix sums over its sorted values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upkeep.defaults import LABEL


def gini(zeros: Column, ones: Column) -> Column:
    total = zeros + ones
    return 1 - (zeros / total) * (zeros / total) - (ones / total) * (ones / total)


def split_gains(df: DataFrame, features: Sequence[str], label: str = LABEL) -> DataFrame:
    """(feature, threshold, gain, left_0, left_1, right_0, right_1) for every place between two values.

    Thresholds lie half-way between neighbouring values. Rows are counted by value before they are
    shuffled, so a task sorts the distinct values of a feature and no rows. It suits features with
    few values, such as counts; a null value is left out.
    """
    value = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]))
    rows = df.select(value.alias("v"), F.col(label).cast("int").alias("label")).select("v.*", "label")
    ones, zeros = F.count_if(F.col("label") == 1).alias("ones"), F.count_if(F.col("label") == 0).alias("zeros")
    values = rows.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(zeros, ones)
    upto = Window.partitionBy("feature").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("feature").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = values.select(
        "feature",
        ((F.col("value") + F.lead("value").over(Window.partitionBy("feature").orderBy("value"))) / 2).alias("threshold"),
        F.sum("zeros").over(upto).alias("left_0"),
        F.sum("ones").over(upto).alias("left_1"),
        F.sum("zeros").over(whole).alias("all_0"),
        F.sum("ones").over(whole).alias("all_1"),
    ).where(F.col("threshold").isNotNull())
    sums = sums.withColumns({"right_0": F.col("all_0") - F.col("left_0"), "right_1": F.col("all_1") - F.col("left_1")})
    share = (F.col("left_0") + F.col("left_1")) / (F.col("all_0") + F.col("all_1"))
    left, right = gini(F.col("left_0"), F.col("left_1")), gini(F.col("right_0"), F.col("right_1"))
    gain = gini(F.col("all_0"), F.col("all_1")) - share * left - (1 - share) * right
    return sums.select("feature", "threshold", gain.alias("gain"), "left_0", "left_1", "right_0", "right_1")


def best_split(df: DataFrame, features: Sequence[str], label: str = LABEL) -> DataFrame:
    """The split of the highest gain; of equals the first feature and the lowest threshold. No row without a split."""
    place = F.array_position(F.lit(list(features)), F.col("feature"))
    return split_gains(df, features, label).orderBy(F.desc("gain"), place, "threshold").limit(1)
