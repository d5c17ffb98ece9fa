"""Checks of a matrix before it is trained on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upkeep.defaults import FEATURES, LABEL


def feature_validity(
    df: DataFrame, features: Sequence[str] = FEATURES, label: str | None = LABEL
) -> DataFrame:
    """One row per column: rows, nulls, NaNs, negatives, and labels other than 0 and 1.

    A single aggregation over the data; its one row is then laid out by column.
    """
    names = [*features, *([label] if label else [])]
    measures = [F.count(F.lit(1)).alias("n_rows")]
    for name in names:
        c = F.col(name)
        fractional = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
        nan = F.isnan(c) if fractional else F.lit(False)
        off = ~c.isin(0, 1) if name == label else F.lit(False)
        measures += [
            F.count_if(c.isNull()).alias(f"{name}|nulls"),
            F.count_if(nan).alias(f"{name}|nans"),
            F.count_if(c < 0).alias(f"{name}|negatives"),
            F.count_if(off).alias(f"{name}|off_domain"),
        ]
    totals = df.agg(*measures)
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("column_name"),
                        F.col("n_rows"),
                        *[
                            F.col(f"`{name}|{m}`").alias(m)
                            for m in ("nulls", "nans", "negatives", "off_domain")
                        ],
                    )
                    for name in names
                ]
            )
        )
    )


def require_trainable(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    non_negative: bool = True,
) -> int:
    """Raise an error that names the first column no model could be trained on; return the rows."""
    report = feature_validity(df, features, label).collect()  # one row per column
    for row in report:
        if row.n_rows == 0:
            raise ValueError("the matrix is empty")
        if row.nulls:
            raise ValueError(f"column {row.column_name} has {row.nulls} nulls")
        if row.nans:
            raise ValueError(f"column {row.column_name} has {row.nans} NaNs")
        if row.off_domain:
            raise ValueError(f"column {row.column_name} has {row.off_domain} values other than 0 and 1")
        if non_negative and row.negatives:
            raise ValueError(f"column {row.column_name} has {row.negatives} negative values")
    return report[0].n_rows
