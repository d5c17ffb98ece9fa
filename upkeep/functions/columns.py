"""Column expressions shared by several plans."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upkeep.defaults import HORIZON_DAYS, SCALE, VERDICT_CLEAR, VERDICT_DUE


def rounded(df: DataFrame, columns: Collection[str], scale: int = SCALE) -> DataFrame:
    """Round the named columns, in one projection and keeping the column order."""
    return df.select(*[F.round(c, scale).alias(c) if c in columns else F.col(c) for c in df.columns])


def code_equals(df: DataFrame, column: str, code: int | str) -> Column:
    """``column = code`` whatever type the source gave the column.

    Codes in text may hold letters (``34AB``), which must not fail a comparison with a number.
    Give the code of a text column as text to have the filter pushed into the source.
    """
    is_text = isinstance(df.schema[column].dataType, T.StringType)
    if is_text and isinstance(code, int):
        return F.col(column).try_cast("bigint") == F.lit(code)
    return F.col(column) == F.lit(code)


def lead_days(start: Column, day: Column) -> Column:
    """Calendar days from ``day`` to ``start``."""
    return F.datediff(start, day)


def within_horizon(start: Column, day: Column, horizon: int) -> Column:
    """True if ``start`` is the day itself or one of the ``horizon - 1`` days after it."""
    return lead_days(start, day).between(0, horizon - 1)


def verdict(prediction: Column, horizon: int = HORIZON_DAYS) -> Column:
    """The prediction in words, for the horizon that the model was trained on; null stays null."""
    clear, due = (F.lit(text.format(days=horizon)) for text in (VERDICT_CLEAR, VERDICT_DUE))
    return F.when(prediction == 0, clear).when(prediction != 0, due)
