"""Warehouse tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """How to cut a table read into parallel range queries.

    The bounds only set the stride: rows outside them, and nulls, are read by the edge ranges.
    """

    column: str
    lower: int | date | datetime
    upper: int | date | datetime
    partitions: int


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str],
    *,
    properties: Mapping[str, str],
    split: Split | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Scan ``table`` and keep ``columns``; projection and filters are pushed into the database.

    ``properties`` carries driver and credentials, and is never printed. Without ``split`` the
    whole table comes through one connection, so give one for any large table.
    """
    options = {"fetchsize": str(fetch_size), **properties}
    if split is None:
        frame = spark.read.jdbc(url, table, properties=options)
    else:
        frame = spark.read.jdbc(
            url,
            table,
            column=split.column,
            lowerBound=str(split.lower),
            upperBound=str(split.upper),
            numPartitions=split.partitions,
            properties=options,
        )
    return frame.select(*columns)
