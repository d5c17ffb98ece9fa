"""The matrix and feature rows at rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upkeep.sources.paths import require


def write_matrix(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    single_file: bool = False,
    partition_by: Sequence[str] = (),
) -> None:
    """Replace ``path`` by ``df``.

    ``single_file`` funnels all rows through one task: small data only. With ``partition_by`` rows
    are first brought together by those columns, so that not every task writes to every folder;
    adaptive execution splits a folder that holds very many.
    """
    out = df.hint("rebalance", *map(F.col, partition_by)) if partition_by else df
    out = out.coalesce(1) if single_file else out
    writer = out.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_matrix(
    spark: SparkSession, path: str, *, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Read a matrix back. CSV carries no types, so it needs the schema."""
    if fmt == "csv" and schema is None:
        raise ValueError("a CSV matrix needs its schema")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    return require(path, "the matrix build", lambda: reader.load(path))
