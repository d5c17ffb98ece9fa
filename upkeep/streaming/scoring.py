"""Scoring of feature rows as they arrive."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from upkeep.plans.scoring import score, unscorable


def arriving_features(
    spark: SparkSession, folder: str, schema: T.StructType, *, files_per_batch: int = 1000
) -> DataFrame:
    """Feature rows from the Parquet files that land in ``folder``."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def score_stream(
    features: DataFrame,
    model: PipelineModel,
    sink: str,
    checkpoint: str,
    *,
    interval: str | None = None,
) -> StreamingQuery:
    """Append scored rows to ``sink``; every row once, also across restarts.

    Rows that the model cannot take are left out here and do not end the query, see
    ``reject_stream``.

    Scoring looks at one row at a time, so there is no state and no watermark. Without
    ``interval`` the query works off what has arrived and ends.
    """
    return _append(score(features, model), sink, checkpoint, interval)


def reject_stream(
    features: DataFrame,
    model: PipelineModel,
    sink: str,
    checkpoint: str,
    *,
    interval: str | None = None,
) -> StreamingQuery:
    """Append the rows that the model cannot take to ``sink``, each with the column at fault."""
    return _append(unscorable(features, model), sink, checkpoint, interval)


def score_and_reject_stream(
    features: DataFrame,
    model: PipelineModel,
    sink: str,
    rejects: str,
    checkpoint: str,
    *,
    interval: str | None = None,
) -> StreamingQuery:
    """One stream with two outputs: scored rows to ``sink``, rows the model cannot take to ``rejects``.

    Every batch is read once and split, so each row is in exactly one of the two. A batch writes a
    folder named by its number (column ``batch``) in each of them; one that is run again after a
    failure replaces what it has left there.
    """

    def split(batch: DataFrame, number: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for rows, path in ((score(batch, model), sink), (unscorable(batch, model), rejects)):
                rows.write.mode("overwrite").parquet(f"{path}/batch={number}")
        finally:
            batch.unpersist()

    return (
        features.writeStream.foreachBatch(split)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def _trigger(interval: str | None) -> dict:
    return {"processingTime": interval} if interval else {"availableNow": True}


def _append(rows: DataFrame, sink: str, checkpoint: str, interval: str | None) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**_trigger(interval))
        .start()
    )
