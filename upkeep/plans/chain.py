"""The steps as they run one after another, each reading what the one before has stored."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from upkeep.defaults import HORIZON_DAYS, KINDS, SUBSYSTEM
from upkeep.learning.catalogue import Candidate
from upkeep.plans.matrix import build_features, build_matrix
from upkeep.plans.scoring import score
from upkeep.plans.training import Ranking, train_and_rank
from upkeep.sources.matrix import read_matrix, write_matrix
from upkeep.sources.models import Settings, load_model

# Where each step leaves its result, below the caller's folder.
MATRIX = "training_data"
SETTINGS = "training_settings"
TO_PREDICT = "tuple_to_predict"
BEST_MODEL = "best_model"


def store_matrix(
    readings: DataFrame,
    utilization: DataFrame,
    interruptions: DataFrame,
    folder: str,
    *,
    fmt: str = "parquet",
    **options,
) -> T.StructType:
    """First step: build the labelled matrix and store it, with what its labels mean."""
    matrix = build_matrix(readings, utilization, interruptions, **options)
    write_matrix(matrix, f"{folder}/{MATRIX}", fmt=fmt)
    chosen = {"horizon": HORIZON_DAYS, "subsystem": SUBSYSTEM, "kinds": KINDS} | options
    settings = Settings(chosen["horizon"], str(chosen["subsystem"]), tuple(chosen["kinds"]))
    settings.save(readings.sparkSession, f"{folder}/{SETTINGS}")
    return matrix.schema


def train_stored(
    spark: SparkSession,
    folder: str,
    catalogue: Sequence[Candidate] | None = None,
    *,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    **options,
) -> Ranking:
    """Second step: train on the stored matrix; keep every model, and the best as ``best_model``."""
    matrix = read_matrix(spark, f"{folder}/{MATRIX}", fmt=fmt, schema=schema)
    settings = Settings.load(spark, f"{folder}/{SETTINGS}")
    return train_and_rank(matrix, catalogue, stored=True, models_path=folder, settings=settings, **options)


def store_rows_to_score(
    readings: DataFrame, utilization: DataFrame, folder: str, *, fmt: str = "parquet", **keys
) -> None:
    """Store the feature rows of one asset and day, or of a request table."""
    write_matrix(build_features(readings, utilization, **keys), f"{folder}/{TO_PREDICT}", fmt=fmt)


def score_stored(
    spark: SparkSession, folder: str, *, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Score stored rows with the best model."""
    rows = read_matrix(spark, f"{folder}/{TO_PREDICT}", fmt=fmt, schema=schema)
    return score(rows, load_model(f"{folder}/{BEST_MODEL}"))


def score_requests(
    readings: DataFrame, utilization: DataFrame, model_path: str, **keys
) -> DataFrame:
    """Third step: build the rows of one asset and day, or of a request table, and score them."""
    model = load_model(model_path)
    return score(build_features(readings, utilization, **keys), model)


def run_all(
    readings: DataFrame,
    utilization: DataFrame,
    interruptions: DataFrame,
    folder: str,
    catalogue: Sequence[Candidate] | None = None,
    *,
    matrix_options: Mapping | None = None,
    training_options: Mapping | None = None,
    **keys,
) -> DataFrame:
    """All steps: store the matrix, train on it, and score one asset and day or a request table."""
    schema = store_matrix(readings, utilization, interruptions, folder, **(matrix_options or {}))
    ranking = train_stored(
        readings.sparkSession, folder, catalogue, schema=schema, **(training_options or {})
    )
    if ranking.best_name is None:
        raise ValueError("no model scored above zero on the validation rows")
    return score_requests(readings, utilization, f"{folder}/{BEST_MODEL}", **keys)
