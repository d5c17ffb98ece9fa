"""Fitted models with the settings they were trained under, and the table of runs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame, SparkSession

from upkeep.defaults import FEATURES, HORIZON_DAYS, KINDS, SUBSYSTEM
from upkeep.schemas import RUNS, SETTINGS
from upkeep.sources.paths import require
from upkeep.workspace import path_exists


@dataclass(frozen=True)
class Settings:
    """What the labels of a matrix mean, and the features that a model of it takes."""

    horizon: int = HORIZON_DAYS
    subsystem: str = str(SUBSYSTEM)
    kinds: Sequence[str] = KINDS
    features: Sequence[str] = FEATURES

    def save(self, spark: SparkSession, path: str) -> None:
        row = {**asdict(self), "kinds": list(self.kinds), "features": list(self.features)}
        spark.createDataFrame([row], SETTINGS).coalesce(1).write.mode("overwrite").json(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Settings:
        """The settings kept at ``path``; the default ones where nothing is kept."""
        if not path_exists(spark, path):
            return Settings()
        row = spark.read.schema(SETTINGS).json(path).first()
        return Settings(row["horizon"], row["subsystem"], tuple(row["kinds"]), tuple(row["features"]))


class TrainedPipeline(PipelineModel):
    """A fitted pipeline that knows its settings."""

    def __init__(self, stages: Sequence[Transformer], settings: Settings):
        super().__init__(list(stages))
        self.settings = settings


def settings_of(model: PipelineModel) -> Settings:
    """The settings of a model; the default ones for a pipeline that was fitted elsewhere."""
    return getattr(model, "settings", Settings())


def save_model(model: PipelineModel, path: str) -> str:
    """Save the stages and, beside them, the settings."""
    model.write().overwrite().save(path)
    settings_of(model).save(SparkSession.active(), f"{path}/settings")
    return path


def load_model(path: str) -> TrainedPipeline:
    spark = SparkSession.active()
    if not path_exists(spark, path):
        raise FileNotFoundError(f"{path} does not exist: run training first")
    return TrainedPipeline(PipelineModel.load(path).stages, Settings.load(spark, f"{path}/settings"))


def append_runs(spark: SparkSession, path: str, runs: Iterable[tuple]) -> None:
    """Append one row per trained model: parameters, metric and where the model is kept."""
    spark.createDataFrame(list(runs), RUNS).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return require(path, "training", lambda: spark.read.schema(RUNS).parquet(path))
