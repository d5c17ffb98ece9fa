"""Grid search under cross-validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.defaults import FEATURES, FOLDS, LABEL
from upkeep.learning.catalogue import Candidate, assembler, f1_evaluator
from upkeep.schemas import GRID_SCORES

# Partitions of a training frame. Every iteration of a solver is a job over all of them: raise
# the number with the data, and count it among the settings that a model depends on.
PARTITIONS = 8


def vectors(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    *extra: str,
    partitions: int = PARTITIONS,
) -> DataFrame:
    """Feature vector, label and ``extra`` columns, laid out by the rows' values alone.

    Solvers that draw or add up rows depend on the layout. Here it follows from the rows and
    ``partitions``, not from files, cores or session settings.
    """
    columns = [*features, label, *extra]
    rows = df.select(*columns).repartition(partitions, F.xxhash64(*columns)).sortWithinPartitions(*columns)
    return assembler(features).transform(rows).select("features", label, *extra)


def assembled(model: Model, features: Sequence[str] = FEATURES) -> PipelineModel:
    """A fitted classifier behind its vector assembly, so that it takes plain feature rows."""
    return PipelineModel(stages=[assembler(features), model])


def search(
    candidate: Candidate,
    train: DataFrame,
    *,
    label: str = LABEL,
    folds: int = FOLDS,
    parallelism: int = 4,
    fold_column: str = "fold",
) -> CrossValidatorModel:
    """Try every grid point on ``folds`` folds and refit the best on all of ``train``.

    ``train`` holds vectors, see ``vectors``: they are assembled once, not in each fit. Folds are
    read from ``fold_column``; nothing of them is copied, so searches that run at once share the
    caller's cached ``train``. ``parallelism`` fits run at once, over all points and folds.
    """
    points, evaluator = candidate.param_maps(), f1_evaluator(label)
    present = {r[0] for r in train.select(fold_column).distinct().collect()}
    for fold in range(folds):
        if fold not in present or present == {fold}:
            raise ValueError(f"the rows of fold {fold}, or those beside it, are empty")

    def tried(task: tuple[int, int]) -> float:
        point, fold = task
        held = F.col(fold_column) == fold
        model = candidate.estimator.fit(train.where(~held), points[point])
        return evaluator.evaluate(model.transform(train.where(held)))

    tasks = [(point, fold) for point in range(len(points)) for fold in range(folds)]
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        scores = pool.map(inheritable_thread_target(train.sparkSession)(tried), tasks, chunksize=1)
    means = [sum(scores[k * folds : (k + 1) * folds]) / folds for k in range(len(points))]
    best = max(range(len(points)), key=means.__getitem__)  # the first of equals
    return CrossValidatorModel(candidate.estimator.fit(train, points[best]), avgMetrics=means)


def as_text(params: Mapping) -> dict[str, str]:
    return {param.name: str(value) for param, value in params.items()}


def grid_scores(
    spark: SparkSession, found: Sequence[tuple[Candidate, CrossValidatorModel]]
) -> DataFrame:
    """Mean F1 over the folds for every grid point tried."""
    rows = [
        (candidate.name, point, as_text(params), float(metric))
        for candidate, model in found
        for point, (params, metric) in enumerate(zip(candidate.param_maps(), model.avgMetrics))
    ]
    return spark.createDataFrame(rows, GRID_SCORES)


def model_name(model: PipelineModel) -> str:
    """Class of the fitted classifier, taken from the identifier of its stage."""
    return model.stages[-1].uid.split("_")[0]
