"""Training: search every candidate, rank by weighted F1 on the validation rows, keep the best."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame

from upkeep.defaults import FEATURES, FOLDS, LABEL, RUN_NAME, SEED
from upkeep.learning.catalogue import Candidate, candidates, f1_evaluator
from upkeep.learning.search import PARTITIONS, as_text, assembled, grid_scores, search, vectors
from upkeep.operators.metrics import best, rank
from upkeep.operators.splits import split_and_fold, split_keys, with_key_fold
from upkeep.operators.validity import require_trainable
from upkeep.schemas import MODEL_SCORES
from upkeep.sources.models import Settings, TrainedPipeline, append_runs, save_model
from upkeep.workspace import discard, stabilise


@dataclass(frozen=True)
class Ranking:
    """What training leaves behind."""

    scores: DataFrame
    grid_scores: DataFrame
    models: dict[str, TrainedPipeline]
    best_name: str | None

    @property
    def best_model(self) -> TrainedPipeline | None:
        return self.models[self.best_name] if self.best_name is not None else None

    @property
    def leaderboard(self) -> DataFrame:
        return rank(self.scores).select("Model", "F1-Score")


def train_and_rank(
    matrix: DataFrame,
    catalogue: Sequence[Candidate] | None = None,
    *,
    features: Sequence[str] = FEATURES,
    folds: int = FOLDS,
    seed: int = SEED,
    parallelism: int = 4,
    concurrent: int = 3,
    by_key: bool = False,
    stored: bool = False,
    models_path: str | None = None,
    runs_path: str | None = None,
    run_name: str = RUN_NAME,
    partitions: int = PARTITIONS,
    settings: Settings | None = None,
) -> Ranking:
    """Train and rank ``catalogue`` (all six classifiers on their full grids by default).

    ``by_key`` splits rows and folds by asset-day, so that copies of a row never lie on both
    sides. ``concurrent`` classifiers are searched at once, and ``parallelism`` fits of each; the
    rows are cached once for all of them. ``partitions`` is how
    many the rows are trained in. ``stored`` says that ``matrix`` is read straight from files; any
    other matrix is computed once, into shared storage, and removed after the training.

    ``settings`` say how the matrix was labelled; every model carries them, with its features.
    With ``models_path`` every model is saved under its name, and the best as ``best_model``.
    """
    spark = matrix.sparkSession
    settings = replace(settings or Settings(), features=tuple(features))
    catalogue = candidates(seed=seed) if catalogue is None else list(catalogue)
    needs_non_negative = any(c.name == "Naive Bayes" for c in catalogue)

    matrix = matrix if stored else stabilise(matrix)
    require_trainable(matrix, features, LABEL, needs_non_negative)

    if by_key:
        train, validation = split_keys(with_key_fold(matrix, folds))
    else:
        drawn = stabilise(split_and_fold(matrix, folds, seed=seed))
        train, validation = drawn.where("in_train"), drawn.where("not in_train")
    train = vectors(train, features, LABEL, "fold", partitions=partitions).persist(StorageLevel.MEMORY_AND_DISK)
    validation = vectors(validation, features, LABEL, partitions=partitions).persist(StorageLevel.MEMORY_AND_DISK)

    evaluator = f1_evaluator()

    def try_candidate(candidate: Candidate) -> tuple[CrossValidatorModel, TrainedPipeline, float, str | None]:
        searched = search(candidate, train, folds=folds, parallelism=parallelism)
        f1 = evaluator.evaluate(searched.bestModel.transform(validation))
        model = TrainedPipeline(assembled(searched.bestModel, features).stages, settings)
        path = f"{models_path}/{candidate.name}" if models_path else None
        return searched, model, f1, save_model(model, path) if path else None

    try:
        with ThreadPool(max(min(concurrent, len(catalogue)), 1)) as pool:
            tried = pool.map(inheritable_thread_target(spark)(try_candidate), catalogue, chunksize=1)
    finally:
        train.unpersist()
        validation.unpersist()
        if not by_key:
            discard(drawn)
        if not stored:
            discard(matrix)

    found, models, scores, runs = [], {}, [], []
    run_id = uuid.uuid4().hex
    for ordinal, (candidate, (searched, model, f1, path)) in enumerate(zip(catalogue, tried)):
        found.append((candidate, searched))
        models[candidate.name] = model
        scores.append((ordinal, candidate.name, f1))
        params = as_text(searched.bestModel.extractParamMap())
        runs.append((run_id, run_name, candidate.name, params, "F1-Score", f1, path))

    score_table = spark.createDataFrame(scores, MODEL_SCORES)
    first = best(score_table).first()
    best_name = first["Model"] if first is not None else None
    if models_path and best_name is not None:
        save_model(models[best_name], f"{models_path}/best_model")
    if runs_path:
        append_runs(spark, runs_path, runs)
    return Ranking(score_table, grid_scores(spark, found), models, best_name)
