"""One query per operator, each over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.functions import vector_to_array

from upkeep import schemas
from upkeep.defaults import FEATURES, FOLDS, KEYS, LABEL, SMALL_GRIDS
from upkeep.functions.columns import rounded
from upkeep.functions.columns import verdict as verdict_text
from upkeep.learning.catalogue import assembler, candidates, f1_evaluator, stages
from upkeep.learning.expressions import prediction_column
from upkeep.learning.search import grid_scores, search, vectors
from upkeep.operators import metrics
from upkeep.operators.bayes import naive_bayes_parameters
from upkeep.operators.daily import daily_means, daily_readings, join_utilization
from upkeep.operators.labels import lead_day_counts, qualifying
from upkeep.operators.optimality import linear_residuals
from upkeep.operators.splitpoints import best_split
from upkeep.operators.splits import split_keys, split_rows, with_key_fold, with_row_fold
from upkeep.operators.validity import feature_validity as validity_report
from upkeep.operators.validity import require_trainable
from upkeep.plans.chain import run_all, score_requests
from upkeep.plans.matrix import build_features, build_matrix
from upkeep.plans.matrix import unmatched_requests as without_features
from upkeep.plans.scoring import score, unscorable
from upkeep.plans.training import train_and_rank
from upkeep.registry import standins
from upkeep.sources.matrix import read_matrix, write_matrix
from upkeep.sources.models import Settings, TrainedPipeline, load_model, read_runs, save_model
from upkeep.sources.readings import read_readings, write_readings
from upkeep.streaming.scoring import arriving_features, score_and_reject_stream, score_stream as start_scoring
from upkeep.workspace import scratch, stabilise

EXACT = 9  # decimals compared of computed doubles
ID_LENGTH = 20  # digits of the asset ids in file names: every bigint fits
NO_ID = "-" * ID_LENGTH  # in the name of the file of readings without an asset
EXPORT_FOLDERS = 512  # that the files are dealt to, so that several tasks list them

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    _queries[function.__name__] = function
    return function


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def _features(events: DataFrame, **how) -> DataFrame:
    return build_features(standins.readings(events), standins.utilization(events), **how)


def _matrix(events: DataFrame, **how) -> DataFrame:
    return build_matrix(
        standins.readings(events),
        standins.utilization(events),
        standins.interruptions(events),
        subsystem=standins.SUBSYSTEM,
        kinds=standins.KINDS,
        **how,
    )


def _supplier_matrix(spark: SparkSession, folder: str, **how) -> DataFrame:
    lines = standins.lineitem(spark, folder)
    return build_matrix(
        standins.supplier_readings(lines),
        standins.supplier_utilization(lines),
        standins.supplier_interruptions(lines),
        subsystem=standins.SUPPLIER_SUBSYSTEM,
        kinds=standins.SUPPLIER_KINDS,
        **how,
    )


def _rules(matrix: DataFrame) -> DataFrame:
    """Predictions of three fixed rules, in long form: one pass over the matrix scores them all."""
    rules = [
        ("Cycles", F.col("flightcycles") > 3),
        ("Delay", F.col("delayedminutes") > 0),
        ("Sensor", F.col("sensor_mean_value") > 50),
    ]
    return matrix.select(
        LABEL,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("ordinal"),
                        F.lit(name).alias("Model"),
                        rule.cast("int").alias("prediction"),
                    )
                    for i, (name, rule) in enumerate(rules)
                ]
            )
        ),
    )


def _rule_scores(matrix: DataFrame) -> DataFrame:
    confusion = metrics.confusion_counts(_rules(matrix), "ordinal", "Model")
    scores = metrics.weighted_f1(confusion, "ordinal", "Model")
    return scores.select("ordinal", "Model", F.round("f1", EXACT).alias("F1-Score"))


# Scans, projections, filters


@query
def scan_project(spark, folder):
    return standins.interruptions(standins.events(spark, folder))


@query
def daily_date(spark, folder):
    return daily_readings(standins.readings(standins.events(spark, folder)))


@query
def drop_project(spark, folder):
    return _matrix(standins.events(spark, folder)).drop(*KEYS)


@query
def filter_interruptions(spark, folder):
    events = standins.interruptions(standins.events(spark, folder))
    return qualifying(events, standins.SUBSYSTEM, standins.KINDS)


def _exported(spark, folder) -> DataFrame:
    """The readings as files that carry the asset in their names, read back by the reader."""
    out = scratch(spark, "readings-csv")
    readings = standins.readings(standins.events(spark, folder))
    asset = F.coalesce(F.lpad(F.col("aircraftid").cast("string"), ID_LENGTH, "0"), F.lit(NO_ID))
    name = F.concat(F.pmod(F.xxhash64(asset), F.lit(EXPORT_FOLDERS)), F.lit("/010124-AAA-BBB-0001-"), asset, F.lit(".csv"))
    write_readings(readings.withColumn("file", name).drop("aircraftid"), out)
    read = read_readings(spark, out, id_length=ID_LENGTH, recursive=True)
    return read.withColumn("aircraftid", F.nullif("aircraftid", F.lit(NO_ID)))


@query
def key_from_path(spark, folder):
    return _exported(spark, folder).groupBy("aircraftid").agg(F.count(F.lit(1)).alias("n"))


@query
def round_columns(spark, folder):
    events = standins.events(spark, folder)
    used = standins.utilization(events)
    return rounded(used, ("flighthours", "delayedminutes", "flightcycles"))


@query
def csv_scan_roundtrip(spark, folder):
    read = _exported(spark, folder)
    return daily_readings(read).withColumn("aircraftid", F.col("aircraftid").cast("bigint"))


@query
def matrix_roundtrip(spark, folder):
    as_csv, as_parquet = scratch(spark, "matrix-csv"), scratch(spark, "matrix-parquet")
    schema = schemas.matrix(T.LongType())
    write_matrix(_matrix(standins.events(spark, folder)), as_parquet)
    write_matrix(read_matrix(spark, as_parquet, schema=schema), as_csv, fmt="csv")
    return read_matrix(spark, as_csv, fmt="csv", schema=schema)


# Aggregation, joins, labels


@query
def daily_mean(spark, folder):
    means = daily_means(standins.readings(standins.events(spark, folder)))
    return rounded(means, ("sensor_mean_value",), EXACT)


@query
def sensor_util_join(spark, folder):
    events = standins.events(spark, folder)
    joined = join_utilization(daily_means(standins.readings(events)), standins.utilization(events))
    return rounded(joined, FEATURES, EXACT)


@query
def forward_label_matrix(spark, folder):
    return _matrix(standins.events(spark, folder), by_interval=True)


@query
def forward_label_matrix_expanded(spark, folder):
    return _matrix(standins.events(spark, folder))


@query
def dedup_label_matrix(spark, folder):
    return _matrix(standins.events(spark, folder), dedupe=True)


@query
def supplier_label_matrix(spark, folder):
    return _supplier_matrix(spark, folder)


@query
def supplier_label_matrix_interval(spark, folder):
    return _supplier_matrix(spark, folder, horizon=90, by_interval=True)


@query
def supplier_label_matrix_interval_dedup(spark, folder):
    return _supplier_matrix(spark, folder, horizon=90, by_interval=True, dedupe=True)


@query
def lead_days(spark, folder):
    events = standins.events(spark, folder)
    intr = qualifying(standins.interruptions(events), standins.SUBSYSTEM, standins.KINDS)
    return lead_day_counts(_features(events), intr)


@query
def feature_validity(spark, folder):
    return validity_report(_matrix(standins.events(spark, folder)))


# Requests


@query
def point_lookup(spark, folder):
    return _features(standins.events(spark, folder), aircraftid=7, date="2024-01-09")


@query
def request_features(spark, folder):
    events = standins.events(spark, folder)
    return _features(events, requests=standins.requests(events))


@query
def unmatched_requests(spark, folder):
    events = standins.events(spark, folder)
    requests = standins.requests(events)
    return without_features(requests, _features(events, requests=requests))


@query
def verdict(spark, folder):
    matrix = _matrix(standins.events(spark, folder))
    rule = (F.col("flightcycles") > 3).cast("double")
    return matrix.select(*KEYS, LABEL, verdict_text(rule).alias("verdict"))


@query
def verdict_horizon(spark, folder):
    # No cycles to speak of: no prediction, and no verdict.
    matrix = _matrix(standins.events(spark, folder), horizon=30, dedupe=True)
    rule = F.when(F.col("flightcycles") > 1, (F.col("flightcycles") > 3).cast("double"))
    return matrix.select(*KEYS, LABEL, verdict_text(rule, 30).alias("verdict"))


# Metrics and ranking


@query
def confusion_counts(spark, folder):
    rules = _rules(_matrix(standins.events(spark, folder)))
    return metrics.confusion_counts(rules, "Model")


@query
def weighted_f1(spark, folder):
    return _rule_scores(_matrix(standins.events(spark, folder))).drop("ordinal")


@query
def union_scores(spark, folder):
    scores = _rule_scores(_matrix(standins.events(spark, folder)))
    deduped = _rule_scores(_matrix(standins.events(spark, folder), dedupe=True))
    return scores.withColumn("source", F.lit("matrix")).unionByName(
        deduped.withColumn("source", F.lit("deduped"))
    )


@query
def rank_scores(spark, folder):
    return metrics.rank(_rule_scores(_matrix(standins.events(spark, folder))))


@query
def preview_scores(spark, folder):
    return metrics.preview(_rule_scores(_matrix(standins.events(spark, folder))), 2)


@query
def best_model_rule(spark, folder):
    return metrics.best(_rule_scores(_matrix(standins.events(spark, folder))))


# Features and splits


@query
def assemble_features(spark, folder):
    vectors = assembler().transform(_matrix(standins.events(spark, folder)))
    values = vector_to_array("features")
    return vectors.select(
        *KEYS, *[values[i].alias(f"feature_{i}") for i in range(len(FEATURES))], LABEL
    )


def _part_counts(train: DataFrame, validation: DataFrame) -> DataFrame:
    parts = train.withColumn("part", F.lit("train")).unionByName(
        validation.withColumn("part", F.lit("validation"))
    )
    return parts.groupBy("part", LABEL).agg(F.count(F.lit(1)).alias("n"))


@query
def random_split_counts(spark, folder):
    return _part_counts(*split_rows(_matrix(standins.events(spark, folder))))


@query
def row_fold_counts(spark, folder):
    folded = with_row_fold(_matrix(standins.events(spark, folder)), FOLDS)
    return folded.groupBy("fold", LABEL).agg(F.count(F.lit(1)).alias("n"))


@query
def hash_split_counts(spark, folder):
    return _part_counts(*split_keys(_matrix(standins.events(spark, folder))))


# Classifiers


def _parts(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Train and validation rows of the stored matrix, split by key."""
    matrix = stabilise(_matrix(standins.events(spark, folder)))
    require_trainable(matrix)
    return split_keys(matrix)


def _fitted(spark, folder, name) -> tuple[Model, DataFrame, DataFrame, list[tuple[int, int]]]:
    """A classifier at one point of its grid: the model, train and validation rows, and the rows it has seen."""
    train, validation = _parts(spark, folder)
    (candidate,) = candidates(SMALL_GRIDS, [name])
    rows = vectors(train).cache()
    try:
        model = candidate.estimator.fit(rows, candidate.param_maps()[0])
        seen = _rows_seen(model, rows)
    finally:
        rows.unpersist()
    return model, train, validation, seen


def _rows_seen(model: Model, train: DataFrame) -> list[tuple[int, int]]:
    """Train rows by label, from the fitted model where it keeps them."""
    if isinstance(model, DecisionTreeClassificationModel):
        nodes, totals = [model._java_obj.rootNode()], [0.0, 0.0]
        while nodes:
            node = nodes.pop()
            if node.numDescendants() == 0:
                totals = [a + b for a, b in zip(totals, node.impurityStats().stats())]
            else:
                nodes += [node.leftChild(), node.rightChild()]
        return [(label, int(n)) for label, n in enumerate(totals)]
    rows = train
    if getattr(model, "hasSummary", False):
        summary = model.summary() if callable(model.summary) else model.summary
        rows = summary.predictions
    return [(int(r[0]), r[1]) for r in rows.groupBy(LABEL).count().collect()]


def _classifier(name):
    """By label: rows the model was fitted on, validation rows and those with a prediction.

    ``f1_equal`` tells whether the aggregation and Spark's evaluator agree on the predictions.
    ``as_expression`` tells of a model with trees whether its trees, written as one expression,
    predict the same for every validation row, and ``optimal`` of a linear model whether the slopes
    of its loss at the fitted coefficients are below a thousandth of the steepest one at zero.
    """

    def run(spark, folder):
        model, train, validation, seen = _fitted(spark, folder, name)
        predictions, check = model.transform(vectors(validation)), F.bool_and(F.col("expressed") == F.col("prediction"))
        expressed = F.lit(None).cast("double")
        if name in TREES:
            values = vector_to_array("features")
            expressed = prediction_column(model, [values[i] for i in range(len(FEATURES))])
        else:
            slopes = linear_residuals(train, model, edge=0.01).agg(F.max("residual"), F.max("start")).first()
            check = F.lit(slopes[0] <= 1e-3 * slopes[1])
        predictions = stabilise(predictions.select(LABEL, "prediction", expressed.alias("expressed")))
        f1 = metrics.weighted_f1(metrics.confusion_counts(predictions)).first().f1
        equal = abs(f1 - f1_evaluator().evaluate(predictions)) < 1e-9
        scored = F.count_if(F.col("prediction").isin(0.0, 1.0))
        counts = predictions.groupBy(LABEL).agg(
            F.count(F.lit(1)).alias("validation_rows"),
            scored.alias("scored_rows"),
            check.alias("as_expression" if name in TREES else "optimal"),
        )
        trained = spark.createDataFrame(seen, f"{LABEL} int, train_rows long")
        return trained.join(counts, LABEL, "full").select(
            F.lit(name).alias("Model"), LABEL, "train_rows", "validation_rows", "scored_rows", F.lit(equal).alias("f1_equal"), counts.columns[-1]
        )

    return run


TREES = ("Decision Tree", "Random Forest", "Gradient-Boosted Trees")

for _key, _name in {
    "clf_decision_tree": "Decision Tree",
    "clf_random_forest": "Random Forest",
    "clf_logistic": "Logistic Regression",
    "clf_gbt": "Gradient-Boosted Trees",
    "clf_linear_svc": "Linear SVC",
}.items():
    _queries[_key] = _classifier(_name)


@query
def tree_root_split(spark, folder):
    # Does a count of cycles tell of a delay? A tree of depth 1: threshold, leaves, and whether the exact search agrees.
    matrix = _matrix(standins.events(spark, folder)).withColumn(LABEL, (F.col("delayedminutes") > 0).cast("int"))
    matrix = stabilise(matrix)
    (candidate,) = candidates(SMALL_GRIDS, ["Decision Tree"])
    tree = candidate.estimator.copy({candidate.estimator.maxDepth: 1, candidate.estimator.maxBins: 1024})
    root = tree.fit(vectors(matrix, ["flightcycles"]))._java_obj.rootNode()
    leaves = [[int(n) for n in node.impurityStats().stats()] for node in (root.leftChild(), root.rightChild())]
    names = ["threshold", "gain", "left_0", "left_1", "right_0", "right_1"]
    fitted = [(float(root.split().threshold()), round(float(root.gain()), EXACT), *leaves[0], *leaves[1])]
    model = spark.createDataFrame(fitted, "threshold double, gain double, left_0 long, left_1 long, right_0 long, right_1 long")
    exact = best_split(matrix, ["flightcycles"]).select("threshold", F.round("gain", EXACT).alias("gain"), *names[2:])
    same = exact.select(*[F.col(c).alias(f"exact_{c}") for c in names])
    agrees = F.forall(F.array(*[F.col(c) == F.col(f"exact_{c}") for c in names]), lambda x: x)
    return model.join(same, model["threshold"] == same["exact_threshold"], "left").select(
        *names, F.coalesce(agrees, F.lit(False)).alias("exact_agrees")
    )


@query
def clf_naive_bayes(spark, folder):
    model, _, validation, _ = _fitted(spark, folder, "Naive Bayes")
    return metrics.confusion_counts(model.transform(vectors(validation))).select(
        F.lit("Naive Bayes").alias("Model"), "label", "prediction", "n"
    )


@query
def naive_bayes_params(spark, folder):
    params = naive_bayes_parameters(_matrix(standins.events(spark, folder)))
    return rounded(params, [c for c in params.columns if c != LABEL], EXACT)


@query
def cv_scores(spark, folder):
    train, _ = _parts(spark, folder)
    train = vectors(with_key_fold(train, 3), FEATURES, LABEL, "fold").cache()
    try:
        (candidate,) = candidates(names=["Naive Bayes"])
        found = search(candidate, train)
    finally:
        train.unpersist()
    return grid_scores(spark, [(candidate, found)]).select(
        "Model", "point", F.to_json("params").alias("params"), F.round("mean_f1", EXACT).alias("mean_f1")
    )


@query
def leaderboard(spark, folder):
    matrix = _matrix(standins.events(spark, folder))
    return train_and_rank(matrix, candidates(SMALL_GRIDS), concurrent=6).leaderboard


@query
def leaderboard_order(spark, folder):
    # One row per classifier; SQL knows the score of naive Bayes, and that scores never rise.
    matrix = _matrix(standins.events(spark, folder))
    board = train_and_rank(matrix, candidates(SMALL_GRIDS), concurrent=6, by_key=True).leaderboard.collect()
    scores = [r["F1-Score"] for r in board]
    rows = [
        (r["Model"], round(r["F1-Score"], EXACT) if r["Model"] == "Naive Bayes" else None, k == 0 or scores[k - 1] >= scores[k])
        for k, r in enumerate(board)
    ]
    return spark.createDataFrame(rows, "Model string, known_score double, in_order boolean")


def _saved_bayes(spark, folder, settings: Settings = Settings()) -> str:
    train, _ = _parts(spark, folder)
    (candidate,) = candidates(SMALL_GRIDS, ["Naive Bayes"])
    fitted = TrainedPipeline(stages(candidate).fit(train).stages, settings)
    return save_model(fitted, scratch(spark, "model"))


def _broken(spark, folder) -> DataFrame:
    """Feature rows, some assets without a sensor mean and some with negative hours."""
    asset = F.col("aircraftid")
    return _features(standins.events(spark, folder)).withColumns(
        {
            "sensor_mean_value": F.when(asset % 7 != 0, F.col("sensor_mean_value")),
            "flighthours": F.when(asset % 5 == 0, -1.0 - F.col("flighthours")).otherwise(F.col("flighthours")),
        }
    )


@query
def score_bad_rows(spark, folder):
    # Bad rows are told apart, not fatal.
    broken = _broken(spark, folder)
    model = load_model(_saved_bayes(spark, folder))
    good = score(broken, model).select(*KEYS, F.lit(None).cast("string").alias("problem"), "prediction")
    bad = unscorable(broken, model).select(*KEYS, "problem", F.lit(None).cast("double").alias("prediction"))
    return good.unionByName(bad)


@query
def score_batch(spark, folder):
    events = standins.events(spark, folder)
    return score_requests(
        standins.readings(events),
        standins.utilization(events),
        _saved_bayes(spark, folder),
        requests=standins.requests(events),
    )


@query
def score_stream(spark, folder):
    model = load_model(_saved_bayes(spark, folder))
    arrived, sink = scratch(spark, "arrived"), scratch(spark, "scored")
    write_matrix(_features(standins.events(spark, folder)), arrived)
    schema = schemas.matrix(T.LongType(), labelled=False)
    stream = arriving_features(spark, arrived, schema)
    start_scoring(stream, model, sink, scratch(spark, "progress")).awaitTermination()
    return spark.read.parquet(sink)


@query
def score_stream_horizon(spark, folder):
    # The verdict names the horizon that was saved with the model.
    model = load_model(_saved_bayes(spark, folder, Settings(horizon=30)))
    arrived, sink = scratch(spark, "arrived"), scratch(spark, "scored")
    write_matrix(_features(standins.events(spark, folder)), arrived)
    stream = arriving_features(spark, arrived, schemas.matrix(T.LongType(), labelled=False))
    start_scoring(stream, model, sink, scratch(spark, "progress")).awaitTermination()
    return spark.read.parquet(sink)


@query
def score_stream_split(spark, folder):
    # One stream: each row is scored or rejected, never both.
    model = load_model(_saved_bayes(spark, folder))
    arrived, sink, rejects = (scratch(spark, n) for n in ("arrived", "scored", "rejected"))
    write_matrix(_broken(spark, folder), arrived)
    stream = arriving_features(spark, arrived, schemas.matrix(T.LongType(), labelled=False), files_per_batch=2)
    score_and_reject_stream(stream, model, sink, rejects, scratch(spark, "progress")).awaitTermination()
    good = spark.read.parquet(sink).select(*KEYS, F.lit(None).cast("string").alias("problem"), "prediction")
    bad = spark.read.parquet(rejects).select(*KEYS, "problem", F.lit(None).cast("double").alias("prediction"))
    return good.unionByName(bad)


@query
def run_log(spark, folder):
    runs = scratch(spark, "runs")
    matrix = _matrix(standins.events(spark, folder))
    train_and_rank(
        matrix,
        candidates(SMALL_GRIDS),
        by_key=True,
        concurrent=6,
        models_path=scratch(spark, "models"),
        runs_path=runs,
    )
    # SQL knows the score of naive Bayes only.
    value = F.when(F.col("model") == "Naive Bayes", F.round("value", EXACT))
    return read_runs(spark, runs).select(
        "run_name",
        "model",
        F.col("params")["smoothing"].alias("smoothing"),
        F.col("params")["modelType"].alias("model_type"),
        "metric",
        value.alias("value"),
        F.col("model_path").endswith(F.concat(F.lit("/"), F.col("model"))).alias("model_kept"),
    )


@query
def end_to_end(spark, folder):
    events = standins.events(spark, folder)
    return run_all(
        standins.readings(events),
        standins.utilization(events),
        standins.interruptions(events),
        scratch(spark, "chain"),
        candidates(SMALL_GRIDS, ["Naive Bayes"]),
        matrix_options={"subsystem": standins.SUBSYSTEM, "kinds": standins.KINDS},
        training_options={"by_key": True},
        requests=standins.requests(events),
    )


@query
def end_to_end_horizon(spark, folder):
    # Trained on labels 30 days ahead; the verdict says so.
    events = standins.events(spark, folder)
    return run_all(
        standins.readings(events),
        standins.utilization(events),
        standins.interruptions(events),
        scratch(spark, "chain"),
        candidates(SMALL_GRIDS, ["Naive Bayes"]),
        matrix_options={"subsystem": standins.SUBSYSTEM, "kinds": standins.KINDS, "horizon": 30},
        training_options={"by_key": True},
        requests=standins.requests(events),
    )


@query
def end_to_end_all(spark, folder):
    # All six classifiers; SQL knows which rows are scored, not by which model.
    events = standins.events(spark, folder)
    scored = run_all(
        standins.readings(events),
        standins.utilization(events),
        standins.interruptions(events),
        scratch(spark, "chain"),
        candidates(SMALL_GRIDS),
        matrix_options={"subsystem": standins.SUBSYSTEM, "kinds": standins.KINDS},
        training_options={"by_key": True, "concurrent": 6},
        requests=standins.requests(events),
    )
    agrees = (F.col("prediction") == 0) == F.col("verdict").startswith("No ")
    return scored.select(*KEYS, *FEATURES, F.col("prediction").isin(0.0, 1.0).alias("scored"), agrees.alias("verdict_agrees"))
