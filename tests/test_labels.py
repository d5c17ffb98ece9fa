from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import at, day, rows
from upkeep.operators.labels import label_by_day, label_by_interval, qualifying
from upkeep.plans.matrix import build_matrix
from upkeep.registry import standins
from upkeep.registry.queries import _features

BOTH = [label_by_day, label_by_interval]


def labels(build, *interruptions, **how):
    readings = build.readings((at(10), 20.0, "XY-ABC"))
    used = build.utilization((day(10), "XY-ABC"))
    matrix = build_matrix(readings, used, build.interruptions(*interruptions), **how)
    return [r.label for r in matrix.collect()]


@pytest.mark.parametrize("by_interval", [False, True])
class TestWindow:
    @pytest.mark.parametrize("start, label", [(9, 0), (10, 1), (16, 1), (17, 0)])
    def test_edges(self, build, by_interval, start, label):
        assert labels(build, (at(start, 0), "XY-ABC"), by_interval=by_interval) == [label]

    def test_late_on_the_same_day_counts(self, build, by_interval):
        assert labels(build, (at(10, 23, 59), "XY-ABC"), by_interval=by_interval) == [1]

    def test_other_asset_does_not_count(self, build, by_interval):
        assert labels(build, (at(10), "XY-DEF"), by_interval=by_interval) == [0]

    def test_every_match_gives_a_row(self, build, by_interval):
        two = [(at(11), "XY-ABC"), (at(15), "XY-ABC")]
        assert labels(build, *two, by_interval=by_interval) == [1, 1]

    def test_matches_on_one_day_all_count(self, build, by_interval):
        assert labels(build, *[(at(12, h), "XY-ABC") for h in range(5)], by_interval=by_interval) == [1] * 5

    def test_null_start_is_no_match(self, build, by_interval):
        assert labels(build, (None, "XY-ABC"), by_interval=by_interval) == [0]

    def test_horizon_is_a_parameter(self, build, by_interval):
        start = (at(12), "XY-ABC")
        assert labels(build, start, horizon=3, by_interval=by_interval) == [1]
        assert labels(build, start, horizon=2, by_interval=by_interval) == [0]


def test_deduped_matrix_keeps_one_row(build):
    assert labels(build, (at(11), "XY-ABC"), (at(15), "XY-ABC"), dedupe=True) == [1]
    assert labels(build, dedupe=True) == [0]


@pytest.mark.parametrize(
    "subsystem, kind, label",
    [("3453", "Safety", 1), ("3454", "Safety", 0), ("3453", "Maintenance", 0), ("34AB", "Safety", 0)],
)
def test_only_qualifying_interruptions_count(build, subsystem, kind, label):
    assert labels(build, (at(11), "XY-ABC", subsystem, kind)) == [label]


def test_subsystem_may_be_given_as_text(build):
    assert labels(build, (at(11), "XY-ABC"), subsystem="3453") == [1]


@pytest.mark.parametrize("by_interval", [False, True])
def test_dedupe_keeps_one_row_either_way(build, by_interval):
    events = (at(11), "XY-ABC"), (at(12), "XY-ABC"), (at(12, 13), "XY-ABC")
    assert labels(build, *events, dedupe=True, by_interval=by_interval) == [1]
    assert labels(build, dedupe=True, by_interval=by_interval) == [0]


@pytest.mark.parametrize("by_interval", [False, True])
def test_repeated_utilization_is_not_one_task(spark, no_broadcast, by_interval):
    """Nine tenths of all utilization rows on one asset-day: adaptive execution can split them."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = F.col("id")
        tenth = F.date_add(F.lit(day(9)), (n >= 0).cast("int"))  # not a constant to the optimiser
        asset = F.when(n % 10 != 0, F.lit(1)).otherwise(n % 500).cast("string")
        used = spark.range(200_000).select(
            F.lit(day(10)).alias("timeid"),
            asset.alias("aircraftid"),
            (n * 1.0).alias("flighthours"),
            F.lit(0.0).alias("delayedminutes"),
            n.alias("flightcycles"),
        )
        readings = spark.range(500).select(
            tenth.cast("timestamp").alias("date"), F.lit("s").alias("series"), F.lit(1.0).alias("value"), n.cast("string").alias("aircraftid")
        )
        events = spark.range(500).select(
            F.lit("3453").alias("subsystem"),
            n.cast("string").alias("aircraftregistration"),
            F.lit(at(11)).alias("starttime"),
            F.lit("Delay").alias("kind"),
        )
        found = build_matrix(readings, used, events, by_interval=by_interval).select("*", F.spark_partition_id().alias("task"))
        sizes = Counter(found.toArrow().column("task").to_pylist())
        assert sum(sizes.values()) == 200_000 and max(sizes.values()) < 60_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("label", BOTH)
def test_rows_without_a_day_are_kept(spark, build, label):
    features = spark.createDataFrame([("XY-ABC", None), ("XY-ABC", day(10))], "aircraftid string, date date")
    events = qualifying(build.interruptions((at(11), "XY-ABC"), (None, "XY-ABC"), (at(11), None)))
    assert rows(label(features, events)) == [("XY-ABC", None, 0), ("XY-ABC", day(10), 1)]


def expected(features, starts, horizon):
    """Brute force over all pairs."""
    out = Counter()
    for f in features:
        hits = sum(
            1 for a, s in starts if a == f.aircraftid and s is not None and 0 <= (s - f.date).days < horizon
        )
        out[(f.date, f.aircraftid, int(hits > 0))] += max(hits, 1)
    return out


@pytest.fixture(scope="module")
def skewed(spark, tables):
    """The events table with a third of all rows moved to one asset, and half of those to one day."""
    hot = F.col("event_id") % 3 == 0
    return standins.events(spark, tables).select(
        "event_id",
        F.when(hot & (F.col("event_id") % 2 == 0), F.lit("2024-01-15 10:00:00").cast("timestamp_ntz"))
        .otherwise(F.col("ts"))
        .alias("ts"),
        F.when(hot, F.lit(1).cast("bigint")).otherwise(F.col("user_id")).alias("user_id"),
        "event_type",
        "value",
    ).cache()


@pytest.mark.parametrize("label", BOTH)
@pytest.mark.parametrize("block", [1, 3, 100_000])
@pytest.mark.parametrize("horizon", [1, 7, 20])
def test_skewed_rows_are_labelled_whole(skewed, label, block, horizon):
    features = _features(skewed)
    # All error and signup events count, so that the hot day holds very many matches.
    events = standins.interruptions(skewed).where(F.col("kind").isin("error", "signup"))
    events = events.withColumn("starttime", F.to_date("starttime"))
    found = label(features, events, horizon=horizon, block=block)
    counted = found.groupBy("date", "aircraftid", "label").count().collect()
    starts = [(r.aircraftregistration, r.starttime) for r in events.collect()]
    wanted = expected(features.select("date", "aircraftid").collect(), starts, horizon)
    assert Counter({(r.date, r.aircraftid, r.label): r["count"] for r in counted}) == wanted


def final_plan(frame):
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def label_rows(spark, tables, label):
    events = standins.events(spark, tables)
    intr = qualifying(standins.interruptions(events), standins.SUBSYSTEM, standins.KINDS)
    return label(_features(events), intr)


def test_day_join_shuffles_each_input_once(spark, tables, no_broadcast):
    plan = final_plan(label_rows(spark, tables, label_by_day))
    assert plan.count("Exchange hashpartitioning") == 3  # means, utilization, interruptions
    assert plan.count("SortMergeJoin") == 2
    assert "Union" not in plan  # no day is heavy, so that branch is gone


def test_interval_join_adds_one_shuffle_per_side(spark, tables, no_broadcast):
    plan = final_plan(label_rows(spark, tables, label_by_interval))
    assert plan.count("Exchange hashpartitioning") == 5
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_heavy_days_are_spread_over_tasks(skewed, no_broadcast):
    events = standins.interruptions(skewed).withColumn("starttime", F.to_date("starttime"))
    found = label_by_day(_features(skewed), events, block=2)
    plan = final_plan(found)
    assert "REPARTITION_BY_NUM" in plan and "block" in plan
    by_task = found.where((F.col("aircraftid") == 1) & (F.col("date") == F.lit(day(15)))).groupBy(
        F.spark_partition_id()
    ).count()
    assert by_task.count() > 1
