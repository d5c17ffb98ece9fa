import pytest
from pyspark.sql import functions as F

from helpers import at, day, formatted, rows
from upkeep import schemas
from upkeep.functions.columns import rounded, verdict
from upkeep.functions.keys import as_date, asset_from_path, key_bucket, request_date
from upkeep.operators.daily import daily_means
from upkeep.operators.validity import feature_validity, require_trainable
from upkeep.plans.matrix import build_features, build_matrix, unmatched_requests
from upkeep.registry import standins
from upkeep.sources.matrix import read_matrix, write_matrix
from upkeep.sources.readings import read_readings


def write_file(folder, name, *readings):
    lines = ["date;series;value", *[f"{stamp};eventData;{value}" for stamp, value in readings]]
    (folder / name).write_text("\n".join(lines) + "\n")


def means(frame):
    return rows(daily_means(frame), "date", "aircraftid", "sensor_mean_value")


class TestReadings:
    def test_file_spanning_midnight_gives_two_days(self, spark, tmp_path):
        write_file(
            tmp_path,
            "010124-AAA-BBB-0001-XY-ABC.csv",
            ("2024-01-01 21:53:59.619", 27.5),
            ("2024-01-02 00:03:59.619", 28.78),
        )
        assert means(read_readings(spark, str(tmp_path))) == [
            (day(1), "XY-ABC", 27.5),
            (day(2), "XY-ABC", 28.78),
        ]

    def test_files_of_one_asset_day_share_one_mean(self, spark, tmp_path):
        stamp = "2024-01-01 10:00:00.000"
        write_file(tmp_path, "010124-AAA-BBB-0001-XY-ABC.csv", (stamp, 10.0), (stamp, 20.0))
        write_file(tmp_path, "010124-BBB-CCC-0002-XY-ABC.csv", (stamp, 60.0))
        assert means(read_readings(spark, str(tmp_path))) == [(day(1), "XY-ABC", 30.0)]

    def test_day_comes_from_the_reading_not_the_file_name(self, spark, tmp_path):
        write_file(tmp_path, "260224-AAA-BBB-0001-XY-ABC.csv", ("2024-02-27 01:00:00.000", 5.0))
        assert means(read_readings(spark, str(tmp_path))) == [(day(27, 2), "XY-ABC", 5.0)]

    def test_other_files_are_left_out(self, spark, tmp_path):
        write_file(tmp_path, "010124-AAA-BBB-0001-XY-ABC.csv", ("2024-01-01 10:00:00.000", 1.0))
        (tmp_path / "notes.txt").write_text("nothing")
        assert read_readings(spark, str(tmp_path)).count() == 1

    def test_empty_value_does_not_enter_the_mean(self, spark, tmp_path):
        stamp = "2024-01-01 10:00:00.000"
        write_file(tmp_path, "010124-AAA-BBB-0001-XY-ABC.csv", (stamp, 4.0), (stamp, ""))
        assert means(read_readings(spark, str(tmp_path))) == [(day(1), "XY-ABC", 4.0)]

    @pytest.mark.parametrize("text", ["date;value;series\n", "date;series;value\n2024-01-01 10:00:00;e;many\n"])
    def test_malformed_files_fail(self, spark, tmp_path, text):
        (tmp_path / "010124-AAA-BBB-0001-XY-ABC.csv").write_text(text + "2024-01-01 10:00:00;1.0;e\n")
        with pytest.raises(Exception, match="010124-AAA-BBB-0001-XY-ABC"):
            read_readings(spark, str(tmp_path)).collect()

    def test_missing_folder_names_the_earlier_step(self, spark, tmp_path):
        with pytest.raises(FileNotFoundError, match="export of sensor readings"):
            read_readings(spark, str(tmp_path / "none"))

    def test_unused_columns_are_not_parsed(self, spark, tmp_path):
        write_file(tmp_path, "010124-AAA-BBB-0001-XY-ABC.csv", ("2024-01-01 10:00:00.000", 1.0))
        plan = daily_means(read_readings(spark, str(tmp_path)))._jdf.queryExecution().toString()
        assert "ReadSchema: struct<date:timestamp,value:double>" in plan


def small(build):
    readings = build.readings(
        (at(1, 8), 40.60, "XY-ABC"), (at(1, 9), 40.61, "XY-ABC"), (at(2), 7.0, "XY-ABC"), (at(1), 3.0, "XY-DEF")
    )
    used = build.utilization((day(1), "XY-ABC", 2.005, 1.114, 3), (day(1), "XY-DEF", 1.0, 0.0, 1))
    return readings, used


class TestFeatures:
    def test_rounding_and_inner_join(self, build):
        found = build_features(*small(build))
        assert found.columns == ["date", "aircraftid", "sensor_mean_value", "flighthours", "delayedminutes", "flightcycles"]
        # 40.605 and 2.005 round up as written; the second day lacks utilization.
        assert rows(found) == [
            (day(1), "XY-ABC", 40.61, 2.01, 1.11, 3),
            (day(1), "XY-DEF", 3.0, 1.0, 0.0, 1),
        ]

    def test_repeated_utilization_repeats_the_row(self, build):
        readings = build.readings((at(1), 3.0, "XY-DEF"))
        used = build.utilization((day(1), "XY-DEF", 1.0, 0.0, 1), (day(1), "XY-DEF", 2.0, 0.0, 1))
        found = build_matrix(readings, used, build.interruptions((at(2), "XY-DEF"), (at(3), "XY-DEF")))
        assert rows(found, "flighthours", "label") == [(1.0, 1), (1.0, 1), (2.0, 1), (2.0, 1)]

    def test_means_are_formed_before_the_shuffle(self, spark, tables):
        plan = formatted(daily_means(standins.readings(standins.events(spark, tables))))
        assert "partial_avg" in plan and plan.count("Exchange") == 2  # once in the tree, once below

    def test_one_asset_and_day(self, build):
        found = build_features(*small(build), aircraftid="XY-DEF", date="2024-01-01")
        assert rows(found, "aircraftid", "sensor_mean_value") == [("XY-DEF", 3.0)]
        assert build_features(*small(build), aircraftid="XY-DEF", date=day(2)).count() == 0

    @pytest.mark.parametrize("half", [{"aircraftid": "XY-ABC"}, {"date": "2024-01-01"}])
    def test_half_a_key_is_an_error(self, build, half):
        with pytest.raises(ValueError, match="both"):
            build_features(*small(build), **half)

    @pytest.mark.parametrize("text", ["010124", "20240101", "01/01/2024"])
    def test_day_must_be_iso_text(self, build, text):
        with pytest.raises(ValueError):
            build_features(*small(build), aircraftid="XY-ABC", date=text)

    def test_requests(self, spark, build):
        asked = [("XY-DEF", "2024-01-01")] * 3 + [("XY-DEF", "2024-01-02"), ("XY-GHI", "2024-01-01"), ("XY-ABC", "010124")]
        requests = spark.createDataFrame(asked, "aircraftid string, date string")
        found = build_features(*small(build), requests=requests)
        assert rows(found, "aircraftid", "date") == [("XY-DEF", day(1))]
        assert rows(unmatched_requests(requests, found), "aircraftid", "date") == [
            ("XY-ABC", None),
            ("XY-DEF", day(2)),
            ("XY-GHI", day(1)),
        ]

    def test_no_requests(self, spark, build):
        requests = spark.createDataFrame([], "aircraftid string, date date")
        assert build_features(*small(build), requests=requests).count() == 0

    def test_point_filter_reaches_the_scan(self, spark, tables):
        events = standins.events(spark, tables)
        found = build_features(
            standins.readings(events), standins.utilization(events), aircraftid=7, date="2024-01-09"
        )
        pushed = [line for line in formatted(found).splitlines() if line.startswith("PushedFilters")]
        assert len(pushed) == 2
        for line in pushed:
            assert "EqualTo(user_id,7)" in line
            assert "GreaterThanOrEqual(ts,2024-01-09T00:00)" in line
            assert "LessThan(ts,2024-01-10T00:00)" in line

    def test_few_requests_filter_before_the_mean(self, spark, tables):
        events = standins.events(spark, tables)
        requests = spark.createDataFrame([(7, day(9))], "aircraftid bigint, date date")
        found = build_features(standins.readings(events), standins.utilization(events), requests=requests)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        mean = plan[plan.index("Aggregate [") :]
        assert "LeftSemi" in mean


def test_rounded_keeps_order_and_other_columns(spark):
    frame = spark.createDataFrame([(1.005, 2.675, "a")], "x double, y double, z string")
    assert rows(rounded(frame, ("y",))) == [(1.005, 2.68, "a")]


def test_verdict(spark):
    frame = spark.createDataFrame([(0.0,), (1.0,)], "p double").select(verdict(F.col("p")))
    assert [r[0].split()[0] for r in frame.collect()] == ["No", "Unscheduled"]
    other = spark.createDataFrame([(0.0,), (1.0,), (None,)], "p double").select(verdict(F.col("p"), 90))
    assert [r[0] and r[0].split("next ")[1] for r in other.collect()] == ["90 days", "90 days", None]


@pytest.mark.parametrize(
    "name, asset",
    [
        ("010124-AAA-BBB-0001-XY-ABC.csv", "XY-ABC"),
        ("ABCDEF.csv", "ABCDEF"),
        ("AB.csv", "AB"),
        ("a.csv.XY-DEF.csv", "XY-DEF"),
        ("010124-AAA-BBB-0001-XY-ABC.csv/part-0001.csv", "XY-ABC"),
        ("2024/part-XY-ABC.csv", "XY-ABC"),
    ],
)
def test_asset_from_path(spark, name, asset):
    frame = spark.createDataFrame([(f"file:/in/x.csv/{name}",)], "path string")
    assert frame.select(asset_from_path(F.col("path"))).first()[0] == asset


def test_long_asset_ids_stay_whole(spark):
    frame = spark.createDataFrame([("file:/in/010124-AAA-BBB-0001-U-0000123456.csv",)], "path string")
    assert frame.select(asset_from_path(F.col("path"), 10)).first()[0] == "0000123456"


def test_key_bucket_ignores_type_and_spreads(spark):
    frame = spark.range(10_000).withColumn("text", F.col("id").cast("string"))
    both = frame.select(key_bucket(10, "id").alias("a"), key_bucket(10, "text").alias("b"))
    assert both.where("a <> b").count() == 0
    counts = [r["count"] for r in both.groupBy("a").count().collect()]
    assert len(counts) == 10 and min(counts) > 850


def test_request_dates(spark):
    frame = spark.createDataFrame([("2024-01-09",), ("010124",), ("x",), (None,)], "d string")
    assert [r[0] for r in frame.select(request_date(F.col("d"))).collect()] == [day(9), None, None, None]
    assert as_date(at(9)) == as_date("2024-01-09") == day(9)


class TestStorage:
    @pytest.mark.parametrize("fmt", ["parquet", "csv"])
    def test_round_trip(self, spark, build, tmp_path, fmt):
        matrix = build_matrix(*small(build), build.interruptions((at(3), "XY-ABC")))
        write_matrix(matrix, str(tmp_path / "m"), fmt=fmt)
        back = read_matrix(spark, str(tmp_path / "m"), fmt=fmt, schema=schemas.matrix())
        assert rows(back) == rows(matrix) and back.schema == schemas.matrix()

    def test_single_file_is_opt_in(self, spark, build, tmp_path):
        frame = build_features(*small(build)).repartition(3)
        write_matrix(frame, str(tmp_path / "many"))
        write_matrix(frame, str(tmp_path / "one"), single_file=True)
        assert len(list((tmp_path / "one").glob("part-*"))) == 1

    def test_overwrite_and_partitions(self, spark, build, tmp_path):
        path = str(tmp_path / "m")
        frame = build_features(*small(build))
        write_matrix(frame.unionByName(frame), path)
        write_matrix(frame.repartition(3), path, partition_by=["date"])
        assert len(list((tmp_path / "m" / "date=2024-01-01").glob("part-*"))) == 1
        assert rows(read_matrix(spark, path), *frame.columns) == rows(frame)

    def test_csv_needs_a_schema_and_missing_input_says_so(self, spark, tmp_path):
        with pytest.raises(ValueError, match="schema"):
            read_matrix(spark, str(tmp_path), fmt="csv")
        with pytest.raises(FileNotFoundError, match="matrix build"):
            read_matrix(spark, str(tmp_path / "none"))


class TestValidity:
    def frame(self, spark, *values):
        full = [(day(1), "a", *v) for v in values]
        return spark.createDataFrame(full, schemas.matrix())

    def test_report(self, spark):
        frame = self.frame(spark, (None, float("nan"), -1.0, 2, 0), (1.0, 1.0, 1.0, None, 2))
        found = {r.column_name: (r.n_rows, r.nulls, r.nans, r.negatives, r.off_domain) for r in feature_validity(frame).collect()}
        assert found == {
            "sensor_mean_value": (2, 1, 0, 0, 0),
            "flighthours": (2, 0, 1, 0, 0),
            "delayedminutes": (2, 0, 0, 1, 0),
            "flightcycles": (2, 1, 0, 0, 0),
            "label": (2, 0, 0, 0, 1),
        }

    @pytest.mark.parametrize(
        "row, column",
        [
            ((None, 1.0, 1.0, 1, 0), "sensor_mean_value"),
            ((1.0, float("nan"), 1.0, 1, 0), "flighthours"),
            ((1.0, 1.0, -1.0, 1, 0), "delayedminutes"),
            ((1.0, 1.0, 1.0, 1, 2), "label"),
        ],
    )
    def test_error_names_the_column(self, spark, row, column):
        with pytest.raises(ValueError, match=column):
            require_trainable(self.frame(spark, row))

    def test_negatives_matter_to_naive_bayes_only(self, spark):
        frame = self.frame(spark, (1.0, 1.0, -1.0, 1, 0))
        assert require_trainable(frame, non_negative=False) == 1

    def test_empty(self, spark):
        with pytest.raises(ValueError, match="empty"):
            require_trainable(self.frame(spark))
