from datetime import date

import pytest

from helpers import rows
from upkeep.defaults import UTILIZATION_COLUMNS
from upkeep.sources.jdbc import Split, read_table
from upkeep.sources.models import append_runs, load_model, read_runs
from upkeep.workspace import scratch, shared_root, stabilise


class Reader:
    """Stands in for ``spark.read``: notes the call, and gives a frame without a database."""

    def __init__(self, frame):
        self.frame = frame
        self.calls = []

    @property
    def read(self):
        return self

    def jdbc(self, *args, **kwargs):
        self.calls.append((args, kwargs))
        return self.frame


@pytest.fixture
def reader(spark):
    return Reader(
        spark.createDataFrame(
            [(date(2024, 1, 1), "XY-ABC", 1.0, 0.0, 2, "extra")],
            "timeid date, aircraftid string, flighthours double, delayedminutes double, flightcycles bigint, note string",
        )
    )


SECRET = {"user": "u", "password": "p", "driver": "org.postgresql.Driver"}


def test_table_read_keeps_the_columns(reader):
    frame = read_table(reader, "jdbc:x", "public.t", UTILIZATION_COLUMNS, properties=SECRET)
    assert frame.columns == list(UTILIZATION_COLUMNS)
    ((args, kwargs),) = reader.calls
    assert args == ("jdbc:x", "public.t")
    assert kwargs == {"properties": {"fetchsize": "10000", **SECRET}}


def test_table_read_is_cut_into_ranges(reader):
    split = Split("timeid", date(2020, 1, 1), date(2024, 1, 1), 48)
    read_table(reader, "jdbc:x", "public.t", ["timeid"], properties=SECRET, split=split)
    ((_, kwargs),) = reader.calls
    assert kwargs["column"] == "timeid" and kwargs["numPartitions"] == 48
    assert (kwargs["lowerBound"], kwargs["upperBound"]) == ("2020-01-01", "2024-01-01")


def test_table_read_prints_no_credentials(reader, capsys):
    read_table(reader, "jdbc:x", "t", ["timeid"], properties=SECRET)
    out = capsys.readouterr()
    assert out.out == "" and out.err == ""


def test_runs_append(spark, tmp_path):
    path = str(tmp_path / "runs")
    for run in ("a", "b"):
        append_runs(spark, path, [(run, "name", "Naive Bayes", {"smoothing": "1.0"}, "F1-Score", 0.5, None)])
    assert rows(read_runs(spark, path), "run_id", "value") == [("a", 0.5), ("b", 0.5)]


def test_missing_results_name_the_earlier_step(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="run training first"):
        load_model(str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError, match="run training first"):
        read_runs(spark, str(tmp_path / "none"))


def test_scratch_lies_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch(spark, "x"), scratch(spark, "x")
    assert shared_root(spark) == root and first.startswith(root) and first != second


class Cluster:
    """A session without the setting, on a cluster."""

    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        master = "yarn"


def test_a_cluster_needs_the_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Cluster)


def test_stable_frame_is_read_from_files(spark):
    frame = spark.range(100).repartition(4)
    stable = stabilise(frame)
    assert rows(stable) == rows(frame)
    assert "FileScan" in stable._jdf.queryExecution().toString()


def test_exported_readings_lie_in_few_folders(spark, tmp_path):
    """Each asset has a file of its own, not a folder; ids may be missing."""
    from datetime import datetime
    from pathlib import Path

    from upkeep.registry.queries import EXPORT_FOLDERS, all_queries

    rows = [(i, datetime(2024, 1, 1, 0, 0, i % 60, 5000), None if i % 7 == 6 else i % 1200 - 2, "view" if i % 3 else None, 0.1 * i) for i in range(2400)]
    rows += [(9000, None, 3, "click", None), (9001, datetime(2024, 1, 2), 3, "click", -0.5)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    before = set(Path(shared_root(spark)).glob("upkeep/readings-csv-*"))
    found = {r[0]: r[1] for r in all_queries()["key_from_path"](spark, str(tmp_path)).collect()}
    want = {}
    for _, _, user, kind, _ in rows:
        if kind:
            key = None if user is None else str(user).rjust(20, "0")
            want[key] = want.get(key, 0) + 1
    assert found == want
    (out,) = set(Path(shared_root(spark)).glob("upkeep/readings-csv-*")) - before
    assert len(list(out.rglob("*.csv"))) == len(want) and all(x.is_file() for x in out.rglob("*.csv"))
    assert len([x for x in out.rglob("*") if x.is_dir()]) <= EXPORT_FOLDERS
