"""Sensor readings from and to delimited files whose names carry the asset id."""

from __future__ import annotations

from itertools import groupby
from operator import itemgetter
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.functions.keys import ASSET_ID_LENGTH, SUFFIX, asset_from_path
from upkeep.schemas import READING_FILE
from upkeep.sources.paths import require


def read_readings(
    spark: SparkSession,
    folder: str,
    *,
    sep: str = ";",
    mode: str = "FAILFAST",
    id_length: int = ASSET_ID_LENGTH,
    recursive: bool = False,
) -> DataFrame:
    """Scan all CSV files of ``folder``; add ``aircraftid``, the last ``id_length`` characters of the name.

    ``recursive`` also reads the folders within, whatever their names.

    The folder is listed once and filtered by name, which scales to far more files than
    expanding a glob into one root path per file. Headers are checked against the schema.
    """
    scan = (
        spark.read.schema(READING_FILE)
        .option("header", True)
        .option("sep", sep)
        .option("mode", mode)
        .option("enforceSchema", False)
        .option("pathGlobFilter", f"*{SUFFIX}")
        .option("recursiveFileLookup", recursive)
    )
    files = require(folder, "the export of sensor readings", lambda: scan.csv(folder))
    return files.select("*", asset_from_path(F.col("_metadata.file_path"), id_length).alias("aircraftid"))


def write_readings(readings: DataFrame, folder: str, *, file: str = "file", sep: str = ";") -> None:
    """Write one CSV file with a header for each value of the column ``file``, its path within ``folder``.

    Spark formats the lines and brings those of a file together. The tasks write the files themselves,
    because Spark's writer makes a folder for each of them, which the reader then lists by a task of its
    own. A file appears under its name only when complete.
    """
    from upkeep.llm.sequences import located, store  # nothing else here needs that folder

    root = located(readings.sparkSession, folder)
    columns = [c for c in readings.columns if c != file]
    header = sep.join(columns) + "\n"

    def write(batches):
        fs, base = store(root)
        fs.create_dir(base)
        folders, name, out, part, n = set(), None, None, None, 0

        def finish():
            out.close()
            fs.move(part, f"{base}/{name}")

        for batch in batches:
            lines = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for found, rows in groupby(lines, key=itemgetter(0)):
                if found != name:
                    if out is not None:
                        finish()
                    inner, _, last = found.rpartition("/")
                    if inner and inner not in folders:
                        fs.create_dir(f"{base}/{inner}")
                        folders.add(inner)
                    name, part, n = found, f"{base}/{inner}/_{last}.{uuid4().hex}.part", n + 1
                    out = fs.open_output_stream(part)
                    out.write(header.encode())
                out.write("".join(f"{line}\n" for _, line in rows).encode())
        if out is not None:
            finish()
        yield pa.record_batch({"files": pa.array([n], pa.int64())})

    lines = readings.select(file, F.to_csv(F.struct(*columns), {"sep": sep}).alias("line"))
    lines.repartition(file).sortWithinPartitions(file).mapInArrow(write, "files long").agg(F.sum("files")).collect()
