"""Shared storage for intermediate results that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the session names none, a local session gets a temporary folder of its own; its
    settings stay as they are. A cluster session gets an error: a machine-local folder would be
    lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    session = spark.sparkContext.applicationId
    if session not in _local_roots:
        _local_roots[session] = tempfile.mkdtemp(prefix="upkeep-")
    return _local_roots[session]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; nothing exists there yet."""
    return f"{shared_root(spark)}/upkeep/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def stabilise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and read it from there ever after."""
    spark = df.sparkSession
    path = scratch(spark, "stable")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the files of frames that ``stabilise`` or another call has stored in the shared folder."""
    for df in frames:
        spark = df.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            if "/upkeep/" not in folder:
                raise ValueError(f"{folder} is not a stored frame")
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
