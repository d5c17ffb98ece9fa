"""Helpers that several operators share."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.workspace import scratch

#: White space that separates words: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"
#: Binary logarithm of the bits that tell which rows a shuffle may need.
BITS = 24
MARKS = " \t\n\x0b\f\r"


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` (long) and ``text`` (null becomes empty); other columns cannot clash."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or if ``df`` has such a column (Spark ignores case), a name that it lacks."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_{uuid.uuid4().hex[:6]}"
    return name


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there ever after.

    Spark keeps the shuffle files of a finished job until the driver collects its garbage, which
    may be long after; asking for it here frees the executors' disks for the next job.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.options(**options).parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def word_array(text: Column) -> Column:
    """The words of ``text`` in order."""
    trimmed = F.btrim(text, F.lit(MARKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def numbers(count: Column) -> Column:
    """0, 1, ... up to ``count`` - 1; empty for none."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def bit_of(slot: Column) -> tuple[Column, Column]:
    """The number of 64 bits, of 2 ** ``BITS`` in all, on which a hash falls, and its bit there."""
    slot = F.pmod(slot, F.lit(1 << BITS))
    return F.shiftright(slot, 6), F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))


def bit_table(slot: Column, **marks: DataFrame) -> DataFrame:
    """word, and for each mark the bits on which hashes of its rows fall; 2 ** (``BITS`` - 6) rows at most."""
    word, bit = bit_of(slot)
    none = F.lit(0).cast("long")
    sides = [x.select(word.alias("word"), *[(bit if m == name else none).alias(m) for m in marks]) for name, x in marks.items()]
    return reduce(DataFrame.unionByName, sides).groupBy("word").agg(*[F.bit_or(m).alias(m) for m in marks])


def bit_hits(rows: DataFrame, slot: Column, bits: DataFrame) -> DataFrame:
    """``rows`` that fall on any bit of a ``bit_table``; for each of its marks, whether they do on one of that mark.

    The table is broadcast; ``rows`` are not shuffled.
    """
    word, bit = bit_of(slot)
    found = rows.withColumn("word", word).withColumn("bit", bit).join(F.broadcast(bits), "word")
    hits = {m: F.col(m).bitwiseAND(F.col("bit")) != 0 for m in bits.columns if m != "word"}
    return found.where(reduce(Column.__or__, hits.values())).withColumns(hits).drop("word", "bit")


def worker_state() -> dict:
    """A dict that lives as long as the Python worker, so that tasks can share loaded files."""
    return sys.modules.setdefault("upkeep_worker_state", types.ModuleType("upkeep_worker_state")).__dict__


def local_rows(spark: SparkSession, rows: list, schema: str, parts: int = 1) -> DataFrame:
    """A small frame of driver rows, spread over ``parts`` partitions."""
    frame = spark.createDataFrame(rows, schema)
    return frame.repartition(max(1, parts)) if parts > 1 else frame
