"""Documents to training sequences: rules, line dedup, near-duplicates, decontamination, packing.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before has kept, and is
written as Parquet before the next one reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.llm.common import stored
from upkeep.llm.decontaminate import without_benchmark
from upkeep.llm.lines import dedup_lines
from upkeep.llm.packing import pack
from upkeep.llm.quality import judged, toxic_ids, trusted_ids
from upkeep.llm.simhash import one_of_each


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep.

    Null and empty texts have no words and go. Ids, null or repeated, only say which rows are labelled;
    repeated rows get the same verdict. Without labels the log ratio rejects nothing and no word is
    toxic. Other columns stay as they are, whatever their names. An empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows, name = judged(docs, trusted_ids(labels), toxic=toxic_ids(labels))
    return rows.where(F.col(name)["kept"]).drop(name)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; one that has lines and loses all of them goes.

    Null and empty texts, and texts without a word, stay. Of equal lines the one with the smallest id
    (null first), then text hash, then line number stays; rows with equal id and text get the same
    result. ``n_chars`` is counted anew where lines went, other columns stay, whatever their names. An
    empty table stays empty.
    """
    rows, name = dedup_lines(docs)
    gone, lines = F.size(F.col(name)["dropped"]), F.col(name)["n_lines"]
    rows = rows.where((lines == 0) | (gone < lines))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(gone > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return rows.select(docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates.

    Null, empty and wordless texts are one group. The smallest id stays (null last), then the
    smallest text hash; of rows with equal id and text one stays, any of them if other columns
    differ. An empty table stays empty.
    """
    return one_of_each(docs, max_bits=4, shingle=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item.

    Null and empty texts hold none and stay, and so do null ids and repeated rows. Null and empty
    items match nothing, repeated ones count once; without items all stay. Other columns stay as they
    are. An empty table stays empty.
    """
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids, of whole texts.

    Null and empty texts give the end id alone, null ids are kept, repeated rows are documents of
    their own, and other columns are left out. An empty table gives no pieces.
    """
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL knows no hashed n-grams of this kind, no XXH64 and no tokenizer; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
