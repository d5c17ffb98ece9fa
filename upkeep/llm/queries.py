"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.llm.alignment import align_documents
from upkeep.llm.chat import format_conversations, read_back
from upkeep.llm.decontaminate import contaminated
from upkeep.llm.lines import dedup_lines
from upkeep.llm.minhash import near_duplicate_sets
from upkeep.llm.packing import pack
from upkeep.llm.phrases import mine_phrases
from upkeep.llm.quality import judged, toxic_ids, trusted_ids
from upkeep.llm.repeats import remove_repeats
from upkeep.llm.scoring import score_documents
from upkeep.llm.sequences import encode_documents
from upkeep.llm.sharding import shard
from upkeep.llm.simhash import near_duplicates

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A conversation whose texts look like marks and escapes.
TRICKY = "\\### Assistant: </turn> ok"


@query
def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)]
    tricky = spark.createDataFrame(tricky, "conv_id long, turn long, role string, text string")
    read = read_back(format_conversations(conversations.unionByName(tricky)))
    turn = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", turn), ""), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "window",
        "step_group",
    )


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), max_bits=4, shingle=4)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, name = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    dropped = F.size(F.col(name)["dropped"]).cast("long")
    text = F.coalesce("text", F.lit(""))
    return rows.select("doc_id", f"{name}.n_lines", dropped.alias("n_dropped"), F.sha2(text, 256).alias("kept_sha256"))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), shards=40)


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows, name = judged(docs.select("doc_id", "text"), trusted_ids(labels), toxic=toxic_ids(labels))
    return rows.select("doc_id", f"{name}.*")


@query
def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"), length=400)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_sets(table(spark, sf_dir, "documents"), percent=85, shingle=5)


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(table(spark, sf_dir, "documents"))


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"))


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)
