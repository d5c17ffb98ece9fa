import numpy as np
import odd
import pytest
from test_decontaminate import ITEMS, LEAKS
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from upkeep.llm.decontaminate import Index
from upkeep.llm.quality import judged, trusted_ids
from upkeep.llm.tokens import default_tokenizer


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with odd cases, copies and leaks, and the tables that stages read."""
    root = tmp_path_factory.mktemp("corpus")
    texts = odd.TEXTS + LEAKS + [(200 + i, odd.prose(300 + i, 80)) for i in range(60)]
    texts += [(300, odd.prose(300, 80)), (301, odd.prose(301, 79) + " changed")]
    texts += [(400 + i, " ".join(f"{w}%%%" for w in odd.prose(500 + i, 80).split())) for i in range(30)]
    odd.documents(spark, texts).write.parquet(f"{root}/documents.parquet")
    labels = [(200 + i, 1, 0) for i in range(60)] + [(400 + i, 0, 0) for i in range(30)]
    labels += [(i, 1, 0) for i in (100, 105, 300, 301)] + [(5, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root)


def test_stages_and_their_order():
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_dedup", "decontamination", "packing"]
    assert contract.queries()["pipeline"] is pipeline.run and "pipeline" not in contract.oracle_sql()


def test_each_stage_on_its_own_input(spark, folder, tmp_path):
    docs = first = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in pipeline.STAGES[:-1]:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == first.columns
        kept[name] = [(r["doc_id"], r["text"]) for r in docs.collect()]
    ids = {n: {i for i, _ in x} for n, x in kept.items()}
    rules, label = judged(first, trusted_ids(spark.read.parquet(f"{folder}/labels.parquet")))
    assert ids["quality_rules"] == {r["doc_id"] for r in rules.collect() if r[label]["kept"]}
    assert ids["quality_rules"] >= set(range(200, 260)) and not ids["quality_rules"] & set(range(400, 430))
    assert 300 not in ids["line_dedup"] and 301 not in ids["line_dedup"]  # a copy, and one word changed
    assert ids["line_dedup"] >= set(range(200, 260))
    assert ids["simhash_dedup"] >= set(range(200, 260)) and ids["simhash_dedup"] <= ids["line_dedup"]
    index = Index(ITEMS)
    want = {i for i, t in kept["simhash_dedup"] if not index.search(t or "")}
    assert ids["decontamination"] == want and want < ids["simhash_dedup"]
    pieces = pipeline.packing(spark, docs, folder).collect()
    assert {p["doc_id"] for p in pieces} == want


def test_run_equals_its_stages(spark, folder):
    found = pipeline.run(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    tokens = lambda frame: {(r["doc_id"], r["doc_tokens"]) for r in frame.collect()}
    assert tokens(found) == tokens(pipeline.packing(spark, docs, folder))
    assert found.columns[:4] == ["doc_id", "start", "length", "doc_tokens"]


def test_pieces_of_run_hold_all_ids_of_each_document(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    tokenizer = Tokenizer.from_file(default_tokenizer())
    ids = lambda t: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
    number = lambda r: -1 if r["doc_id"] is None else r["doc_id"]
    want = sorted((number(r), ids(r["text"])) for r in docs.collect())
    assert len({(i, len(x)) for i, x in want}) == len(want)  # so that pieces tell their document
    found = {}
    for p in pipeline.run(spark, folder).collect():
        assert len(p["ids"]) == 4 * p["length"]
        found.setdefault((number(p), p["doc_tokens"]), []).append((p["start"], p["doc_tokens"], bytes(p["ids"])))
    for pieces in found.values():
        pieces.sort()
        assert [s for s, _, _ in pieces] == [sum(len(x) // 4 for _, _, x in pieces[:k]) for k in range(len(pieces))]
        assert {n for _, n, _ in pieces} == {sum(len(x) // 4 for _, _, x in pieces)}
    assert sorted((i, b"".join(x for _, _, x in pieces)) for (i, _), pieces in found.items()) == want


def test_no_documents(spark, folder, none):
    docs = none
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0
